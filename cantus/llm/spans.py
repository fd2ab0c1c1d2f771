"""Repeated spans of texts: which occur earlier in the corpus, and texts without them.

Shared by substring and line dedup.  A batch is read into *units*: a key that equal spans share,
the place, and the bytes.  Owners of key ranges say which keys repeat.  Only units whose keys
repeat are then compared byte by byte by key, once per batch and content; the answers go back to
the batches, which cut what occurs earlier.  Earlier means: smaller id (null ids last), then place
in the staged table, then start.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import batches as B
from .common import written

UNIT = "batch_id long, key long, doc_id long, doc_no int, start long, body binary"
CUT = "batch_id long, owner long, codes binary, doc_no int, start long, mask long"


@dataclass
class Units:
    """Spans of a batch in the order of their documents; ``body(i, j)`` gives the bytes of windows from ``start[i] + j``."""

    key: np.ndarray
    doc_no: np.ndarray
    start: np.ndarray  # in the document
    windows: np.ndarray
    body: object


def doc_order(table: pa.Table, id_at: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a batch by id (null last), and their ids with null as the largest number."""
    ids = table.column(id_at).cast(pa.int64()).fill_null(B.MAX_ID).to_numpy()
    return np.argsort(ids, kind="stable"), ids


def _pending(units: Units, code: np.ndarray):
    """What must be asked of other batches, and what is known to repeat inside the batch.

    Yields (unit, window or -1 for all, key): the first in this batch of each content.  ``known``
    gets (unit, window or -1) of later ones.  Windows of very frequent keys are asked one by one,
    by a key of their own bytes, which spreads them over owners: a longer prefix for larger groups.
    """
    from xxhash import xxh64_intdigest

    ask, known, seen = [], [], set()
    for i in np.flatnonzero(code).tolist():
        if code[i] == 1:
            body = units.body(i, -1)
            if body in seen:
                known.append((i, -1))
            else:
                seen.add(body)
                ask.append((i, -1, int(units.key[i]), body))
        else:
            for j in range(int(units.windows[i])):
                body = units.body(i, j)
                if body in seen:
                    known.append((i, j))
                else:
                    seen.add(body)
                    ask.append((i, j, xxh64_intdigest(body, 7), body))
    return ask, known


def cut_spans(
    docs: DataFrame,
    text_col: str,
    id_col: str,
    units_of,
    subtree,
    remove,
    counts: str,
    batch_bytes: int,
    bytes_per_owner: int,
    many: int,
) -> DataFrame:
    """``docs`` with the spans cut that occur earlier, and the columns of ``counts``.

    ``units_of(texts)`` reads texts (null as empty, in document order) into ``Units``;
    ``subtree(rows)`` gets (order, body) of one key in order and gives a mask of repeated windows
    for each; ``remove(texts, doc_no, start)`` gives the new texts and the counts.
    """
    docs = docs.drop(*[c.split()[0] for c in counts.split(", ")])
    staged = B.stage(docs, text_col, batch_bytes)
    owners = B.owners_for(staged, bytes_per_owner)
    id_at = [c for c in docs.columns if c != text_col].index(id_col)

    def read(body):
        table = B.opened(body)
        order, ids = doc_order(table, id_at)
        texts = table.column("__text").take(pa.array(order))
        return table, order, ids, texts.fill_null(b"").to_pylist()

    def questions(table, _):
        order, _ = doc_order(table, id_at)
        units = units_of(table.column("__text").take(pa.array(order)).fill_null(b"").to_pylist())
        keys, n = np.unique(units.key, return_counts=True)
        return {0: (keys, n.astype(np.uint32))}

    codes = written(B.repeated_codes(B.ask(staged, questions, owners), many), "repeats")

    def coded(body, answers):
        table, order, ids, texts = read(body)
        units = units_of(texts)
        code = B.in_order(answers, np.uint8)[np.unique(units.key, return_inverse=True)[1]] if len(units.key) else np.empty(0, np.uint8)
        return table, order, ids, texts, units, *_pending(units, code)

    def contexts(batch: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        for r in batch.to_pylist():
            _, order, ids, _, units, asked, _ = coded(r["body"], answers)
            by_no = ids[order]
            for i, j, key, body in asked:
                no = int(units.doc_no[i])
                rows.append((r["batch_id"], (key + 2**63) % 2**64 - 2**63, int(by_no[no]), no, int(units.start[i]) + max(j, 0), body))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        cols = zip(*rows) if rows else [[]] * 6
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("batch_id", "key", "doc_id", "doc_no", "start", "body"), cols, kinds)})

    heads = staged.select("batch_id", "body")
    suffixes = heads.groupBy("batch_id").cogroup(codes.groupBy("batch_id")).applyInArrow(contexts, UNIT)

    def compare(rows: pa.Table) -> pa.Table:
        key, batch, doc, no, start = (rows[c].to_numpy() for c in ("key", "batch_id", "doc_id", "doc_no", "start"))
        order = np.lexsort((start, no, batch, doc, key))
        bodies, groups = rows["body"].combine_chunks(), np.flatnonzero(np.diff(key[order], prepend=key[order[0]] - 1))
        found = []
        for a, z in zip(groups.tolist(), [*groups[1:].tolist(), len(order)]):
            if z - a > 1:
                own = order[a:z]
                for i, mask in zip(own.tolist(), subtree([bodies[i].as_py() for i in own.tolist()])):
                    if mask:
                        found.append((i, mask))
        at = np.array([i for i, _ in found], np.int64)
        none = pa.nulls(len(at), pa.binary())
        return pa.table({"batch_id": batch[at], "owner": np.full(len(at), -1), "codes": none, "doc_no": no[at].astype(np.int32), "start": start[at], "mask": pa.array([m for _, m in found], pa.int64())})

    groups = F.pmod(F.col("key"), F.lit(4 * owners))
    cuts = suffixes.groupBy(groups.alias("group")).applyInArrow(compare, CUT)
    blank = codes.select("batch_id", "owner", "codes", F.lit(0).alias("doc_no"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("mask"))
    answers = cuts.unionByName(blank)
    fields = [f for f in docs.schema.fields]
    schema = docs.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if f.name == text_col else F.col(f"`{f.name}`") for f in fields]).schema
    names = [c for c in docs.columns if c != text_col]
    n_counts = [c.split()[0] for c in counts.split(", ")]
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ", " + counts

    def finish(batch: pa.Table, replies: pa.Table) -> pa.Table:
        parts = []
        asked_codes = replies.filter(pc.greater_equal(replies["owner"], 0))
        marks = replies.filter(pc.less(replies["owner"], 0))
        for r in batch.to_pylist():
            table, order, _, texts, units, _, known = coded(r["body"], asked_codes)
            no, start = [marks["doc_no"].to_numpy()], [marks["start"].to_numpy()]
            mask = marks["mask"].to_numpy()
            width = np.arange(63, dtype=np.int64)
            which, bit = np.nonzero((mask[:, None] >> width) & 1)
            no, start = no[0][which], start[0][which] + bit
            ki = np.array([i for i, _ in known], np.int64)
            kj = np.array([j for _, j in known], np.int64)
            whole = kj < 0
            n_win = np.where(whole, units.windows[ki], 1) if len(ki) else np.empty(0, np.int64)
            step = np.arange(n_win.sum()) - np.repeat(np.cumsum(n_win) - n_win, n_win)
            no = np.concatenate([no, np.repeat(units.doc_no[ki], n_win) if len(ki) else []]).astype(np.int64)
            first = units.start[ki] + np.maximum(kj, 0) if len(ki) else np.empty(0, np.int64)
            start = np.concatenate([start, np.repeat(first, n_win) + step]).astype(np.int64)
            del units, known
            new, numbers = remove(texts, no, start)
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            old = table.column("__text")
            text = pa.array([None if t is None else t.decode() for t in new], pa.string()).take(pa.array(back))
            text = pc.if_else(pc.is_null(old), pa.scalar(None, pa.string()), text)
            cols = {c: table.column(f"c{i}") for i, c in enumerate(names)}
            cols[text_col] = text
            parts.append(pa.table([cols[f.name] for f in fields] + [pa.array(n[back], pa.int64()) for n in numbers], names=[f.name for f in fields] + n_counts))
        return pa.concat_tables(parts) if parts else None

    return heads.groupBy("batch_id").cogroup(answers.groupBy("batch_id")).applyInArrow(finish, out_schema)
