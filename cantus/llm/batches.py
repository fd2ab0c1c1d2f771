"""Documents staged in compressed batches, and questions about keys that owner tasks answer.

Several operators need to know, for very many keys of each document, what the whole corpus says
about them.  Shuffling one row per key and document, and the texts once more to join the answers,
would move many times the input.  Here documents are staged once, without a shuffle, as batches of
a few MB (one compressed Arrow body each).  Each batch sends its distinct keys, sorted and packed,
to the owners of the key ranges; an owner merges the counts of a range and answers each batch in
the order in which it asked.  A key held by a third of all rows is one entry per batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, written

STAGED = "batch_id long, kind int, n_bytes long, body binary"
MAX_ID = np.iinfo(np.int64).max
_END = [pa.array([], pa.int64())]


def stage(docs: DataFrame, text_col: str, batch_bytes: int = 6 << 20, kind=None) -> DataFrame:
    """All columns of ``docs`` as batches, written to the shared folder; a batch has one ``kind``."""

    def pack(batches):
        task, n = TaskContext.get().partitionId() << 32, 0
        held: dict[int, list] = {}
        size: dict[int, int] = {}

        def body(k):
            nonlocal n
            rows = pa.Table.from_batches(held.pop(k)).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as out:
                out.write_table(rows)
            raw = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())
            n += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((task + n, k, size.pop(k), raw), kinds)], ["batch_id", "kind", "n_bytes", "body"])

        for rows in slices(batches, "__text", batch_bytes):
            of = rows.column(rows.schema.get_field_index("__kind"))
            for k in pc.unique(of).to_pylist():
                part = rows.filter(pc.equal(of, k)).drop_columns(["__kind"])
                held.setdefault(k, []).append(part)
                size[k] = size.get(k, 0) + part.column(part.schema.get_field_index("__text")).nbytes
                if size[k] >= batch_bytes:
                    yield body(k)
        for k in list(held):
            yield body(k)

    rest = [c for c in docs.columns if c != text_col]
    cols = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]
    text = F.col(f"`{text_col}`").cast("string").cast("binary").alias("__text")
    kind = F.lit(0) if kind is None else kind
    return written(docs.select(*cols, text, kind.cast("int").alias("__kind")).mapInArrow(pack, STAGED), "batches")


def opened(body) -> pa.Table:
    raw = zstandard.ZstdDecompressor().decompress(body, max_output_size=1 << 31)
    return pa.ipc.open_stream(raw).read_all().combine_chunks()


def owners_for(staged: DataFrame, bytes_per_owner: int) -> int:
    """How many owner tasks keep each one's share of the text below ``bytes_per_owner``."""
    total = staged.agg(F.sum("n_bytes")).first()[0] or 0
    return max(1, -(-total // bytes_per_owner))


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte planes apart, so that high bytes compress to nothing."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def spread(blob: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype)


def owner_cuts(keys: np.ndarray, owners: int) -> np.ndarray:
    """Where each owner's range begins in sorted ``keys``: equal ranges of the 64-bit space."""
    edges = np.array([(i << 64) // owners for i in range(owners)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


ASKED = "owner long, batch_id long, keys binary, counts binary"
ANSWERED = "batch_id long, owner long, codes binary"


def ask(staged: DataFrame, questions, owners: int) -> DataFrame:
    """``questions(table, kind)`` gives {group: (sorted distinct keys, counts)}; one row per batch and owner."""

    def run(batches):
        for rows in batches:
            for r in rows.to_pylist():
                out = []
                for group, (keys, counts) in questions(opened(r["body"]), r["kind"]).items():
                    cuts = owner_cuts(keys, owners)
                    for o in np.flatnonzero(np.diff(cuts)).tolist():
                        part = slice(cuts[o], cuts[o + 1])
                        out.append((group * owners + o, r["batch_id"], packed(keys[part]), squeezed(counts[..., part])))
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["owner", "batch_id", "keys", "counts"])

    return staged.mapInArrow(run, ASKED)


def merged(rows: pa.Table):
    """The entries an owner got: distinct keys, each entry's place among them, and each batch's end."""
    parts = [unpacked(b) for b in rows["keys"].to_pylist()]
    keys, place = np.unique(np.concatenate(parts), return_inverse=True)
    return keys, place, np.cumsum([len(p) for p in parts])


def repeated_codes(asked: DataFrame, many: int) -> DataFrame:
    """Per asked key a byte: 0 it occurs once in all, 1 more often, 2 more than ``many`` times."""

    def answer(rows: pa.Table) -> pa.Table:
        keys, place, ends = merged(rows)
        counts = np.concatenate([spread(b, np.uint32) for b in rows["counts"].to_pylist()])
        total = np.bincount(place, weights=counts, minlength=len(keys))
        code = ((total > 1).astype(np.uint8) + (total > many))[place]
        blobs = [squeezed(c) for c in np.split(code, ends[:-1])]
        return pa.table({"batch_id": rows["batch_id"], "owner": rows["owner"], "codes": pa.array(blobs, pa.binary())})

    return asked.groupBy("owner").applyInArrow(answer, ANSWERED)


def in_order(answers: pa.Table, dtype) -> np.ndarray:
    """A batch's answers in the order of its sorted keys (owners hold rising key ranges)."""
    order = np.argsort(answers["owner"].to_numpy(), kind="stable")
    blobs = answers["codes"].to_pylist()
    return np.concatenate([spread(blobs[i], dtype) for i in order]) if len(order) else np.empty(0, dtype)
