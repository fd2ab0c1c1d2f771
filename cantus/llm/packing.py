"""Best-fit packing of tokenised documents into sequences of bounded length.

Hierarchical residual packing: every block of pieces is packed best-fit on its own; nearly full
bins are closed, underfull bins become the items of the next round, where the nodes of a merge tree
take the open bins of several lower nodes and pack them best-fit again.  A node never holds more
than ``node_items`` bins, so neither a task nor the driver sees all of them; when the open bins fit
one node that node is the root.  Bins carry the list of their pieces (at most one per token), so no
join is needed to find where a piece went.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, slices, written

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_MEMBER = "struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long>"
_BIN = f"fill int, members array<{_MEMBER}>"
_LOADED: dict = {}
_KNOWN_WORDS = 800_000
# fixed values: the splitting pattern of the vocabulary file, for lower-case ASCII and Latin letters
_LATIN_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017e]+|[0-9]|[!-/:-@\\[-`{-~]+")
# letters whose lower case is one letter of the same range, without marks that compose
_LATIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u0148\u014a-\u0177\u0179-\u017e]+")


def tokenizer(path: str):
    """The tokenizer and its word cache, loaded once per Python worker."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True  # their strings in a text are ordinary text
        _LOADED[path] = tok, {}
    return _LOADED[path]


def _shown() -> dict[int, int]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in plain)}


_SHOWN = _shown()


def _word_ids(word: bytes, tok, known: dict) -> bytes:
    """Ids of one word.

    For printable ASCII and Latin letters the tokenizer's normaliser only lower-cases, and its
    splitter is the pattern above; any other word goes through the library's own steps.
    """
    text = word.decode()
    if _LATIN.fullmatch(text):
        pre = _LATIN_PARTS.findall(text.lower())
        if len(pre) > 1:
            return b"".join([known.get(q := p.encode()) or known.setdefault(q, _word_ids(q, tok, known)) for p in pre])
        shown = pre if text.isascii() else [p.encode().decode("latin-1").translate(_SHOWN) for p in pre]
    else:
        shown = [p for p, _ in tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(text))]
    return array("I", [t.id for p in shown for t in tok.model.tokenize(p)]).tobytes()


def encode_words(texts: list[bytes], path: str) -> list[bytes]:
    """Little-endian unsigned 32-bit ids of each text.

    The tokenizer drops white space and never joins characters across ASCII white space, so the ids
    of a text are those of its words in turn; each distinct word is encoded once while it is cached.
    """
    tok, known = tokenizer(path)
    words = [t.split() for t in texts]
    new = set(chain.from_iterable(words)) - known.keys()
    if len(known) + len(new) > _KNOWN_WORDS:
        known.clear()
        new = set(chain.from_iterable(words))
    for w in new:
        known[w] = _word_ids(w, tok, known)
    return [b"".join(map(known.__getitem__, w)) for w in words]


def pieces(docs: DataFrame, tokenizer_file: str, seq_len: int = 2048, end_id: int = 0) -> DataFrame:
    """Token pieces of every whole text: its ids, then ``end_id``, cut only beyond ``seq_len``."""

    def run(batches):
        end = np.asarray([end_id], "<u4").tobytes()
        for rows in slices(batches):
            out: list[tuple] = []
            for doc, ids in zip(rows.column(0).to_pylist(), encode_words(rows.column(1).to_pylist(), tokenizer_file)):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * seq_len)):
                    cut = ids[at : at + 4 * seq_len]
                    out.append((doc, k, at // 4, len(cut) // 4, zlib.crc32(cut)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return id_and_text(docs).mapInArrow(run, PIECE)


def best_fit(lengths: np.ndarray, size: int) -> np.ndarray:
    """The bin of each item, longest items first, each into the fullest bin that has room."""
    at: list[list[int]] = [[] for _ in range(size + 1)]
    has, n_bins = 0, 0  # bit f: a bin with f free places exists
    out = np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = has >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            b = at[free].pop()
            if not at[free]:
                has &= ~(1 << free)
        else:
            free, b, n_bins = size, n_bins, n_bins + 1
        out[i] = b
        if free > need:
            at[free - need].append(b)
            has |= 1 << (free - need)
    return out


def _merge(fill: np.ndarray, members: pa.ListArray, size: int) -> pa.RecordBatch:
    """Items (bins of the round before) packed into bins, each with its pieces in order."""
    bins = best_fit(fill, size)
    order = np.argsort(bins, kind="stable")
    n = int(bins.max()) + 1
    held = members.take(pa.array(order))
    counts = np.bincount(bins, weights=pc.list_value_length(members).to_numpy(), minlength=n).astype(np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), held.flatten())
    total = np.bincount(bins, weights=fill, minlength=n).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), lists], ["fill", "members"])


def pack(items: DataFrame, seq_len: int = 2048, full_at: float = 0.995, node_items: int = 100_000, max_rounds: int = 12) -> DataFrame:
    """``items`` (the columns of ``pieces``) with ``sequence_id`` and ``offset``; every piece once.

    ``full_at``: bins at least so full are closed.  ``node_items``: most open bins in one tree node.
    """
    spark = items.sparkSession
    need = int(np.ceil(seq_len * full_at))

    def local(batches):
        held: list[pa.RecordBatch] = []
        for batch in chain(batches, [None]):
            if held and (batch is None or sum(b.num_rows for b in held) + batch.num_rows > node_items):
                rows = pa.Table.from_batches(held).combine_chunks()
                one = pa.StructArray.from_arrays([rows[c].combine_chunks() for c in rows.column_names], names=rows.column_names)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(one) + 1), pa.int32()), one)
                yield _merge(rows["length"].to_numpy(), lists, seq_len)
                held = []
            if batch is not None and batch.num_rows:
                held.append(batch)

    def node(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        return pa.Table.from_batches([_merge(rows["fill"].to_numpy(), rows["members"].combine_chunks(), seq_len)])

    level = written(items.mapInArrow(local, _BIN), "pack-0")
    closed = [level.where(F.col("fill") >= need)]
    opened = level.where(F.col("fill") < need)
    before = opened.count()
    for turn in range(1, max_rounds + 1):
        nodes = -(-before // node_items)
        if before < 2:
            break
        lead = F.element_at("members", 1)
        place = F.pmod(F.xxhash64(lead["doc_id"], lead["piece"], F.lit(turn)), F.lit(nodes))
        level = written(opened.groupBy(place.alias("node")).applyInArrow(node, _BIN), f"pack-{turn}")
        closed.append(level.where(F.col("fill") >= need))
        opened = level.where(F.col("fill") < need)
        after = level.count()
        left = opened.count()
        if nodes == 1 or after > 0.999 * before:  # the root, or nothing left to gain
            break
        before = left
    bins = opened
    for part in closed:
        bins = bins.unionByName(part)

    def lay_out(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            flat = lists.flatten()
            n = pc.list_value_length(lists).to_numpy()
            length = flat.field("length").to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(length)])
            first = np.concatenate([[0], np.cumsum(n)])[:-1]
            offset = upto[:-1] - np.repeat(upto[first], n)
            seq = np.repeat(batch.column(0).to_numpy(), n)
            cols = [flat.field(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    numbered = written(bins.select(F.monotonically_increasing_id().alias("sequence_id"), "members"), "packed")
    return numbered.mapInArrow(lay_out, f"{PIECE}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_file: str, seq_len: int = 2048, end_id: int = 0, **options) -> DataFrame:
    """Tokenise and pack whole documents: one row per piece with its place.

    Null and empty texts are the single ``end_id``.  A text of more than ``seq_len`` ids is cut into
    full pieces and a shorter last one; no other text is cut.  Rows that repeat are packed each;
    ties are broken by place in the block; extra columns are ignored; an empty table gives no rows.
    """
    return pack(written(pieces(docs, tokenizer_file, seq_len, end_id), "pieces"), seq_len, **options)
