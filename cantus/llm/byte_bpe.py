"""Byte-level BPE encoding and decoding with a local rank file.

Each task reads texts in bounded slices and encodes them with tiktoken; no shuffle.  A text is first
cut at safe places: before a space that follows a character other than white space.  No match of the
split pattern holds such a character followed by a space, and the alternatives that can end there do
not look ahead, so the cut parts have just the matches of the whole text.  Parts are one word as a
rule; their ids are kept in a bounded cache.
"""

from __future__ import annotations

import base64
import hashlib
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, slices

_LOADED: dict = {}
_SAFE = re.compile(r"\S(?= )")
_UNSAFE = re.compile(r"\s ")
_KNOWN_PARTS = 400_000


def encoding(rank_file: str, pattern: str):
    """The encoding of a rank file and a cache of parts, loaded once per Python worker."""
    if (rank_file, pattern) not in _LOADED:
        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _LOADED[rank_file, pattern] = enc, {}
    return _LOADED[rank_file, pattern]


def parts(text: str, size: int) -> list[str]:
    """The text cut at safe places: at every space if all are safe, else about every ``size`` characters."""
    if not _UNSAFE.search(text):
        first, *rest = text.split(" ")
        return [first, *[" " + w for w in rest]]
    out, start = [], 0
    while len(text) - start > size and (m := _SAFE.search(text, start + size - 1)):
        out.append(text[start : m.end()])
        start = m.end()
    return [*out, text[start:]]


def encode_text(text: str, loaded, size: int = 1 << 16) -> list[int]:
    enc, known = loaded
    cut = parts(text, size)
    try:
        return list(chain.from_iterable(map(known.__getitem__, cut)))
    except KeyError:
        pass
    out: list[int] = []
    for part in cut:
        ids = known.get(part)
        if ids is None:
            ids = enc.encode_ordinary(part)
            if len(part) < 64:
                if len(known) >= _KNOWN_PARTS:
                    known.clear()
                known[part] = tuple(ids)
        out += ids
    return out


def encode(docs: DataFrame, rank_file: str, pattern: str, part_chars: int = 1 << 16) -> DataFrame:
    """``doc_id``, ``ids`` (array<int>) of every text, whole; a null or empty text has no ids."""

    def run(batches):
        loaded = encoding(rank_file, pattern)
        for rows in slices(batches):
            ids = [encode_text(t.decode(), loaded, part_chars) for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``doc_id``, ``bytes``: the raw bytes of ``ids``, which need not end at a character (null ids: empty)."""

    def run(batches):
        enc, _ = encoding(rank_file, pattern)
        for rows in batches:
            raw = [enc.decode_bytes(ids or []) for ids in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str, part_chars: int = 1 << 16) -> DataFrame:
    """Encode and decode in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Null and empty texts: 0 tokens and the digests of nothing.  Repeated rows each give a row; extra
    columns are ignored; an empty table gives an empty result.  The decoded bytes come from the ids.
    """

    def run(batches):
        enc, _ = loaded = encoding(rank_file, pattern)
        text_of = [str(i) for i in range(enc.n_vocab)]
        for rows in slices(batches):
            n, of_ids, of_bytes = [], [], []
            for t in rows.column(1).to_pylist():
                ids = encode_text(t.decode(), loaded, part_chars)
                n.append(len(ids))
                of_ids.append(hashlib.sha256(" ".join(map(text_of.__getitem__, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(enc.decode_bytes(ids)).hexdigest())
            cols = [rows.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
