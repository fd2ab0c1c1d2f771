"""Line dedup: lines in runs of two or more that occur earlier in the corpus are removed.

``line_run_dedup`` takes every pair of neighbouring lines as a unit.  Pairs that repeat are compared
by their bytes; the first stays.  A run of repeated lines is the union of its pairs, so it goes from
its first line to its last, whatever its neighbours are.

``line_dedup`` removes repeated content-defined chunks only: a rolling hash over the hashes of the
last lines decides where a chunk ends, so a chunk repeats only if both of its ends lie in the copied
lines, and most short passages stay.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from xxhash import xxh64_intdigest

from .spans import Units, cut_spans
from .substring_dedup import mixed, word_ids


def chunk_ends(hashes: np.ndarray, roll: int, every: int) -> list[int]:
    """Line numbers (exclusive) at which the chunks of one document end.

    A chunk ends after a line whose last ``roll`` line hashes meet the condition, once it has two
    lines; ``every`` is the mean distance of such lines.
    """
    n = len(hashes)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for j in range(roll):
            shifted = np.zeros(n, np.uint64)
            shifted[j:] = hashes[: n - j]
            h = h * np.uint64(0x100000001B3) + shifted
    ends, last = [], 0
    for i in np.flatnonzero(mixed(h) % np.uint64(every) == 0).tolist():
        if i + 1 - last >= 2:
            ends.append(i + 1)
            last = i + 1
    if last < n:
        ends.append(n)
    return ends


def chunked(texts: list[bytes], roll: int, every: int):
    """(document, first line, lines) of every chunk, in order."""
    lines = [t.split(b"\n") for t in texts]
    ids, distinct = word_ids([x for own in lines for x in own])
    hashes = np.array([xxh64_intdigest(x, 42) for x in distinct], np.uint64)[ids]
    at = 0
    for d, own in enumerate(lines):
        first = 0
        for end in chunk_ends(hashes[at : at + len(own)], roll, every):
            yield d, first, own[first:end]
            first = end
        at += len(own)


def paired(texts: list[bytes]) -> Units:
    """Every pair of neighbouring lines of a document, but for pairs of blank lines."""
    joined = b"\n".join(texts)
    lines = joined.split(b"\n")
    counts = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    offset = np.concatenate([[0], np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + 1)])
    ids, distinct = word_ids(lines)
    del lines
    hashes = np.array([xxh64_intdigest(x, 42) for x in distinct], np.uint64)[ids]
    blank = np.array([not x.strip() for x in distinct], bool)[ids]
    doc = np.repeat(np.arange(len(texts)), counts)
    at = np.flatnonzero((doc[1:] == doc[:-1]) & ~(blank[1:] & blank[:-1]))
    with np.errstate(over="ignore"):
        key = mixed(hashes[at] * np.uint64(0x100000001B3) + hashes[at + 1])
    starts = np.cumsum(counts) - counts
    return Units(key, doc[at], at - starts[doc[at]], np.ones(len(at), np.int64), lambda i, j: joined[offset[at[i]] : offset[at[i] + 2] - 1])


def first_seen(bodies: list[bytes]) -> list[int]:
    """For spans of one key in order: 1 if the same bytes came earlier."""
    seen: set[bytes] = set()
    return [1 if b in seen or seen.add(b) else 0 for b in bodies]


def repeated_lines(lines: list[bytes], pairs: np.ndarray) -> np.ndarray:
    """Which lines go, given where the pairs begin that occur earlier."""
    hit = np.zeros(len(lines) + 1, bool)
    hit[pairs] = True
    for i in np.flatnonzero(hit[1:] & ~hit[:-1]).tolist():
        # in three equal lines the second pair only overlaps the first, which stays
        if lines[i] == lines[i + 1] == lines[i + 2]:
            hit[i + 1] = False
    gone = hit[:-1].copy()
    gone[1:] |= hit[:-2]
    solid = [i for i, x in enumerate(lines) if x.strip()]
    for a, z in zip(solid, solid[1:]):
        if z - a > 3 and gone[a + 1] and gone[z - 1]:
            gone[a + 1 : z] = True
    return gone


def line_run_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = 6 << 20,
    bytes_per_owner: int = 32 << 20,
) -> DataFrame:
    """``docs`` without runs of lines that occur earlier, and ``n_lines``, ``n_removed_lines``.

    Lines end at a line feed.  A line goes if it and a neighbour, not both blank, occur earlier as a
    pair that does not overlap them; blank lines between such lines go with them.  A line without a
    repeated neighbour stays.  Null texts, shared and null ids, other columns and empty tables: as
    in ``line_dedup``.
    """

    def remove(texts, no, start):
        order = np.argsort(no, kind="stable")
        no, start = no[order], start[order]
        cuts = np.searchsorted(no, np.arange(len(texts) + 1))
        n_lines = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
        removed = np.zeros(len(texts), np.int64)
        out = list(texts)
        for d in np.flatnonzero(np.diff(cuts)).tolist():
            lines = texts[d].split(b"\n")
            gone = repeated_lines(lines, start[cuts[d] : cuts[d + 1]])
            out[d] = b"\n".join([x for x, g in zip(lines, gone.tolist()) if not g])
            removed[d] = gone.sum()
        return out, (n_lines, removed)

    return cut_spans(docs, text_col, id_col, paired, first_seen, remove, "n_lines long, n_removed_lines long", batch_bytes, bytes_per_owner, 1 << 62)


def line_dedup(
    docs: DataFrame,
    roll: int = 2,
    every: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = 6 << 20,
    bytes_per_owner: int = 32 << 20,
) -> DataFrame:
    """``docs`` without multi-line chunks that occur earlier, and ``n_lines``, ``n_removed_lines``.

    Lines end at a line feed; a chunk of blank lines or of one line is never removed.  Null texts
    stay null; null and empty texts have one empty line.  Rows that share an id count as
    documents in the order in which they were staged; a null id counts as the largest.  All other
    columns pass through, but for any called like the two new ones; an empty table gives an empty
    result.
    """

    def units(texts):
        key, no, start, bodies = [], [], [], []
        for d, first, lines in chunked(texts, roll, every):
            body = b"\n".join(lines)
            if len(lines) > 1 and body.strip():
                key.append(xxh64_intdigest(body, 11))
                no.append(d)
                start.append(first)
                bodies.append(body)
        return Units(np.array(key, np.uint64), np.array(no, np.int64), np.array(start, np.int64), np.ones(len(key), np.int64), lambda i, j: bodies[i])

    def remove(texts, no, start):
        gone = set(zip(no.tolist(), start.tolist()))
        hit = {d for d, _ in gone}
        kept: dict[int, list] = {}
        n_lines = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
        removed = np.zeros(len(texts), np.int64)
        for d, first, lines in chunked([t if d in hit else b"" for d, t in enumerate(texts)], roll, every) if hit else ():
            if d in hit:
                if (d, first) in gone:
                    removed[d] += len(lines)
                else:
                    kept.setdefault(d, []).extend(lines)
        out = [b"\n".join(kept.get(d, [])) if d in hit else t for d, t in enumerate(texts)]
        return out, (n_lines, removed)

    return cut_spans(docs, text_col, id_col, units, first_seen, remove, "n_lines long, n_removed_lines long", batch_bytes, bytes_per_owner, 1 << 62)
