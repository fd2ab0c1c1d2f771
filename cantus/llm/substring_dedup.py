"""Substring dedup: words covered by a window of words that occurs earlier are removed.

Windows grouped by minimizer, in place of suffix trees.  Every window has one anchor, the place of its
smallest hashed word group (leftmost on ties), so equal windows have equal anchors at equal offsets.
Neighbouring windows that share an anchor form one unit, whose bytes hold all of them.  Units are
split by the anchor's word group, or for very frequent groups by the whole window.  The units of one
word group fit a task, where a set of windows finds the repeats; the first stays.  Word groups that
occur once are never sent.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from xxhash import xxh64_intdigest

from .spans import Units, cut_spans

_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits (multiply and shift, twice)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * _MIX
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def word_ids(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Each word's number, and the distinct words by number."""
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    return ids, list(known)


def units_of(texts: list[bytes], window: int, group: int) -> Units:
    words: list[bytes] = []
    ends = []
    for t in texts:
        words += t.split()
        ends.append(len(words))
    n, w = len(words), window - group + 1
    none = np.empty(0, np.int64)
    if n < window:
        return Units(none.astype(np.uint64), none, none, none, None)
    ids, distinct = word_ids(words)
    joined = b" ".join(words)
    offset = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)])
    del words  # the word objects are most of a task's memory
    hashes = np.array([xxh64_intdigest(x, 42) for x in distinct], np.uint64)[ids]
    with np.errstate(over="ignore"):
        grams = np.zeros(n - group + 1, np.uint64)
        for j in range(group):
            grams = grams * np.uint64(0x100000001B3) + hashes[j : n - group + 1 + j]
    grams = mixed(grams)
    slide = np.lib.stride_tricks.sliding_window_view(grams, w)
    anchor = np.concatenate([slide[i : i + 65536].argmin(axis=1) + np.arange(i, min(i + 65536, len(slide))) for i in range(0, len(slide), 65536)])
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(np.append(starts, n)))
    first = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])  # windows inside one document
    if not len(first):
        return Units(none.astype(np.uint64), none, none, none, None)
    own = anchor[first]
    begins = np.flatnonzero(np.diff(own, prepend=-1))
    count = np.diff(np.append(begins, len(first)))
    at = first[begins]
    begin, end = offset[at].tolist(), (offset[at + count + window - 1] - 1).tolist()

    def body(i: int, j: int) -> bytes:
        if j < 0:
            return joined[begin[i] : end[i]]
        return joined[offset[at[i] + j] : offset[at[i] + j + window] - 1]

    return Units(grams[own[begins]], doc[at], at - starts[doc[at]], count, body)


def word_starts(text: bytes) -> np.ndarray:
    """Where the words of a text begin."""
    codes = np.frombuffer(text, np.uint8)
    blank = (codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D))
    return np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))


def without(text: bytes, starts: np.ndarray, gone: np.ndarray) -> bytes:
    """``text`` less the words marked ``gone``, each with the white space after it."""
    edges = np.flatnonzero(np.diff(~gone, prepend=False, append=False)).reshape(-1, 2)
    bounds = np.append(starts, len(text))
    return b"".join([text[: starts[0]], *[text[a:z] for a, z in bounds[edges].tolist()]])


def subtree(bodies: list[bytes], window: int) -> list[int]:
    """For units of one word group in order: a mask of the windows that occur earlier."""
    nodes: set[bytes] = set()
    out = []
    for body in bodies:
        offset = [0]
        for w in body.split(b" "):
            offset.append(offset[-1] + len(w) + 1)
        mask = 0
        for j in range(len(offset) - window):
            node = body[offset[j] : offset[j + window] - 1]
            if node in nodes:
                mask |= 1 << j
            else:
                nodes.add(node)
        out.append(mask)
    return out


def substring_dedup(
    docs: DataFrame,
    window: int = 20,
    group: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = 4 << 20,
    bytes_per_owner: int = 16 << 20,
    many: int = 20_000,
) -> DataFrame:
    """``docs`` with repeated words cut from the text, and ``n_words``, ``n_removed`` (of the input).

    A removed word goes with the white space after it.  Null texts stay null and have no words;
    texts shorter than a window stay as they are.  Rows that share an id count as documents in the
    order in which they were staged; a null id counts as the largest.  All other columns pass
    through, but for any called like the two new ones; an empty table gives an empty result.
    ``many``: word groups that occur more often are split by the whole window.
    """

    def remove(texts, no, start):
        order = np.lexsort((start, no))
        no, start = no[order], start[order]
        cuts = np.searchsorted(no, np.arange(len(texts) + 1))
        out, n_words, n_removed = [], np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for d, t in enumerate(texts):
            if cuts[d] == cuts[d + 1]:
                n_words[d] = len(t.split())
                out.append(t)
                continue
            begins = word_starts(t)
            edge = np.zeros(len(begins) + 1, np.int64)
            np.add.at(edge, start[cuts[d] : cuts[d + 1]], 1)
            np.add.at(edge, start[cuts[d] : cuts[d + 1]] + window, -1)
            gone = np.cumsum(edge[:-1]) > 0
            n_words[d], n_removed[d] = len(begins), int(gone.sum())
            out.append(without(t, begins, gone))
        return out, (n_words, n_removed)

    if window - group + 1 > 62 or window <= group:
        raise ValueError("a unit has at most 62 windows")
    return cut_spans(
        docs, text_col, id_col, lambda texts: units_of(texts, window, group), lambda bodies: subtree(bodies, window), remove,
        "n_words long, n_removed long", batch_bytes, bytes_per_owner, many,
    )
