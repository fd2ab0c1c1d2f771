"""SimHash near-dedup: fingerprints within a few bits are linked; linked documents form groups.

Gray-order hierarchical index.  Equal fingerprints are one entry.  Two fingerprints within ``bits``
differing bits agree on at least one of ``bits + 1`` blocks of bits, so entries are dealt by (block,
value); a value held by too many entries is dealt again by the blocks of the remaining bits, and what
is still too large then is cut in slices that are searched pair by pair.
A task's group holds several values of a block.  Its entries, turned so that the block comes first,
are sorted by Gray rank, so that neighbours differ in few bits; every node of the index keeps the bits on which all entries below it agree and that no node above holds.  A query
adds up its differences from the root down and drops a node, with all entries below, once they
exceed ``bits``.  A group emits a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, slices, written
from .components import components

_FAN = 8
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, width: int) -> int:
    """64 bits, each set if set in more than half of the shingles' hashes; no words: 0."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = np.array([xxh64_intdigest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])
        spans = zip(starts[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist())
        hashes = np.array([xxh64_intdigest(joined[a:z], 42) for a, z in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``bits`` (the fingerprint as a signed long) of every whole text."""

    def run(batches):
        for rows in slices(batches):
            prints = np.array([fingerprint(t, width) for t in rows.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(prints.view(np.int64))], ["doc_id", "bits"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, bits long")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each value in the Gray sequence: bit i is the parity of bits i and above."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(values: np.ndarray):
    """Nodes from the leaves up: (first child, bits that all below share, their values, bits new here)."""
    levels = [(values, np.full(len(values), _FULL))]
    while len(levels[-1][0]) > _FAN:
        value, mask = levels[-1]
        cuts = np.arange(0, len(value), _FAN)
        low = np.bitwise_and.reduceat(value, cuts)
        high = np.bitwise_or.reduceat(value, cuts)
        levels.append((low, np.bitwise_and.reduceat(mask, cuts) & ~(low ^ high)))
    return levels


def gray_links(values: np.ndarray, bits: int, block: int = 1 << 12) -> np.ndarray:
    """Pairs (i, j), i < j, of places of sorted distinct ``values`` within ``bits`` bits.

    Queries go down the index in blocks; the pairs of a block are given as they are found.
    """
    levels = _levels(values)
    for at in range(0, len(values), block):
        query = np.arange(at, min(at + block, len(values)))
        top = len(levels[-1][0])
        q, node = np.repeat(query, top), np.tile(np.arange(top), len(query))
        spent = np.zeros(len(q), np.int64)
        above = np.zeros(len(q), np.uint64)
        for depth in range(len(levels) - 1, -1, -1):
            value, mask = levels[depth]
            # entries of a node end before (node + 1) * _FAN ** depth; a pair is found from its smaller place
            near = (node + 1) * _FAN**depth > q + 1
            q, node, spent, above = q[near], node[near], spent[near], above[near]
            spent = spent + np.bitwise_count((values[q] ^ value[node]) & mask[node] & ~above)
            near = spent <= bits
            q, node, spent, above = q[near], node[near], spent[near], mask[node[near]]
            if depth:
                child = (node[:, None] * _FAN + np.arange(_FAN)).ravel()
                q, spent, above = np.repeat(q, _FAN), np.repeat(spent, _FAN), np.repeat(above, _FAN)
                there = child < len(levels[depth - 1][0])
                q, node, spent, above = q[there], child[there], spent[there], above[there]
        found = node > q
        yield np.stack([q[found], node[found]], axis=1)


class Forest:
    """Union-find over places; ``join`` keeps the links that connect something new."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, pairs: np.ndarray) -> list[tuple[int, int]]:
        kept = []
        for i, j in pairs.tolist():
            a, b = self.root(i), self.root(j)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                kept.append((i, j))
        return kept


def _blocks(free: list[int], parts: int) -> list[list[int]]:
    """Bit places dealt into ``parts`` blocks of neighbours."""
    return [b.tolist() for b in np.array_split(np.array(free), parts)]


def _masked(places: list[int]) -> int:
    m = sum(1 << p for p in places)
    return m - (1 << 64) if m >= 1 << 63 else m


@lru_cache(maxsize=None)
def _free(path: int, parts: int) -> tuple[int, ...]:
    """Bit places outside the blocks of ``path``: 1, then a digit to the base ``parts`` for each deal."""
    if path == 1:
        return tuple(range(64))
    before = list(_free(path // parts, parts))
    own = set(_blocks(before, parts)[path % parts])
    return tuple(p for p in before if p not in own)


def dealt(entries: DataFrame, bits: int, most: int, levels: int = 4) -> DataFrame:
    """Entries in groups (``block``, ``path``, ``part``, ``pair``) such that linked ones share a group.

    Each entry is dealt once per block of bits, and groups above ``most`` again by the blocks of
    their other bits, up to ``levels`` deals.  A group that is at most a few times too large, or too
    large after the last deal, is cut by hash into slices of half of ``most``: a group per pair.
    """
    parts = bits + 1
    key = ["block", "path", "part"]

    def again(batches):
        for rows in batches:
            values, path = rows["bits"].to_numpy(), rows["path"].to_numpy()
            for own in np.unique(path).tolist():
                at = np.flatnonzero(path == own)
                some = rows.take(pa.array(at))
                for j in range(parts):
                    new = own * parts + j
                    held = np.int64(_masked([p for p in range(64) if p not in set(_free(new, parts))]))
                    block = some["block"] if own > 1 else pa.array(np.full(len(at), j, np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [some["bits"], some["rep"], block, pa.array(np.full(len(at), new)), pa.array(values[at] & held)], ["bits", "rep", *key]
                    )

    def deal(rows: DataFrame) -> DataFrame:
        return rows.select("bits", "rep", "block", "path", "part").mapInArrow(again, "bits long, rep long, block int, path long, part long")

    now = deal(entries.select("bits", "rep", F.lit(0).alias("block"), F.lit(1).cast("long").alias("path"), F.lit(0).cast("long").alias("part")))
    out = []
    for level in range(1, levels + 1):
        sizes = now.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > most)
        large = written(sizes.select(*key, F.ceil(2 * F.col("n") / most).alias("slices")), "large-groups")
        out.append(now.join(large, key, "left_anti").select("bits", "rep", *key, F.lit(0).cast("long").alias("pair")))
        if large.isEmpty():
            break
        last = level == levels or min(len(_free(parts**level + i, parts)) for i in range(parts**level)) < parts
        few = F.lit(last) | (F.col("slices") <= parts + 1)
        cut = now.join(large.where(few), key).withColumn("own", F.pmod(F.xxhash64("bits", F.lit(5)), "slices"))
        cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))).where("own <> other")
        out.append(cut.select("bits", "rep", *key, (1 + F.least("own", "other") * F.col("slices") + F.greatest("own", "other")).alias("pair")))
        if last:
            break
        now = written(deal(now.join(large.where(~few), key, "left_semi")), "dealt-again")
    return reduce(DataFrame.unionByName, out)


def link_fingerprints(prints: DataFrame, bits: int = 3, most: int = 20_000, group_rows: int = 500) -> DataFrame:
    """``node``, ``component_id`` over the smallest ids of distinct fingerprints that have a link."""
    entries = written(prints.groupBy("bits").agg(F.min("doc_id").alias("rep")).where("rep is not null"), "fingerprints")

    owners = max(1, -(-entries.count() // group_rows))
    turn = [(64 - max(b) - 1) % 64 for b in _blocks(list(range(64)), bits + 1)]

    def search(rows: pa.Table) -> pa.Table:
        values = rows["bits"].to_numpy().view(np.uint64)
        left = np.uint64(turn[rows["block"][0].as_py()])
        turned = (values << left) | (values >> (np.uint64(64) - left)) if left else values.copy()
        order = np.argsort(gray_rank(turned), kind="stable")
        turned, reps = turned[order], rows["rep"].to_numpy()[order]
        forest = Forest(len(turned))
        block = min(1 << 12, max(64, (1 << 24) // len(turned)))  # bounds the links listed at once
        kept = [p for pairs in gray_links(turned, bits, block) for p in forest.join(pairs)]
        at = np.array(kept, np.int64).reshape(-1, 2)
        return pa.table({"a": reps[at[:, 0]], "b": reps[at[:, 1]]})

    owner = F.pmod(F.xxhash64("part"), F.lit(owners))
    groups = dealt(entries, bits, most).select("bits", "rep", "block", "path", "pair", owner.alias("owner")).groupBy("block", "path", "pair", "owner")
    return components(groups.applyInArrow(search, "a long, b long"))


def simhash_groups(docs: DataFrame, width: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text", most: int = 20_000) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits), ``component_id``: one row per row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other.  Texts of fewer words than
    ``width`` are one shingle.  Equal fingerprints are always linked.  Rows that repeat an id each
    give a row; a null id takes part through the group's smallest id, and has a null
    ``component_id`` if there is none.  Extra columns are ignored; an empty table gives no rows.
    """
    prints = written(fingerprints(docs, width, id_col, text_col), "prints")
    found = link_fingerprints(prints, bits, most)
    least = prints.groupBy("bits").agg(F.min("doc_id").alias("rep"))
    of_print = least.join(found, F.col("rep") == F.col("node"), "left").select("bits", F.coalesce("component_id", "rep").alias("component_id"))
    hexed = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return prints.join(of_print, "bits").select("doc_id", hexed.alias("fingerprint"), "component_id")
