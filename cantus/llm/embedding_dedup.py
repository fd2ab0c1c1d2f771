"""Embedding near-dedup with an inverted multi-index.

Vectors are made unit length and cut in halves; each half has its own codebook (k-means on a
bounded sample), and a vector lies in the cell of its two nearest codes: a product grid.  As a
query, a vector visits cells in the order of their bound (multi-sequence traversal): for either
half, how far a vector of a cell must at least be from the query, by the plane between the query's
nearest code and the cell's.  Cells whose squared bounds sum to more than the squared distance of
the threshold cannot hold a partner, so the traversal ends there at a recall of 1; a smaller target
recall ends it at that share of the squared distance.  Candidates of visited cells are verified by
exact cosines.  Equal vectors of a label are one entry with a count.  Vectors of each length have
codebooks, cells and groups of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components
from .simhash import Forest

ENTRY = "rep long, label long, n long, vector array<double>"
CELLED = ENTRY + ", size int, cell long"
_ROWS = 1_024  # vectors whose bounds or cosines are worked out at once
_SENT = 4_096  # copies of vectors that a task hands on at once


def usable(vec_col: str, label_col: str):
    """True for vectors that can link: with a label, not null, no null or non-finite part, not zero."""
    v = F.col(vec_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(label_col).isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def entries(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """Distinct usable (label, vector) with the smallest id and the number of rows."""
    held = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vector"))
    # -0.0 and 0.0 are one value
    held = held.where(usable("vector", "label")).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    return held.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")).where("rep is not null").select("rep", "label", "n", "vector")


def k_means(points: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Plain Lloyd rounds from distinct sampled points; empty codes stay where they are."""
    start = np.unique(points, axis=0)
    codes = start[np.random.default_rng(seed).permutation(len(start))[:k]]
    for _ in range(rounds):
        near = (points**2).sum(1)[:, None] - 2 * points @ codes.T + (codes**2).sum(1)
        own = near.argmin(axis=1)
        for c in range(len(codes)):
            if (own == c).any():
                codes[c] = points[own == c].mean(axis=0)
    return codes


def plane_bounds(half: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest code, and per code the squared least distance of its region beyond the dividing plane."""
    square = np.maximum((half**2).sum(1)[:, None] - 2 * half @ codes.T + (codes**2).sum(1), 0)
    near = square.argmin(axis=1)
    between = np.stack([np.sqrt(((code - codes) ** 2).sum(1)) for code in codes])[near]
    least = (square - square[np.arange(len(half)), near][:, None]) / np.maximum(2 * between, 1e-12)
    return near, np.where(between > 0, np.maximum(least, 0), 0) ** 2


def visits(bound1: np.ndarray, bound2: np.ndarray, limit: float):
    """Multi-sequence traversal of one query: cells (i, j) by rising sum of bounds, up to ``limit``."""
    from heapq import heappop, heappush

    order1, order2 = np.argsort(bound1, kind="stable"), np.argsort(bound2, kind="stable")
    a, b = bound1[order1].tolist(), bound2[order2].tolist()
    heap, seen = [(a[0] + b[0], 0, 0)], {(0, 0)}
    while heap:
        cost, i, j = heappop(heap)
        if cost > limit:
            return
        yield int(order1[i]), int(order2[j])
        for ni, nj in ((i + 1, j), (i, j + 1)):
            if ni < len(a) and nj < len(b) and (ni, nj) not in seen:
                seen.add((ni, nj))
                heappush(heap, (a[ni] + b[nj], ni, nj))


def visited(bounds1: np.ndarray, bounds2: np.ndarray, k: int, limit: float, most: int = _SENT):
    """Places of queries and the cells that they visit, at most ``most`` at a time: a query may visit every cell."""
    at, cells = [], []
    for row, (x, y) in enumerate(zip(bounds1, bounds2)):
        for i, j in visits(x, y, limit):
            at.append(row)
            cells.append(i * k + j)
            if len(at) == most:
                yield pa.array(at, pa.int64()), np.array(cells, np.int64)
                at, cells = [], []
    if at:
        yield pa.array(at, pa.int64()), np.array(cells, np.int64)


def codebooks(held: DataFrame, cell_rows: int, sample: int) -> dict[int, list[np.ndarray]]:
    """Per vector length the codes of either half; lengths left out have one cell a label.

    About ``sample`` points are fitted in all, dealt to the lengths by the size of their codebooks.
    """
    length = F.size("vector")
    rows = held.groupBy(length.alias("size")).agg(F.count("*").alias("n"), F.count_distinct("label").alias("labels")).collect()
    wanted = {r.size: int(np.ceil(np.sqrt(r.n / r.labels / cell_rows))) for r in rows if r.size > 1}
    wanted = {s: k for s, k in wanted.items() if k > 1}
    if not wanted:
        return {}
    quota = {s: max(1, sample * k // sum(wanted.values())) for s, k in wanted.items()}
    parts = 1_000_000  # by the share of a hash, so that tasks together send little more than the quotas
    counts = {r.size: r.n for r in rows}
    share = F.create_map([F.lit(x) for s, q in quota.items() for x in (s, min(parts, -(-12 * parts * q // (10 * counts[s]))))])
    hashed = F.xxhash64("rep", F.lit(9))
    picked: dict[int, list] = {}
    for r in held.where(F.pmod(hashed, F.lit(parts)) < F.element_at(share, length)).select(hashed.alias("h"), "rep", "vector").collect():
        picked.setdefault(len(r.vector), []).append(r)
    codes = {}
    for size, found in picked.items():
        points = np.array([r.vector for r in sorted(found, key=lambda r: (r.h, r.rep))[: quota[size]]], float)
        points /= np.abs(points).max(axis=1, keepdims=True)
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        k = min(wanted[size], max(len(points) // 8, 1))
        codes[size] = [k_means(points[:, half], k, 8, 1) for half in (slice(0, size // 2), slice(size // 2, None))]
    return codes


def embedding_groups(
    vectors: DataFrame,
    threshold: float = 0.98,
    recall: float = 1.0,
    cell_rows: int = 64,
    sample: int = 20_000,
    slice_rows: int = 2_000,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per row of ``vectors``.

    Rows link if their labels are equal and not null and their cosine is at least ``threshold``.
    Null, zero and non-finite vectors and null labels link with nothing; their component is their own
    id.  Equal vectors of a label always link; vectors of different lengths never do.  Rows that
    repeat an id give a row each.  Extra columns are ignored; an empty table gives no rows.
    ``sample`` bounds the rows on which the codebooks of all lengths are fitted (every row is
    indexed); ``cell_rows`` sets their size from the rows of a length; ``slice_rows`` bounds the
    blocks compared, on the side of a cell's rows and, at ten times as many, of those that visit it.
    """
    held = written(entries(vectors, id_col, vec_col, label_col), "vectors")
    codes = codebooks(held, cell_rows, sample)
    limit = (2 - 2 * threshold + 1e-9) * recall

    def by_length(batches):
        """Rows of one length: the rows, their length, codes a half, and the bounds of either half."""
        for rows in (batch.slice(s, _ROWS) for batch in batches for s in range(0, batch.num_rows, _ROWS)):
            sizes = pc.list_value_length(rows["vector"])
            for size in pc.unique(sizes).to_pylist():
                part, cut = rows.filter(pc.equal(sizes, size)), size // 2
                first, second = codes.get(size) or (np.zeros((1, cut)), np.zeros((1, size - cut)))
                vec = unit(part)
                yield part, size, len(second), plane_bounds(vec[:, :cut], first), plane_bounds(vec[:, cut:], second)

    def unit(rows) -> np.ndarray:
        vec = rows["vector"].combine_chunks() if isinstance(rows, pa.Table) else rows["vector"]
        vec = vec.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows.num_rows, -1)
        vec /= np.abs(vec).max(axis=1, keepdims=True)
        return vec / np.linalg.norm(vec, axis=1, keepdims=True)

    def celled(part, size: int, cell: np.ndarray) -> pa.RecordBatch:
        sizes = pa.array(np.full(part.num_rows, size, np.int32))
        return pa.RecordBatch.from_arrays([*part.columns, sizes, pa.array(cell)], [*part.schema.names, "size", "cell"])

    def place(batches):
        for part, size, k, (a, _), (b, _) in by_length(batches):
            yield celled(part, size, a * k + b)

    def route(batches):
        for part, size, k, (_, first), (_, second) in by_length(batches):
            for at, cells in visited(first, second, k, limit):
                yield celled(part.take(at), size, cells)

    indexed = written(held.mapInArrow(place, CELLED), "cells")
    # a large cell: its rows in slices, its queries in chunks, each pair of them one group; any vector of the label may visit it
    own = indexed.groupBy("size", "label", "cell").agg(F.count("*").alias("rows"))
    visitors = own.groupBy("size", "label").agg(F.sum("rows").alias("visitors"))
    parts = own.join(visitors, ["size", "label"]).select(
        "size", "label", "cell", F.ceil(F.col("rows") / slice_rows).alias("slices"),
        F.greatest(F.ceil(F.col("rows") / slice_rows), F.ceil(F.col("visitors") / (10 * slice_rows))).alias("chunks"),
    )
    parts = written(parts, "cell-sizes")

    def dealt(rows, own: str, other: str, seed: int):
        sized = rows.join(parts, ["size", "label", "cell"])
        every = F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1)
        return sized.select("rep", "label", "n", "vector", "size", "cell", F.pmod(F.xxhash64("rep", F.lit(seed)), f"{own}s").alias(own), F.explode(every).alias(other))

    index = dealt(indexed, "slice", "chunk", 2)
    asked = dealt(held.mapInArrow(route, CELLED), "chunk", "slice", 3)
    asked = asked.select([F.col(c).alias(c) for c in asked.columns])
    keys = ["size", "label", "cell", "slice", "chunk"]

    def verify(queries: pa.Table, stored: pa.Table) -> pa.Table:
        out = {"a": [], "b": [], "n": []}
        if queries.num_rows and stored.num_rows:
            own, other = queries["rep"].to_numpy(), stored["rep"].to_numpy()
            weight, right = stored["n"].to_numpy(), unit(stored).T
            nodes = np.unique(np.concatenate([own, other]))
            forest = Forest(len(nodes))
            at_own, at_other = np.searchsorted(nodes, own), np.searchsorted(nodes, other)
            for s in range(0, len(own), _ROWS):
                hit = (unit(queries.slice(s, _ROWS)) @ right >= threshold) & (own[s : s + _ROWS, None] != other)
                links = hit @ weight
                for i in np.flatnonzero(links).tolist():  # one row per query: its links here
                    out["a"].append(int(own[s + i]))
                    out["b"].append(None)
                    out["n"].append(int(links[i]))
                x, y = np.nonzero(hit)
                for i, j in forest.join(np.stack([at_own[s + x], at_other[y]], axis=1)):
                    out["a"].append(int(nodes[i]))
                    out["b"].append(int(nodes[j]))
                    out["n"].append(0)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    found = asked.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInArrow(verify, "a long, b long, n long")
    found = written(found, "links")
    linked = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    groups = components(found.where("b is not null").select("a", "b"))
    info = held.join(linked, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")
    )
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vector"))
    base = base.withColumn("usable", usable("vector", "label")).withColumn("vector", F.when(F.col("usable"), F.transform("vector", lambda x: x + F.lit(0.0))))
    alone = base.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    rows = base.where("usable").join(info, ["label", "vector"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return rows.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
