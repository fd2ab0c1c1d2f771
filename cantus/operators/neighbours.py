"""Exact k-nearest-neighbour join in Euclidean space, without comparing all pairs.

1. A few pivots (lowest hash order) cut the space into cells; every training row goes to its
   nearest pivot's cell.
2. From each cell's radius and its k rows closest to the pivot follows, per probe, an upper bound
   for its k-th distance; cells that cannot hold anything nearer are skipped.
3. Probes meet the cells left in blocks of bounded size (an equi-join by cell, slice and chunk),
   rows that the triangle inequality rules out are skipped, and only each block's best k per probe
   leave it.  Ids must be integers.

Copies of a training vector are reduced to the k copies with the lowest ids first (more can never
be among the k nearest), and equal probes are searched once.  A large cell is split into slices.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ranking as K

SLICE_ROWS = 4_096
PROBES = 256


def _block_search(need: int):
    """The ``need`` nearest rows of every probe inside one (cell, slice, chunk) block.

    Both sides of a block are bounded by about ``SLICE_ROWS`` (they are cut by hash); a matrix
    product per ``PROBES`` probes picks the rows whose distances are worked out exactly.
    """

    def search(probes: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"rep": [], "tid": [], "distance": []}).astype({"rep": "int64", "tid": "int64"})
        if not len(probes) or not len(rows):
            return empty
        near = np.stack(rows["vec"].to_numpy())
        tid, td, square = rows["tid"].to_numpy(), rows["td"].to_numpy(), (near * near).sum(axis=1)
        rep, own, bound, own_d = probes["rep"].to_numpy(), np.stack(probes["pvec"].to_numpy()), probes["bound"].to_numpy(), probes["pd"].to_numpy()
        out = []
        for s in range(0, len(rep), PROBES):
            v = own[s : s + PROBES]
            size = (v * v).sum(axis=1)[:, None] + square
            rough = size - 2 * v @ near.T
            rough[np.abs(td - own_d[s : s + PROBES, None]) > bound[s : s + PROBES, None]] = np.inf  # triangle inequality
            last = np.partition(rough, min(need, len(tid)) - 1, axis=1)[:, min(need, len(tid)) - 1]
            # the product rounds; whatever may be among the nearest is worked out exactly
            i, j = np.nonzero((rough <= last[:, None] + 1e-9 * (1 + size)) & np.isfinite(rough))
            d = np.sqrt(((near[j] - v[i]) ** 2).sum(axis=1))
            order = np.lexsort((tid[j], d.round(9), i))
            i, j, d = i[order], j[order], d[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            kept = place < need
            out.append(pd.DataFrame({"rep": rep[s + i[kept]], "tid": tid[j[kept]], "distance": d[kept]}))
        return pd.concat(out) if out else empty

    return search


def _pivot_distances(pivots: list[list[float]]):
    """Distances of a vector column to the (few) pivots."""
    centres = np.asarray(pivots, dtype="float64")

    def compute(v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=object)
        found = []
        for s in range(0, len(v), PROBES):  # the gaps of a whole batch would be as many copies of it as there are pivots
            gap = np.stack(v.iloc[s : s + PROBES].to_numpy())[:, None, :] - centres[None, :, :]
            found.extend(np.sqrt((gap * gap).sum(axis=2)))
        return pd.Series(found)

    return F.pandas_udf(compute, T.ArrayType(T.DoubleType()))


def _pivots(train: DataFrame, id_column: str, n: int) -> list[list[float]]:
    """The n vectors lowest in hash order; n is a small constant."""
    return [list(r["vec"]) for r in train.orderBy(K.row_hash([id_column], "pivot")).limit(n).select("vec").collect()]


def knn_join(probes: DataFrame, train: DataFrame, probe_id: str, train_id: str, vector: str, k: int = 5,
             carry: list[str] = (), exclude_self: bool = False, pivots: int = 32) -> DataFrame:
    """``(probe_id, train_id, distance, rank, carried columns)``: the k nearest rows of every probe.

    ``exclude_self`` leaves out the training row with the probe's own id.
    """
    need = k + 1 if exclude_self else k
    as_doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    base = train.select(F.col(train_id).alias("tid"), as_doubles.alias("vec"))
    copies = W.partitionBy("vec").orderBy("tid")
    base = base.withColumn("_c", F.row_number().over(copies)).filter(F.col("_c") <= need).drop("_c")
    to_pivots = _pivot_distances(_pivots(base, "tid", pivots))

    def with_distances(df: DataFrame) -> DataFrame:
        return df.withColumn("_d", to_pivots("vec"))

    placed = with_distances(base).withColumn("td", F.array_min("_d"))
    placed = placed.withColumn("cell", (F.array_position("_d", F.col("td")) - 1).cast("int")).drop("_d")

    closest = placed.withColumn("_r", F.row_number().over(W.partitionBy("cell").orderBy("td"))).filter(F.col("_r") <= need)
    cells = placed.groupBy("cell").agg(F.max("td").alias("radius"), F.count("*").alias("n"))
    cells = cells.join(closest.groupBy("cell").agg(F.collect_list("td").alias("near")), "cell")  # k values per cell
    cells = cells.withColumn("slices", F.ceil(F.col("n") / SLICE_ROWS).cast("int"))
    cell_list = cells.agg(F.collect_list(F.struct("cell", "radius", "slices", "near"))).scalar()  # at most `pivots` cells

    wanted = probes.select(F.col(probe_id).alias("pid"), as_doubles.alias("vec"))
    same = wanted.groupBy("vec").agg(F.min("pid").alias("rep"))  # equal probes are searched once
    distinct = with_distances(same).withColumn("_cells", cell_list)
    at = lambda c: F.get(F.col("_d"), c["cell"])
    uppers = F.array_sort(F.flatten(F.transform("_cells", lambda c: F.transform(c["near"], lambda t: at(c) + t))))
    # a little slack: rounding of the bound must not lose a neighbour
    bound = F.coalesce(F.get(uppers, F.lit(need - 1)), F.lit(float("inf"))) * (1 + 1e-9) + 1e-9
    distinct = distinct.withColumn("bound", bound)
    open_cells = F.filter("_cells", lambda c: at(c) - c["radius"] <= F.col("bound"))
    visits = distinct.select("rep", "vec", "bound", "_d", F.explode_outer(open_cells).alias("c")).filter("c IS NOT NULL").select(
        "rep", F.col("vec").alias("pvec"), "bound", F.get(F.col("_d"), F.col("c.cell")).alias("pd"), F.col("c.cell").alias("cell"), F.col("c.slices").alias("slices"),
    )
    # the visitors of a cell are cut into chunks; its slices go to those chunks only.  The two tables
    # broadcast have one row per pivot
    chunks = visits.groupBy("cell").agg(F.ceil(F.count("*") / SLICE_ROWS).alias("chunks"))
    visits = visits.join(F.broadcast(chunks), "cell").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    visits = visits.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices", "chunks")
    sliced = placed.join(F.broadcast(cells.select("cell", "slices")), "cell").join(F.broadcast(chunks), "cell")
    sliced = sliced.withColumn("slice", F.pmod(F.xxhash64("tid"), F.col("slices").cast("bigint")).cast("int"))
    sliced = sliced.select("tid", "vec", "td", "cell", "slice", F.explode(F.sequence(F.lit(0), F.col("chunks").cast("int") - 1)).alias("chunk"))
    block = ["cell", "slice", "chunk"]
    scored = (
        visits.groupBy(*block).cogroup(sliced.groupBy(*block))
        .applyInPandas(_block_search(need), "rep bigint, tid bigint, distance double")
    )
    rounded = F.round("distance", 9)
    best = K.top_k_per(scored, ["rep"], need, [rounded.asc(), F.col("tid").asc()], rank="rank").drop("rank")
    out = wanted.join(same, "vec").select("pid", "rep").join(best, "rep").drop("rep")
    if exclude_self:
        out = out.filter(F.col("pid") != F.col("tid"))
    out = K.top_k_per(out, ["pid"], k, [F.round("distance", 9).asc(), F.col("tid").asc()], rank="rank")
    if carry:
        out = out.join(train.select(F.col(train_id).alias("tid"), *carry), "tid").select("pid", "tid", "distance", "rank", *carry)
    return out.withColumnsRenamed({"pid": probe_id, "tid": f"near_{train_id}"})


def majority_vote(near: DataFrame, probe_id: str, label: str) -> DataFrame:
    """Most frequent label among the neighbours, ties to the smallest label."""
    votes = near.groupBy(probe_id, label).agg(F.count("*").alias("n"))
    return votes.groupBy(probe_id).agg(
        F.min_by(label, F.struct((-F.col("n")).alias("n"), F.col(label).alias("l"))).alias("predicted"), F.max("n").alias("votes")
    )
