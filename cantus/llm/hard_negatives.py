"""Hard negatives by coordinate pruning over length buckets.

Vectors of a label are cut in buckets of similar length (norm), large buckets in slices.  A slice
holds, for every coordinate of its unit vectors, the list of their values in order.  An anchor meets
every slice it needs: same label for its positives, other labels for negatives.  From the score to be
reached and the slice's greatest length follows the least cosine; each of the anchor's focus
coordinates (its largest) then leaves a feasible range of values, found in the sorted lists; what
lies in all ranges is verified by the exact integer product.  Slices whose length rules the score
out are not looked at.  Only each slice's best rows per anchor leave it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

_SEED = 64


def scaled_rows(vectors: DataFrame, id_col: str, vec_col: str, label: Column, scale: int) -> DataFrame:
    """One row per id that takes part, its components ``floor(scale * x)``.

    Components are cut off where a product of two vectors of their length could leave a long.
    """
    v = F.col("vector")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(f"`{vec_col}`").cast("array<double>").alias("vector"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & finite)
    most = F.floor(F.sqrt(F.lit(2.0**62) / F.greatest(F.size(v), F.lit(1)))).cast("double")
    # the product in doubles first: floor of a huge double is no long
    whole = F.transform(v, lambda x: F.floor(F.greatest(-most, F.least(most, x * scale))).cast("double"))
    return kept.select("vec_id", "label", whole.alias("vector")).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")).select("vec_id", "r.*")


def sliced(rows: DataFrame, slice_rows: int) -> DataFrame:
    """Rows with their ``size``, length ``bucket`` and ``slice`` (copies of a length are cut too)."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    placed = rows.withColumn("norm", norm).withColumn("size", F.size("vector"))
    # lengths within a factor of 2^(1/8); zero vectors have a bucket of their own
    placed = placed.withColumn("bucket", F.when(F.col("norm") > 0, F.floor(8 * F.log2("norm")).cast("int")).otherwise(-1))
    keys = ["size", "label", "bucket"]
    parts = placed.groupBy(*keys).agg(F.ceil(F.count("*") / slice_rows).alias("slices"))
    return placed.join(parts, keys).withColumn("slice", F.pmod(F.xxhash64("vec_id", F.lit(2)), "slices")).drop("norm", "slices")


class Slice:
    """Vectors of a slice with the sorted list of every coordinate."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")  # ties: the smaller id first
        self.ids, self.vectors = ids[order], vectors[order]
        norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.longest, self.widest = norms.max(), np.abs(self.vectors).max(initial=0)
        self.unit = self.vectors / np.maximum(norms, 1e-300)[:, None]
        self.lists = np.argsort(self.unit, axis=0, kind="stable")
        self.values = np.take_along_axis(self.unit, self.lists, axis=0)

    def candidates(self, anchor: np.ndarray, least: float, focus: int) -> np.ndarray:
        """Places of all rows whose product with ``anchor`` may reach ``least`` (and perhaps of others)."""
        length = float(np.sqrt(anchor @ anchor))
        if least <= 0 or length == 0:
            return np.arange(len(self.ids)) if least <= 0 else np.empty(0, np.int64)
        if length * self.longest * (1 + 1e-9) < least:
            return np.empty(0, np.int64)
        angle = np.arccos(min(1.0, least / (length * self.longest)))
        coords = np.argsort(-np.abs(anchor), kind="stable")[:focus]
        own = np.arccos(np.clip(anchor[coords] / length, -1, 1))
        low, high = np.cos(np.minimum(np.pi, own + angle)) - 1e-9, np.cos(np.maximum(0, own - angle)) + 1e-9
        begin = [np.searchsorted(self.values[:, c], x, "left") for c, x in zip(coords, low)]
        end = [np.searchsorted(self.values[:, c], x, "right") for c, x in zip(coords, high)]
        widths = np.array(end) - np.array(begin)
        first = int(widths.argmin())  # the shortest list, then what the other ranges leave of it
        found = self.lists[begin[first] : end[first], coords[first]]
        for i, c in enumerate(coords):
            if i != first and widths[i] < len(self.ids):
                held = self.unit[found, c]
                found = found[(held >= low[i]) & (held <= high[i])]
        return found

    def scores(self, anchor: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Exact integer products; in doubles where they hold every sum."""
        if self.widest * max(np.abs(anchor).max(initial=0), 1) * len(anchor) < 2**52:
            return (self.vectors[places] @ anchor).astype(np.int64)
        return self.vectors[places].astype(np.int64) @ anchor.astype(np.int64)

    def best(self, places: np.ndarray, scores: np.ndarray, k: int):
        """The ``k`` best of them: higher score, then smaller id."""
        if len(places) > 4 * k:
            edge = np.partition(scores, len(scores) - k)[len(scores) - k]
            near = scores >= edge
            places, scores = places[near], scores[near]
        order = np.lexsort((self.ids[places], -scores))[:k]
        return self.ids[places[order]], scores[order]

    def seed(self, anchor: np.ndarray, own: int, k: int) -> float:
        """A score that ``k`` other rows reach for sure, from the ends of the first focus list."""
        if not anchor.any():
            return 0.0 if len(self.ids) > k else -np.inf
        c = int(np.abs(anchor).argmax())
        ends = self.lists[-_SEED:, c] if anchor[c] >= 0 else self.lists[:_SEED, c]
        ends = ends[self.ids[ends] != own]
        if len(ends) < k:
            return -np.inf
        return float(np.sort(self.scores(anchor, ends))[-k])


_KEYS = ["size", "label", "bucket", "slice", "chunk"]


def _met(anchors: DataFrame, index: DataFrame, same_label: bool, anchor_rows: int) -> tuple[DataFrame, DataFrame]:
    """Anchors and rows by block: a slice, and a chunk of the anchors that need it.

    ``anchors`` carry ``own`` (their label): they meet the slices of that label, or all others.
    """
    shared = ["size", "own"] if same_label else ["size"]
    n_chunks = written(anchors.groupBy(*shared).agg(F.ceil(F.count("*") / anchor_rows).alias("chunks")), "anchor-counts")
    dealt = anchors.join(n_chunks, shared).withColumn("chunk", F.pmod(F.xxhash64("anchor_id", F.lit(3)), "chunks")).drop("chunks")
    slices = index.select("size", "label", "bucket", "slice").distinct()
    if same_label:
        slices = slices.withColumn("own", F.col("label"))
    blocks = slices.join(n_chunks, shared).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks")
    blocks = written(blocks, "blocks")
    asked = dealt.join(blocks, [*shared, "chunk"])
    asked = asked if same_label else asked.where("label <> own")
    stored = index.join(blocks, ["size", "label", "bucket", "slice"])
    return asked, stored.select("vec_id", "vector", *_KEYS)


def _search(asked: DataFrame, stored: DataFrame, each, schema: str) -> DataFrame:
    """``each(slice, row)`` gives tuples per anchor row of a block."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and rows.num_rows:
            values = rows["vector"].combine_chunks().flatten().to_numpy()
            vectors = values.reshape(rows.num_rows, len(values) // rows.num_rows)
            block = Slice(rows["vec_id"].to_numpy(), vectors)
            for r in anchors.to_pylist():
                out.extend(each(block, r))
        cols = list(zip(*out)) or [()] * len(names)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(names, cols)})

    return asked.groupBy(*_KEYS).cogroup(stored.groupBy(*_KEYS)).applyInArrow(run, schema)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    scale: int = 256,
    focus: int = 5,
    slice_rows: int = 4_096,
    anchor_rows: int = 2_048,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label: Column | None = None,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` is a condition on ``vec_id`` (rows it holds for are the queries; all rows are searched).
    An anchor's positives are its best ``positives`` rows of its label under other ids; for each, the
    best ``negatives`` rows of other labels with ``least_percent`` to ``most_percent`` of its score are
    returned (none: no row).  Higher scores first, ties by the smaller id.

    Rows with a null id, label or vector, or a null or non-finite component take no part.  Vectors of
    different lengths never meet.  Rows that repeat an id are one row: that with the smallest label,
    then vector.  Zero vectors score 0.  Extra columns are ignored; an empty table gives no rows.
    """
    label = F.col("label") if label is None else label
    index = written(sliced(scaled_rows(vectors, id_col, vec_col, label, scale), slice_rows), "slices")
    anchors = index.where(anchor).select(F.col("vec_id").alias("anchor_id"), F.col("label").alias("own"), F.col("vector").alias("query"), F.col("size").alias("size"))
    anchors = written(anchors, "anchors")

    def nearest(block: Slice, r: dict):
        query = np.array(r["query"], float)
        places = block.candidates(query, block.seed(query, r["anchor_id"], positives), focus)
        places = places[block.ids[places] != r["anchor_id"]]
        for i, s in zip(*block.best(places, block.scores(query, places), positives)):
            yield r["anchor_id"], int(i), int(s)

    asked, stored = _met(anchors, index, True, anchor_rows)
    near = _search(asked, stored, nearest, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = written(near.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= positives).drop("_r"), "positives")

    def harder(block: Slice, r: dict):
        query = np.array(r["query"], float)
        ranges = [(p["positive_id"], p["positive_score"], -(-least_percent * p["positive_score"] // 100), most_percent * p["positive_score"] // 100) for p in r["near"]]
        ranges = [x for x in ranges if x[2] <= x[3]]
        if not ranges:
            return
        places = block.candidates(query, min(x[2] for x in ranges), focus)
        scores = block.scores(query, places)
        for positive, score, low, high in ranges:
            inside = (scores >= low) & (scores <= high)
            for i, s in zip(*block.best(places[inside], scores[inside], negatives)):
                yield r["anchor_id"], positive, score, int(i), int(s)

    wanted = near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("near"))
    asked, stored = _met(anchors.join(wanted, "anchor_id"), index, False, anchor_rows)
    found = _search(asked, stored, harder, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
