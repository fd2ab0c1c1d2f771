"""Dedup, exact splits, samples, ranks and top-k without any unbounded single-task window.

* keep-one / top-k windows are always filtered on ``row_number() <= k`` so that Spark prunes
  each map task to k rows per key before the shuffle (WindowGroupLimit): a hot key is safe.
* exact shares of a table are cut on hash order.  :func:`hash_cuts` finds the cut values by
  counting hash prefixes, never by ranking all rows; membership is then a plain filter.
* ordered running totals over a whole table go through :func:`running_total`, a parallel prefix
  sum over ranges of equal numbers of rows, with one offset per range.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import shared_dir


def keep_one(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by a total order."""
    w = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def keep_latest(df: DataFrame, key: list[str], newest_first: list[Column]) -> DataFrame:
    return keep_one(df, key, newest_first)


def first_source_wins(frames: list[DataFrame], key: list[str], order: list[Column] = ()) -> DataFrame:
    """Union by name (absent columns NULL); on equal keys the earlier frame survives."""
    union = None
    for rank, frame in enumerate(frames):
        tagged = frame.withColumn("_src", F.lit(rank))
        union = tagged if union is None else union.unionByName(tagged, allowMissingColumns=True)
    return keep_one(union, key, [F.col("_src"), *order]).drop("_src")


def last_source_wins(frames: list[DataFrame], key: list[str], order: list[Column] = ()) -> DataFrame:
    return first_source_wins(list(reversed(frames)), key, order)


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_k_per(df: DataFrame, key: list[str], k, order: list[Column], rank: str = "rank") -> DataFrame:
    """Best k rows per key; ``k`` may also be a column holding each key's own k."""
    w = W.partitionBy(*key).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(w))
    return ranked.filter(F.col(rank) <= k)


def top_k_merged(df: DataFrame, key: list[str], k: int, order: list[Column], rank: str = "rank", buckets: int = 256) -> DataFrame:
    """Best k rows per key of few keys and many tasks, in two steps.

    Every task keeps its k best rows of a key; ``buckets`` groups of tasks merge theirs first, so no task is sent
    more than k rows from each task of one group, or from each group.  ``order`` must be total.
    """
    # any dealing of tasks to groups gives the same rows
    dealt = df.withColumn("_bucket", F.spark_partition_id() % buckets)
    merged = top_k_per(dealt, [*key, "_bucket"], k, order, rank="_rn").drop("_rn", "_bucket")
    return top_k_per(merged, key, k, order, rank)


def row_hash(cols: list[str], salt: str = "") -> Column:
    """Stable hash order of a key, equal in any engine that has md5."""
    parts = [F.lit(salt)] if salt else []
    return F.md5(F.concat_ws("|", *parts, *[F.col(c).cast("string") for c in cols]))


def hash_cuts(df: DataFrame, key: list[str], shares: list[float], label: str | None = None,
              classes: list | None = None, rows: int | None = None, salt: str = "") -> DataFrame:
    """Where to cut the hash order so that each share of each class holds exactly floor(share*n) rows.

    Result: ``(label, cut, hash)``, at most ``len(classes) * len(shares)`` rows.  Rows with
    ``row_hash <= hash`` are inside.  Two passes over (label, hash): one counts 3-digit hash prefixes
    (at most 4096 groups per class in each task), the other looks at the one prefix that holds the
    cut, 1/4096 of the rows.  Copies of a key stay on one side: the cut is
    then the first hash at which the count is reached.
    """
    marker = F.col(label) if label else F.lit("all")
    keyed = df.select(marker.alias("label"), row_hash(key, salt).alias("h"))
    if classes is not None:
        keyed = keyed.filter(F.col("label").isin(classes))
    cuts = F.array(*[F.struct(F.lit(i).alias("cut"), F.lit(float(s)).alias("share")) for i, s in enumerate(shares)])

    def locate(counts: DataFrame, digits: str, need: str) -> DataFrame:
        by = W.partitionBy("label", "cut").orderBy(digits)
        before = F.sum("n").over(by) - F.col("n")
        return counts.withColumn("before", before).filter(
            (F.col(need) > F.col("before")) & (F.col(need) <= F.col("before") + F.col("n"))
        )

    level1 = keyed.groupBy("label", F.substring("h", 1, 3).alias("p1")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy("label"))
    wanted = F.floor(F.col("c.share") * F.col("total")) if rows is None else F.least(F.lit(rows), F.col("total"))
    level1 = level1.withColumn("total", total).withColumn("c", F.explode(cuts))
    level1 = level1.select("label", "p1", "n", F.col("c.cut").alias("cut"), wanted.alias("want"))
    at1 = locate(level1, "p1", "want").select("label", "cut", "p1", (F.col("want") - F.col("before")).alias("need1"))

    level2 = (
        keyed.withColumn("p1", F.substring("h", 1, 3))
        .join(F.broadcast(at1), ["label", "p1"])  # at most classes x cuts rows
        .groupBy("label", "cut", "need1", "h").agg(F.count("*").alias("n"))
    )
    return locate(level2, "h", "need1").select("label", "cut", F.col("h").alias("hash"))


def _with_cuts(df: DataFrame, cuts: DataFrame, label: str | None, classes: list | None, n: int, to: str = "_cuts") -> DataFrame:
    """The n cut hashes of each row's class as an array column.

    They are worked out here, once, and stay constants (n per class): as a subquery, every action on
    the result would pass over the whole table again for them.
    """
    groups = classes if classes is not None else ["all"]
    cell = lambda c, j: F.max(F.when((F.col("label") == F.lit(c)) & (F.col("cut") == j), F.col("hash")))
    row = cuts.agg(*[F.array(*[cell(c, j) for j in range(n)]).alias(f"c{i}") for i, c in enumerate(groups)]).first()
    found = [F.array(*[F.lit(h).cast("string") for h in hashes]) for hashes in row]
    if classes is None:
        own = found[0]
    else:
        own = F.coalesce(*[F.when(F.col(label) == F.lit(c), f) for c, f in zip(classes, found)])
    return df.withColumn(to, own)


def stratified_split(df: DataFrame, label: str, classes: list, key: list[str], share: float = 0.8,
                     to: str = "is_train", salt: str = "") -> DataFrame:
    """Exact per-class share as a boolean column: floor(share * n) rows of each class are true.

    The class list is a parameter (it is fixed in a classification task); other classes get NULL.
    """
    cuts = hash_cuts(df, key, [share], label, classes, salt=salt)
    # a class too small for one row has no cut: everything is outside
    inside = F.coalesce(row_hash(key, salt) <= F.get("_cuts", F.lit(0)), F.lit(False))
    out = _with_cuts(df, cuts, label, classes, 1)
    return out.withColumn(to, F.when(F.col(label).isin(classes), inside)).drop("_cuts")


def fold_column(df: DataFrame, key: list[str], k: int, label: str | None = None, classes: list | None = None,
                to: str = "fold", salt: str = "") -> DataFrame:
    """Fold number 0..k-1, equal sizes (per class when stratified), by ranges of hash order."""
    shares = [i / k for i in range(1, k)]
    cuts = hash_cuts(df, key, shares, label, classes, salt=salt)
    out = _with_cuts(df, cuts, label, classes, k - 1).withColumn("_h", row_hash(key, salt))
    passed = F.size(F.filter("_cuts", lambda c: c.isNull() | (F.col("_h") > c)))
    return out.withColumn(to, passed).drop("_cuts", "_h")


def sample_rows(df: DataFrame, key: list[str], n: int, salt: str = "42") -> DataFrame:
    """Exactly n rows (all, when there are fewer) in hash order: reproducible, no global sort.

    Of rows that share the key at the cut, those with the smallest row hash are taken.
    """
    cuts = hash_cuts(df, key, [1.0], rows=n, salt=salt)
    marked = _with_cuts(df, cuts, None, None, 1).withColumn("_h", row_hash(key, salt))
    last = F.get("_cuts", F.lit(0))
    below, edge = marked.filter(F.col("_h") < last), marked.filter(F.col("_h") == last)
    edge = edge.withColumn("_own", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    edge = top_k_per(edge, ["_h"], n, [F.col("_own").asc()], rank="_rn")  # a constant prunes each task first
    taken = below.agg(F.count("*")).scalar()
    edge = edge.filter(F.col("_rn") <= F.lit(n) - taken)
    return below.select(*df.columns).unionByName(edge.select(*df.columns))


def sample_share(df: DataFrame, key: list[str], share: float, salt: str = "") -> DataFrame:
    """A hash prefix of about the given share, in one narrow pass."""
    limit = format(int(share * 0xFFFFFFFF), "08x")
    return df.filter(F.substring(row_hash(key, salt), 1, 8) < limit)


def range_parts(df: DataFrame, keys: list[str], parts: int | None = None, to: str = "_range") -> DataFrame:
    """The rows, written once in ranges of ``keys`` with about equal numbers of rows; ``to`` numbers the ranges in order.

    ``parts`` defaults to the session's shuffle partitions.  The bounds come from a sample, so two plans of one range
    exchange may differ: the numbers hold because everything after reads the written table, also after a lost executor.
    Equal keys share a range.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "ranges")
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *[F.col(k) for k in keys]).withColumn(to, F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(StructType([*df.schema.fields, StructField(to, IntegerType())])).parquet(path)


def running_total(df: DataFrame, group: list[str], order: str, value: Column, parts: int | None = None,
                  to: str = "running", descending: bool = False) -> DataFrame:
    """Running total of ``value`` up to and including each row, over an order column.

    ``df`` must hold one row per (group, order) -- pre-aggregate first, so a hot value is one row.
    A parallel prefix sum: rows are dealt to ranges of (group, order) with about as many rows each, whatever the
    share of a group; the window runs inside a range, and one offset per range and group is added.
    """
    ranges = range_parts(df.withColumn("_value", value), [*group, order], parts)
    sums = ranges.groupBy(*group, "_range").agg(F.sum("_value").alias("_sum"))
    direction = F.col("_range").desc() if descending else F.col("_range").asc()
    before = W.partitionBy(*group).orderBy(direction).rowsBetween(W.unboundedPreceding, -1)
    # only a group that goes on from an earlier range has an offset: at most one row per range
    offsets = sums.withColumn("_offset", F.sum("_sum").over(before)).drop("_sum").filter("_offset IS NOT NULL")
    own = F.col(order).desc() if descending else F.col(order).asc()
    inside = F.sum("_value").over(W.partitionBy(*group, "_range").orderBy(own))
    totals = ranges.withColumn("_inside", inside).alias("t")
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"o.{c}")) for c in [*group, "_range"]]
    joined = totals.join(F.broadcast(offsets.alias("o")), reduce(and_, same), "left")
    total = F.col("t._inside") + F.coalesce(F.col("o._offset"), F.lit(0))
    return joined.select(*[F.col(f"t.`{c}`") for c in df.columns], total.alias(to))


def positions(df: DataFrame, order: str, to: str = "sample_index", tie: list[str] = ()) -> DataFrame:
    """0-based position by a numeric column, one number per row, without one global window.

    Equal values are told apart by the hash of ``tie`` (default: all columns).  They are numbered
    inside their hash prefixes, of which a value has at most 256, so a frequent value is not one task.
    """
    marked = df.withColumn("_h", row_hash(list(tie) or df.columns)).withColumn("_p", F.substring("_h", 1, 2))
    cells = marked.groupBy(F.col(order).alias("_v"), F.col("_p").alias("_q")).agg(F.count("*").alias("_n"))
    values = cells.groupBy("_v").agg(F.sum("_n").alias("_all"))
    upto = running_total(values, [], "_v", F.col("_all"), to="_upto").select(F.col("_v").alias("_w"), (F.col("_upto") - F.col("_all")).alias("_before"))
    earlier = F.sum("_n").over(W.partitionBy("_v").orderBy("_q")) - F.col("_n")
    starts = cells.withColumn("_inside", earlier).join(upto, F.col("_v").eqNullSafe(F.col("_w"))).select("_v", "_q", (F.col("_before") + F.col("_inside")).alias("_start"))
    own = F.row_number().over(W.partitionBy(order, "_p").orderBy("_h"))
    numbered = marked.withColumn("_rn", own).join(starts, F.col(order).eqNullSafe(F.col("_v")) & (F.col("_p") == F.col("_q")))
    return numbered.withColumn(to, F.col("_start") + F.col("_rn") - 1).select(*df.columns, to)


def shuffled(df: DataFrame, key: list[str], k: int, seed: int) -> DataFrame:
    """The first k rows of a seeded shuffle (hash order of key and seed)."""
    return df.orderBy(row_hash(key, str(seed)), *key).limit(k)


def pool_size(top_k: int, multiplier: int = 30, lo: int = 50, hi: int = 1000) -> int:
    return min(max(top_k * multiplier, lo), hi)


def next_pool_size(size: int, lo: int = 50, hi: int = 1000) -> int:
    return min(max(size * 2, lo), hi)
