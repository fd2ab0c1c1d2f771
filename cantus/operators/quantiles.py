"""Exact quantiles of many columns by radix selection: counts per prefix, never a sort of the values.

``percentile`` keeps every distinct value of a column in one reducer; that does not scale.
Here a value's order is read off as four digits: exponent (with sign), 12, 20 and 20 bits of the
mantissa.  One pass counts the first two digits of all columns, a second pass only the values that
share them with a wanted rank.  Every window is over the digits below one prefix, so it holds at most
2^20 rows whatever the table's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.const import sql
from .columns import attach

STEP = 12  # bits of the mantissa in the first prefix
FINE = 1 << 20  # steps below a prefix
INFINITE, NAN = 1 << 39, 1 << 40
TARGET = ["feature", "prob", "side"]


def tall(df: DataFrame, features: list[str], group: list[str] = ()) -> DataFrame:
    """``(group.., feature, x)``, nulls removed."""
    pairs = ", ".join(f"named_struct('feature', {sql(f)}, 'x', CAST(`{f}` AS DOUBLE))" for f in features)
    return df.select(*group, F.expr(f"inline(array({pairs}))")).filter("x IS NOT NULL")


def approximate(df: DataFrame, features: list[str], probs: list[float], relative_error: float = 0.001) -> DataFrame:
    """``(feature, q)`` with q an array of approximate quantiles, all columns in one aggregate."""
    accuracy = int(round(1 / relative_error))
    row = df.agg(*[F.percentile_approx(F.col(f).cast("double"), probs, accuracy).alias(f) for f in features])
    return row.select(
        F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("q")) for f in features]))
    )


def rank_bounds(df: DataFrame, found: DataFrame, features: list[str], probs: list[float], error: float) -> DataFrame:
    """``(feature, prob, n, is_value, within)``: whether the ranks that ``found`` values hold come within ``error`` x n of the wanted one.

    ``found`` is ``approximate``'s result; its values are scalar subqueries, so the ranks are counted in one pass.
    """
    cell = lambda f, i: F.max(F.when(F.col("feature") == F.lit(f), F.get("q", F.lit(i))))
    row = found.agg(*[F.array(*[cell(f, i) for i in range(len(probs))]).alias(f"q{j}") for j, f in enumerate(features)])
    seen = attach(df.select(*[F.col(f).cast("double").alias(f"x{j}") for j, f in enumerate(features)]), row, "_q")
    pairs = [(j, f, i, p) for j, f in enumerate(features) for i, p in enumerate(probs)]
    at = lambda j, i: F.get(F.col(f"_q.q{j}"), F.lit(i))
    counts = seen.agg(
        *[F.count(f"x{j}").alias(f"n{j}") for j in range(len(features))],
        *[F.count_if(F.col(f"x{j}") < at(j, i)).alias(f"b{j}_{i}") for j, _, i, _ in pairs],
        *[F.count_if(F.col(f"x{j}") <= at(j, i)).alias(f"u{j}_{i}") for j, _, i, _ in pairs],
    )

    def told(j: int, f: str, i: int, p: float) -> Column:
        n, below, upto = F.col(f"n{j}"), F.col(f"b{j}_{i}"), F.col(f"u{j}_{i}")
        # one rank of slack: the wanted rank itself is rounded
        within = (below <= n * (p + error) + 1) & (upto >= n * (p - error) - 1)
        return F.struct(F.lit(f).alias("feature"), F.lit(float(p)).alias("prob"), n.alias("n"), (upto > below).alias("is_value"), within.alias("within"))

    return counts.select(F.inline(F.array(*[told(*pair) for pair in pairs])))


def _digits(values: DataFrame) -> DataFrame:
    """Adds ``_k`` (exponent and 12 bits, monotone in x) and ``_s`` (the next 20 bits).

    An exponent that log2 rounds to its neighbour gives the same ``_k``: one step below an octave's
    start is the last step of the octave before.  Infinities and NaN (above all numbers) get keys of their own.
    """
    size = F.abs("x")
    power = F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1074)).cast("int")
    scaled = values.withColumn("_e", power).withColumn("_m", (size / F.pow(F.lit(2.0), F.col("_e")) - 1) * (1 << STEP))
    key = F.shiftleft(F.col("_e").cast("bigint") + 1075, STEP) + F.floor("_m") + 1
    sign = F.signum("x").cast("int")

    def special(normal: Column, infinite: int, nan: int) -> Column:
        out = F.when(F.isnan("x"), F.lit(nan)).when(size == float("inf"), sign * F.lit(infinite)).when(F.col("x") == 0, F.lit(0))
        # a default keeps the column free of nulls, so that no filter is pushed below the counts
        return F.coalesce(out.otherwise(sign * normal), F.lit(0)).cast("bigint")

    fine = F.floor((F.col("_m") - F.floor("_m")) * FINE)
    return scaled.withColumns({"_k": special(key, INFINITE, NAN), "_s": special(fine, 0, 0)}).drop("_e", "_m")


def _descend(counts: DataFrame, digit: str) -> DataFrame:
    """Of the counts per target and digit, the digit that holds the target's rank; the rank is then one inside it."""
    upto = F.sum("n").over(W.partitionBy(*TARGET).orderBy(digit))
    found = counts.withColumn("_before", upto - F.col("n"))
    found = found.filter((F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("n")))
    return found.withColumn("rank", F.col("rank") - F.col("_before")).drop("_before", "n")


def of_values(values: DataFrame, probs: list[float]) -> DataFrame:
    """``(feature, prob, q)`` from ``(feature, x, n)``: n copies of x, no nulls; a value may come in several rows.

    The values of a rank's prefix (1/4096 of an octave) are shuffled by distinct value; a column that lies
    wholly inside one prefix is shuffled whole.  The tables joined back hold a row per feature and rank.
    """
    keyed = _digits(values)
    coarse = keyed.groupBy("feature", "_k").agg(F.sum("n").alias("n")).withColumn("_hi", F.shiftright("_k", STEP))
    octaves = coarse.groupBy("feature", "_hi").agg(F.sum("n").alias("n"))
    octaves = octaves.withColumn("total", F.sum("n").over(W.partitionBy("feature")))
    wanted = F.expr("inline(array(" + ", ".join(f"named_struct('prob', {float(p)!r}D, 'side', {i})" for p in probs for i in (0, 1)) + "))")
    at = octaves.select("*", wanted).withColumn("pos", F.col("prob") * (F.col("total") - 1)).drop("total")
    at = _descend(at.withColumn("rank", F.when(F.col("side") == 0, F.floor("pos")).otherwise(F.ceil("pos"))), "_hi")
    at = _descend(coarse.join(F.broadcast(at), ["feature", "_hi"]), "_k").drop("_hi")
    near = keyed.join(F.broadcast(at.select("feature", "_k")), ["feature", "_k"], "left_semi")
    near = near.groupBy("feature", "_k", "_s", "x").agg(F.sum("n").alias("n"))
    steps = near.groupBy("feature", "_k", "_s").agg(F.sum("n").alias("n"))
    at = _descend(steps.join(F.broadcast(at), ["feature", "_k"]), "_s")
    at = _descend(near.join(F.broadcast(at), ["feature", "_k", "_s"]), "x")
    side = lambda i: F.max(F.when(F.col("side") == i, F.col("x")))
    both = at.groupBy("feature", "prob").agg(side(0).alias("a"), side(1).alias("b"), F.max(F.col("pos") - F.floor("pos")).alias("part"))
    # equal neighbours need no step between them (and infinite ones allow none)
    between = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * F.col("part"))
    return both.select("feature", "prob", between.alias("q"))


def exact(df: DataFrame, features: list[str], probs: list[float]) -> DataFrame:
    """``(feature, prob, q)`` with linear interpolation between the two nearest ranks; two scans.

    Nulls are left out, a column without values gives no row; NaN is above all numbers.
    """
    return of_values(tall(df, features).withColumn("n", F.lit(1).cast("bigint")), probs)


def widen(q: DataFrame, probs: dict[str, float]) -> DataFrame:
    """``(feature, <name> ...)``: one column per named probability."""
    return q.groupBy("feature").agg(*[F.max(F.when(F.col("prob") == float(p), F.col("q"))).alias(n) for n, p in probs.items()])


def exact_wide(df: DataFrame, features: list[str], probs: dict[str, float]) -> DataFrame:
    return widen(exact(df, features, list(probs.values())), probs)
