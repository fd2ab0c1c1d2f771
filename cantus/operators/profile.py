"""Column profiling, data quality, class balance, drift.  One scan per report where possible."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import quantiles as QT
from .columns import attach, catalog_type, unpivot_row

PERCENTILES = {"p01": 0.01, "p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def null_ratios(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    names = names or df.columns
    row = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(f"r|{c}") for c in names])
    return unpivot_row(row, names, {"r": "null_ratio"}, key="column_name")


def duplicate_count(df: DataFrame, subset: list[str], to: str = "duplicate_rows") -> DataFrame:
    """Rows minus distinct rows on a subset.  Nulls compare equal."""
    groups = df.groupBy(*subset).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(to))


def integration_report(frames: dict[str, tuple[DataFrame, list[str], str | None]]) -> DataFrame:
    """One row per dataset: rows, shared features, duplicate rows, duplicate ids."""
    out = None
    for name, (df, features, id_column) in frames.items():
        subset = ([id_column] if id_column else []) + features
        by_row = df.groupBy(*subset).agg(F.count("*").alias("n"))
        one = by_row.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
        one = one.select(F.lit(name).alias("dataset"), "rows", F.lit(len(features)).alias("shared_features"), "duplicate_rows")
        ids = duplicate_count(df, [id_column], "d").scalar() if id_column else F.lit(None)
        one = one.withColumn("duplicate_ids", ids.cast("bigint"))
        out = one if out is None else out.unionByName(one)
    return out


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Counts and shares per value.  The window runs over the few class rows."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.withColumn("ratio", F.col("n") / F.sum("n").over(W.partitionBy(F.lit(1))))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Majority, minority, imbalance ratio, entropy (bits), Gini and a severity band; one row."""
    c = class_counts(df, label)
    r = F.col("ratio")
    out = c.agg(
        F.min_by(label, F.struct((-r).alias("r"), F.col(label).alias("l"))).alias("majority_class"),
        F.min_by(label, F.struct(r.alias("r"), F.col(label).alias("l"))).alias("minority_class"),
        F.max(r).alias("max_ratio"),
        F.min(r).alias("min_ratio"),
        (-F.sum(r * F.log2(r + 1e-12))).alias("entropy"),
        F.log2(F.count("*").cast("double")).alias("max_entropy"),
        (1 - F.sum(r * r)).alias("gini"),
    )
    ratio = F.col("max_ratio") / F.greatest(F.col("min_ratio"), F.lit(1e-12))
    band = F.when(F.col("imbalance_ratio") >= 3, "high").when(F.col("imbalance_ratio") >= 1.5, "moderate").otherwise("balanced")
    return out.withColumn("imbalance_ratio", ratio).withColumn("severity", band)


def mismatch_counts(joined: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Per field, how many joined rows differ; NULL on either side is not a difference."""
    return joined.agg(*[F.count_if(F.col(a) != F.col(b)).alias(name) for name, (a, b) in pairs.items()])


def value_counts(df: DataFrame, features: list[str]) -> DataFrame:
    """``(feature, x, n)``: every distinct value; counts are combined before the shuffle."""
    return QT.tall(df, features).groupBy("feature", "x").agg(F.count("*").alias("n"))


def modes(counts: DataFrame) -> DataFrame:
    """Most frequent value per feature of :func:`value_counts`, the smallest on ties."""
    return counts.groupBy("feature").agg(F.min_by("x", F.struct((-F.col("n")).alias("n"), F.col("x").alias("v"))).alias("mode"))


def describe_numeric(df: DataFrame, features: list[str]) -> DataFrame:
    """count, mean, std, min, max, mode, median and seven exact percentiles per feature."""
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[fn(F.col(f).cast("double")).alias(f"{s}|{f}") for s, fn in stats.items() for f in features])
    moments = unpivot_row(row, features, {s: s for s in stats})
    # modes and ranks use the same shuffled counts
    counts = value_counts(df, features)
    q = QT.widen(QT.of_values(counts, list(PERCENTILES.values())), PERCENTILES).withColumn("median", F.col("p50"))
    return moments.join(modes(counts), "feature", "left").join(q, "feature", "left")


def describe_categorical(df: DataFrame, names: list[str]) -> DataFrame:
    """count, unique, top, freq per column; the smallest value wins ties."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in names])
    counts = (
        df.select(F.inline(pairs)).filter(F.col("v").isNotNull())
        .groupBy("column_name", "v").agg(F.count("*").alias("n"))
    )
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("unique"),
        F.min_by("v", F.struct((-F.col("n")).alias("n"), F.col("v").alias("v"))).alias("top"),
        F.max("n").alias("freq"),
    )


def overview(df: DataFrame, order: str, descriptions: dict[str, str]) -> DataFrame:
    """Type, nulls, null %, the value in the first row (by ``order``) and a description per column."""
    names = df.columns
    first = {c: F.min_by(F.col(c).cast("string"), F.col(order)) for c in names}
    row = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls|{c}") for c in names],
        *[first[c].alias(f"sample|{c}") for c in names],
    )
    types = {f.name: catalog_type(f.dataType) for f in df.schema}
    structs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("dtype"),
            F.col(f"`nulls|{c}`").alias("nulls"),
            (F.col(f"`nulls|{c}`") / F.col("rows") * 100).alias("null_pct"),
            F.col(f"`sample|{c}`").alias("sample"),
            F.lit(descriptions.get(c, "(sin descripcion)")).alias("description"),
        )
        for c in names
    ]
    return row.select(F.inline(F.array(*structs)))


def high_null_columns(df: DataFrame, threshold: float = 0.05) -> DataFrame:
    return null_ratios(df).filter(F.col("null_ratio") >= threshold)


def cardinalities(df: DataFrame, names: list[str], top: int = 10, approximate: bool = False) -> DataFrame:
    """Distinct values per column, largest first (a top-k report)."""
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(f"d|{c}") for c in names])
        out = unpivot_row(row, names, {"d": "unique_values"}, key="column_name")
    else:
        out = describe_categorical(df, names).select("column_name", F.col("unique").alias("unique_values"))
    return out.orderBy(F.col("unique_values").desc(), "column_name").limit(top)


def unit_range_report(df: DataFrame, features: list[str]) -> DataFrame:
    """Features with values below 0 or above 1: counts and percentages of their non-null rows."""
    row = df.agg(
        *[F.count(f).alias(f"n|{f}") for f in features],
        *[F.count_if(F.col(f) < 0).alias(f"below|{f}") for f in features],
        *[F.count_if(F.col(f) > 1).alias(f"above|{f}") for f in features],
    )
    out = unpivot_row(row, features, {"n": "n", "below": "below_0", "above": "above_1"})
    out = out.filter((F.col("below_0") > 0) | (F.col("above_1") > 0))
    pct = lambda c: F.col(c) / F.col("n") * 100
    return out.select("feature", "below_0", "above_1", pct("below_0").alias("pct_below_0"), pct("above_1").alias("pct_above_1"))


def skew_outliers(df: DataFrame, features: list[str]) -> DataFrame:
    """Sample skewness (adjusted), interquartile range and % of rows outside the 1.5 IQR fences."""
    q = QT.exact_wide(df, features, {"q1": 0.25, "q3": 0.75})
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    cell = lambda f: F.max(F.when(F.col("feature") == f, F.struct((F.col("q3") - F.col("q1")).alias("iqr"), (F.col("q1") - spread).alias("lo"), (F.col("q3") + spread).alias("hi"))))
    fenced = attach(df, q.agg(*[cell(f).alias(f) for f in features]), "_fences")
    stats = {}
    for f in features:
        x, fence = F.col(f).cast("double"), F.col("_fences")[f]
        stats |= {f"n|{f}": F.count(x), f"g1|{f}": F.skewness(x), f"iqr|{f}": F.max(fence["iqr"]), f"out|{f}": F.avg(((x < fence["lo"]) | (x > fence["hi"])).cast("double")) * 100}
    row = unpivot_row(fenced.agg(*[c.alias(name) for name, c in stats.items()]), features, {"n": "n", "g1": "g1", "iqr": "iqr", "out": "outlier_pct"})
    n = F.col("n").cast("double")
    return row.filter("n > 0").select("feature", (F.sqrt(n * (n - 1)) / (n - 2) * F.col("g1")).alias("skew"), "outlier_pct", "iqr")


def eta_squared(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Share of each feature's variance explained by the classes; one scan, then class rows only."""
    per_class = df.groupBy(target).agg(
        *[F.count(f).alias(f"n|{f}") for f in features],
        *[F.avg(f).alias(f"m|{f}") for f in features],
        *[F.var_pop(f).alias(f"v|{f}") for f in features],
    )
    cells = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.col(f"`n|{f}`").cast("double").alias("n"), F.col(f"`m|{f}`").alias("m"), F.col(f"`v|{f}`").alias("v"))
            for f in features
        ]
    )
    t = per_class.select(target, F.inline(cells)).filter("n > 0")
    by = W.partitionBy("feature")
    known = F.col(target).isNotNull()
    overall = F.sum(F.col("n") * F.col("m")).over(by) / F.sum("n").over(by)
    known_n = F.when(known, F.col("n"))
    own = F.sum(known_n * F.col("m")).over(by) / F.sum(known_n).over(by)
    t = t.withColumns({"overall": overall, "own": own}).filter(known)
    between = F.sum(F.col("n") * (F.col("m") - F.col("overall")) ** 2)
    total = F.sum(F.col("n") * F.col("v") + F.col("n") * (F.col("m") - F.col("own")) ** 2)
    return t.groupBy("feature").agg(F.try_divide(between, total).alias("eta_squared"))


def correlations(df: DataFrame, features: list[str]) -> DataFrame:
    """``(feature_1, feature_2, corr)`` for every unordered pair, in one aggregate."""
    pairs = list(combinations(features, 2))
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(a).alias("feature_1"), F.lit(b).alias("feature_2"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)]
    return row.select(F.inline(F.array(*cells)))


def target_correlations(df: DataFrame, features: list[str], target: str) -> DataFrame:
    row = df.agg(*[F.abs(F.corr(F.col(f).cast("double"), F.col(target).cast("double"))).alias(f"r|{f}") for f in features])
    return unpivot_row(row, features, {"r": "abs_corr"})


def strong_pairs(df: DataFrame, features: list[str], threshold: float = 0.6, top: int = 15) -> DataFrame:
    c = correlations(df, features).withColumn("corr", F.abs("corr")).filter(F.col("corr") >= threshold)
    return c.orderBy(F.col("corr").desc(), "feature_1", "feature_2").limit(top)


def _moments(df: DataFrame, features: list[str]) -> DataFrame:
    row = df.agg(
        *[F.count(f).alias(f"n|{f}") for f in features],
        *[F.avg(f).alias(f"m|{f}") for f in features],
        *[F.var_samp(f).alias(f"v|{f}") for f in features],
    )
    return unpivot_row(row, features, {"n": "n", "m": "m", "v": "v"})


def cohen_d(base: DataFrame, others: dict[str, DataFrame], features: list[str]) -> DataFrame:
    """Standardised mean difference of ``base`` against each other dataset, per feature."""
    a = _moments(base, features).select("feature", F.col("n").alias("na"), F.col("m").alias("ma"), F.col("v").alias("va"))
    out = None
    for name, other in others.items():
        j = a.join(_moments(other, features), "feature")
        std = F.sqrt((F.col("va") + F.col("v")) / 2)
        d = F.when((F.col("na") >= 2) & (F.col("n") >= 2), F.try_divide(F.col("ma") - F.col("m"), std))
        one = j.select("feature", F.lit(name).alias("comparison"), d.alias("cohen_d"), F.col("ma").alias("mean_base"), F.col("m").alias("mean_other"))
        out = one if out is None else out.unionByName(one)
    return out


def histogram(df: DataFrame, features: list[str], bins: int = 20) -> DataFrame:
    """Equal-width bins between each feature's minimum and maximum: ``(feature, bin, n)``."""
    row = df.agg(*[F.struct(F.min(F.col(f).cast("double")).alias("lo"), F.max(F.col(f).cast("double")).alias("hi")).alias(f) for f in features])
    lo, hi = (lambda f: F.col(f"_b.{f}.lo")), (lambda f: F.col(f"_b.{f}.hi"))
    place = lambda f: F.floor(F.try_divide(F.col(f).cast("double") - lo(f), hi(f) - lo(f)) * bins)
    bin_of = lambda f: F.least(F.coalesce(place(f), F.lit(0)), F.lit(bins - 1))
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.when(F.col(f).isNotNull(), bin_of(f)).alias("bin")) for f in features])
    return attach(df, row, "_b").select(F.inline(cells)).filter("bin is not null").groupBy("feature", "bin").agg(F.count("*").alias("n"))


def box_summary(df: DataFrame, features: list[str]) -> DataFrame:
    return QT.exact_wide(df, features, {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0})


def any_true(df: DataFrame, condition, to: str = "any") -> DataFrame:
    return df.agg(F.coalesce(F.bool_or(condition), F.lit(False)).alias(to))


def melt(df: DataFrame, ids: list[str], values: list[str], name: str = "metric", value: str = "score") -> DataFrame:
    return df.unpivot(ids, values, name, value)


