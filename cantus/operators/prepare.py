"""Feature preparation: engineered features, clipping, scaling, majority labels, text features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import DEFAULT_LEXICON, UNIT_FEATURES
from ..functions import numeric as N
from ..functions import text as X
from . import quantiles as QT
from .columns import attach, unpivot_row


def majority_label(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """One row per feature combination with its most frequent label, ties to the smallest.

    The vote is taken on all rows, before any dedup.
    """
    votes = df.groupBy(*features, label).agg(F.count("*").alias("_n"))
    return votes.groupBy(*features).agg(
        F.min_by(label, F.struct((-F.col("_n")).alias("n"), F.col(label).alias("l"))).alias(label)
    )


def label_conflicts(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Feature combinations that carry more than one label."""
    lowest, highest = F.min(label).alias("lo"), F.max(label).alias("hi")
    return df.groupBy(*features).agg(lowest, highest).filter("lo <> hi").select(*features)


def engineered(df: DataFrame) -> DataFrame:
    """The eleven derived audio features, as far as their inputs exist; one projection."""
    has = lambda *names: all(n in df.columns for n in names)
    out = {}
    if has("energy", "valence"):
        out["energy_valence_interaction"] = F.col("energy") * F.col("valence")
        out["energy_squared"] = F.col("energy") * F.col("energy")
        out.update(N.one_hot_buckets(F.col("energy"), "energy"))
    if has("valence"):
        out.update(N.one_hot_buckets(F.col("valence"), "valence"))
    if has("tempo"):
        out["tempo_log1p"] = F.log1p(F.greatest(F.col("tempo"), F.lit(0.0)))
    if has("duration_ms"):
        out["duration_sqrt"] = F.sqrt(F.greatest(F.col("duration_ms").cast("double"), F.lit(0.0)))
    if has("acousticness", "instrumentalness"):
        out["acoustic_instrumental_mix"] = F.col("acousticness") * F.col("instrumentalness")
    return df.withColumns(out) if out else df


def iqr_bounds(df: DataFrame, features: list[str], relative_error: float = 0.001, exact: bool = False) -> DataFrame:
    """One row of ``struct<lo, hi>`` per unbounded feature, every column in the same pass."""
    if exact:
        q = QT.exact_wide(df, features, {"q1": 0.25, "q3": 0.75})
        cells = [F.max(F.when(F.col("feature") == f, F.struct("q1", "q3"))).alias(f) for f in features]
        row = q.agg(*cells)
    else:
        pct = lambda f: F.percentile_approx(F.col(f).cast("double"), [0.25, 0.75], int(round(1 / relative_error)))
        row = df.agg(*[pct(f).alias(f) for f in features])
        row = row.select(*[F.struct(F.get(f, F.lit(0)).alias("q1"), F.get(f, F.lit(1)).alias("q3")).alias(f) for f in features])
    spread = lambda f: (F.col(f)["q3"] - F.col(f)["q1"]) * 1.5
    return row.select(
        *[F.struct((F.col(f)["q1"] - spread(f)).alias("lo"), (F.col(f)["q3"] + spread(f)).alias("hi")).alias(f) for f in features]
    )


def clip_iqr(df: DataFrame, features: list[str], exact: bool = False) -> DataFrame:
    """Clip features without natural bounds to 1.5 interquartile ranges around the quartiles."""
    free = [f for f in features if f not in UNIT_FEATURES]
    if not free:
        return df
    bounded = attach(df, iqr_bounds(df, free, exact=exact), "_b")
    lo, hi = (lambda f: F.col(f"_b.{f}.lo")), (lambda f: F.col(f"_b.{f}.hi"))
    clipped = lambda f: F.when(F.col(f) < lo(f), lo(f)).when(F.col(f) > hi(f), hi(f)).otherwise(F.col(f))
    return bounded.withColumns({f: clipped(f) for f in free}).drop("_b")


def scaler_stats(df: DataFrame, features: list[str]) -> DataFrame:
    """``(feature, mean, std)`` in one pass; a null or zero deviation becomes 1."""
    row = df.agg(*[F.avg(f).alias(f"mean|{f}") for f in features], *[F.stddev_samp(f).alias(f"std|{f}") for f in features])
    out = unpivot_row(row, features, {"mean": "mean", "std": "std"})
    return out.withColumn("std", F.coalesce(F.nullif(F.col("std"), F.lit(0.0)), F.lit(1.0)))


def _with_stats(df: DataFrame, stats: DataFrame, features: list[str]) -> DataFrame:
    """The tall table as one struct column: no join, no driver round trip."""
    cell = lambda f, v: F.max(F.when(F.col("feature") == f, F.col(v)))
    row = stats.agg(*[F.struct(cell(f, "mean").alias("mean"), cell(f, "std").alias("std")).alias(f) for f in features])
    return attach(df, row, "_s")


def apply_scaler(df: DataFrame, stats: DataFrame, features: list[str]) -> DataFrame:
    """Z-score with supplied statistics; features without statistics stay as they are."""
    names = [f for f in features if f in df.columns]
    mean = lambda f: F.col(f"_s.{f}.mean")
    std = lambda f: F.coalesce(F.nullif(F.col(f"_s.{f}.std"), F.lit(0.0)), F.lit(1.0))
    scaled = lambda f: F.when(mean(f).isNull(), F.col(f).cast("double")).otherwise(N.zscore(F.col(f), mean(f), std(f)))
    return _with_stats(df, stats, names).withColumns({f: scaled(f) for f in names}).drop("_s")


def invert_scaler(df: DataFrame, stats: DataFrame, features: list[str]) -> DataFrame:
    names = [f for f in features if f in df.columns]
    mean, std = (lambda f: F.col(f"_s.{f}.mean")), (lambda f: F.col(f"_s.{f}.std"))
    original = lambda f: F.when(mean(f).isNull(), F.col(f)).otherwise(N.unscale(F.col(f), mean(f), std(f)))
    return _with_stats(df, stats, names).withColumns({f: original(f) for f in names}).drop("_s")


def lexicon_rates(df: DataFrame, text: str, lexicon: dict[str, tuple[str, ...]] = DEFAULT_LEXICON,
                  prefix: str = "lyrics", keep_terms: bool = False) -> DataFrame:
    """Length, word count and per-mood share of lexicon words, over the whole text."""
    base = df.withColumns(
        {
            "_tokens": X.words(F.col(text)),
            f"{prefix}_length": X.text_length(F.col(text)),
            f"{prefix}_word_count": X.word_count(F.col(text), empty_is_one=True),
        }
    )
    terms = {f"{prefix}_{m}_terms": X.lexicon_hits(F.col("_tokens"), ws) for m, ws in lexicon.items()}
    out = base.withColumns(terms).drop("_tokens")
    words = F.greatest(F.col(f"{prefix}_word_count"), F.lit(1))
    out = out.withColumns({f"{prefix}_{m}_lexicon_rate": F.col(f"{prefix}_{m}_terms") / words for m in lexicon})
    return out if keep_terms else out.drop(*terms)
