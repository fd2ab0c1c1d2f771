"""Row filters and row-level validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import ALL_GENRES_WORDS, LOUDNESS_RANGE, SCORE_RANGES, UNIT_FEATURES
from ..functions import numeric as N
from ..functions import parse as P
from ..functions import text as X


def range_rules(columns: list[str]) -> dict[str, Column]:
    """Rule text -> condition that must hold, for the columns at hand."""
    rules = {f"{c} debe estar entre 0 y 1": F.col(c).between(0.0, 1.0) for c in UNIT_FEATURES if c in columns}
    if "tempo" in columns:
        rules["tempo debe ser mayor o igual que 0"] = F.col("tempo") >= 0
    if "duration_ms" in columns:
        rules["duration_ms debe ser mayor que 0"] = F.col("duration_ms") > 0
    if "loudness" in columns:
        rules["loudness debe estar entre -80 y 10"] = F.col("loudness").between(*LOUDNESS_RANGE)
    return rules


def in_audio_range(df: DataFrame) -> DataFrame:
    """Keep rows whose audio values are all valid; a NULL value drops the row."""
    for condition in range_rules(df.columns).values():
        df = df.filter(condition)
    return df


def with_violations(df: DataFrame, required: list[str] = (), url: str | None = None, to: str = "violations") -> DataFrame:
    """One array of messages per row: missing values, bad URL, values out of range."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c} falta o no es numerico")) for c in required]
    if url:
        empty = F.coalesce(F.trim(F.col(url)), F.lit("")) == ""
        bad = P.track_id_from_url(F.col(url)).isNull()
        checks.append(F.when(empty, F.lit(f"{url} es obligatorio")).when(bad, F.lit(f"{url} no es valida")))
    for message, ok in range_rules(df.columns).items():
        checks.append(F.when(~F.coalesce(ok, F.lit(True)), F.lit(message)))
    return df.withColumn(to, F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>"))


def split_valid(df: DataFrame, violations: str = "violations") -> tuple[DataFrame, DataFrame]:
    bad = F.size(violations) > 0
    return df.filter(~bad).drop(violations), df.filter(bad)


def failed_rules(df: DataFrame, violations: str = "violations") -> DataFrame:
    """How many rows break each rule.

    ``explode_outer`` plus a filter: a plain explode makes Spark add a size filter in front, which
    works out the whole array a second and third time.
    """
    rules = df.select(F.explode_outer(violations).alias("rule")).filter("rule IS NOT NULL")
    return rules.groupBy("rule").agg(F.count("*").alias("rows"))


def count_failed_rules(df: DataFrame, required: list[str] = ()) -> DataFrame:
    """How many rows break each rule, in one aggregate of counts without a list per row."""
    bad = {f"{c} falta o no es numerico": F.col(c).isNull() for c in required}
    bad |= {message: ~F.coalesce(ok, F.lit(True)) for message, ok in range_rules(df.columns).items()}
    counts = df.agg(*[F.count_if(b).alias(f"c{i}") for i, b in enumerate(bad.values())])
    pairs = [F.struct(F.lit(m).alias("rule"), F.col(f"c{i}").alias("rows")) for i, m in enumerate(bad)]
    return counts.select(F.inline(F.array(*pairs))).filter("rows > 0")


def raise_on_violations(df: DataFrame, violations: str = "violations") -> DataFrame:
    """Strict mode: the job fails on the first bad row it meets."""
    return df.withColumn(
        violations,
        F.when(F.size(violations) == 0, F.col(violations)).otherwise(
            F.raise_error(F.array_join(violations, "; ")).cast("array<string>")
        ),
    )


def by_genre(df: DataFrame, genre: str | None, column: str = "track_genre") -> DataFrame:
    wanted = (genre or "").strip().lower()
    if wanted in ALL_GENRES_WORDS or column not in df.columns:
        return df
    return df.filter(F.lower(F.col(column)) == wanted)


def artist_condition(artists: Column, queries: list[str], whole_value: bool = True, fold=X.fold_name) -> Column:
    """Any query is contained in any artist of a multi-artist value, or in the unsplit value.

    A match in the unsplit value may span a separator; without ``whole_value`` it does not count.
    """
    names = F.transform(F.split(artists, "[;,/&]+"), lambda x: fold(x))
    if whole_value:
        names = F.array_append(names, fold(artists))
    hit = F.exists(names, lambda n: F.coalesce(*[F.when(n.contains(q), True) for q in queries], F.lit(False)))
    return F.coalesce(hit, F.lit(False))


def artist_queries(query: str | None) -> list[str]:
    """Several artists may be asked for at once, separated by ``, ; /``."""
    import re

    return [q for part in re.split(r"[,;/]+", query or "") if (q := X.fold_name_literal(part))]


def by_artist(df: DataFrame, query: str | None, column: str = "artists", whole_value: bool = True) -> DataFrame:
    queries = artist_queries(query)
    if not queries or column not in df.columns:
        return df
    return df.filter(artist_condition(F.col(column), queries, whole_value))


def by_score_range(df: DataFrame, name: str = "0.00 - 1.00", column: str = "recommendation_score") -> DataFrame:
    lo, hi = SCORE_RANGES.get(name, SCORE_RANGES["0.00 - 1.00"])
    return df.filter((F.col(column) >= lo) & (F.col(column) < hi))


def by_mood(df: DataFrame, mood: Column, column: str = "predicted_mood") -> DataFrame:
    return df.filter(F.lower(F.col(column)) == mood)


def purge_corrupt(df: DataFrame, numeric: list[str], sentinel: tuple[str, str]) -> DataFrame:
    """Coerce to numbers, drop rows that fail, drop a sentinel value (rows with NULL there stay)."""
    column, value = sentinel
    coerced = df.withColumns({c: N.safe_double(F.col(c)) for c in numeric})
    return coerced.dropna(subset=numeric).filter(~F.col(column).eqNullSafe(F.lit(value)))
