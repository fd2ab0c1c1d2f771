"""Track-like views over the driver tables.

The operators are about tracks; the given tables are not.  Each view below is one SELECT that
Spark SQL and other engines read alike, so a query and its SQL twin start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..fixed_values import MOODS, UNIT_FEATURES
from .registry import load

TEXT = "STRING"

# --- raw records, everything text, with the usual dirt ------------------------------------------
RAW_TRACKS = {
    "track_id": "CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE concat('T', CAST(l_partkey AS STRING)) END",
    "artists": "concat('  Artist   ', CAST(l_suppkey AS STRING), '; Guést ', CAST(l_linenumber AS STRING), ' ')",
    "album_name": "concat('Album   ', l_returnflag)",
    "track_name": "concat('Song ', CAST(l_partkey AS STRING))",
    "track_genre": "CASE WHEN l_linenumber = 7 THEN NULL ELSE lower(concat('Genre-', l_returnflag, l_linestatus)) END",
    "popularity": "CASE WHEN l_quantity = 13 THEN 'n/a' ELSE CAST(CAST(floor(l_quantity * 2) AS BIGINT) AS STRING) END",
    "duration_ms": "CASE WHEN l_quantity = 21 THEN '0' ELSE CAST(CAST(floor(l_extendedprice * 4) AS BIGINT) AS STRING) END",
    "explicit": "CASE WHEN l_linenumber % 3 = 0 THEN 'true' WHEN l_linenumber % 3 = 1 THEN 'false' ELSE 'maybe' END",
    "key": "CAST(l_linenumber AS STRING)",
    "mode": "CAST(l_suppkey % 2 AS STRING)",
    "time_signature": "'4'",
    "danceability": "CASE WHEN l_quantity = 7 THEN 'bad' ELSE CAST(l_discount * 10 AS STRING) END",
    "energy": "CAST(l_tax * 12.5 AS STRING)",
    "speechiness": "CAST(CAST(l_linenumber AS DOUBLE) / 7 AS STRING)",
    "acousticness": "CAST(CAST(l_suppkey % 100 AS DOUBLE) / 99 AS STRING)",
    "instrumentalness": "CAST(CAST(l_partkey % 50 AS DOUBLE) / 49 AS STRING)",
    "liveness": "CAST(CAST(l_orderkey % 101 AS DOUBLE) / 100 AS STRING)",
    "valence": "CAST(l_quantity / 48 AS STRING)",
    "loudness": "CAST(0 - l_quantity * 1.7 AS STRING)",
    "tempo": "CASE WHEN l_discount = 0.1 THEN '-1' ELSE CAST(l_extendedprice / 500 AS STRING) END",
}

RAW_MOOD = {
    "uri": "CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE concat('track:', CAST(l_orderkey AS STRING)) END",
    "raw_duration": "CAST(CAST(floor(l_extendedprice * 4) AS BIGINT) AS STRING)",
    **{c: RAW_TRACKS[c] for c in (*UNIT_FEATURES, "loudness", "tempo")},
    "spec_rate": "CAST(CAST(l_linenumber AS DOUBLE) / 7 / l_extendedprice AS STRING)",
    "labels": "CASE WHEN l_quantity = 17 THEN 'none' ELSE CAST(l_suppkey % 4 AS STRING) END",
}

RAW_LYRICS = {
    "id": "CASE WHEN doc_id % 50 = 49 THEN NULL ELSE concat('L', CAST(doc_id - doc_id % 3 AS STRING)) END",
    "name": "concat(' Lyric  ', CAST(doc_id AS STRING))",
    "album_name": "source",
    "artists": "concat(source, ' / ', lang)",
    "key": "CAST(n_chars % 12 AS STRING)",
    "mode": "CAST(n_chars % 2 AS STRING)",
    "duration_ms": "CAST(n_chars * 10 AS STRING)",
    "lyrics": "CASE WHEN doc_id % 40 = 7 THEN '   ' WHEN doc_id % 40 = 8 THEN NULL ELSE text END",
    **{c: f"CAST(CAST(n_chars % {m} AS DOUBLE) / {m - 1} AS STRING)" for c, m in zip(UNIT_FEATURES, (11, 13, 17, 19, 23, 29, 31))},
    "loudness": "CAST(0 - n_chars % 90 AS STRING)",
    "tempo": "CAST(n_chars % 200 AS STRING)",
}

# --- clean, typed track features: one row per line item -------------------------------------------
FEATURES = {
    "row_id": "l_orderkey * 10000000 + l_partkey",
    "track_id": "concat('T', CAST(l_partkey AS STRING))",
    "label": "CAST(l_suppkey % 4 AS INT)",
    "danceability": "l_discount * 10",
    "energy": "l_tax * 12.5",
    "speechiness": "CAST(l_linenumber AS DOUBLE) / 7",
    "acousticness": "CAST(l_suppkey % 100 AS DOUBLE) / 99",
    "instrumentalness": "CAST(l_partkey % 50 AS DOUBLE) / 49",
    "liveness": "CAST(l_orderkey % 101 AS DOUBLE) / 100",
    "valence": "l_quantity / 50",
    "loudness": "0 - l_quantity * 1.2",
    "tempo": "l_extendedprice / 500",
    "duration_ms": "CAST(floor(l_extendedprice * 4) AS BIGINT)",
    "popularity": "CAST(floor(l_quantity * 2) AS INT)",
}

# Stand-in for a fitted model: class shares as a fixed function of the (unscaled) features.
PSEUDO_MODEL = {
    "m_sad": "(1 - valence) * (1 - energy) + 0.05",
    "m_happy": "valence * (1 - energy) + 0.05",
    "m_energetic": "valence * energy + 0.05",
    "m_calm": "(1 - valence) * energy * acousticness + 0.05",
}


def select_list(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in columns.items())


def view_sql(columns: dict[str, str], table: str) -> str:
    return f"SELECT {select_list(columns)} FROM {table}"


def view(spark: SparkSession, sf: str, columns: dict[str, str], table: str) -> DataFrame:
    return load(spark, sf, table).selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def raw_tracks(spark, sf):
    return view(spark, sf, {"Unnamed: 0": "l_linenumber", **RAW_TRACKS}, "lineitem")


def raw_mood(spark, sf):
    raw = view(spark, sf, {"Unnamed: 0": "l_linenumber", "Unnamed: 0.1": "l_linenumber", **RAW_MOOD}, "lineitem")
    return raw.withColumnRenamed("raw_duration", "duration (ms)")


def raw_lyrics(spark, sf):
    return view(spark, sf, RAW_LYRICS, "documents")


def features(spark, sf):
    return view(spark, sf, FEATURES, "lineitem")


FEATURES_SQL = view_sql(FEATURES, "lineitem")

# one row per part: the mean of its line items, with text metadata
TRACK_MEANS = [*UNIT_FEATURES, "loudness", "tempo"]
TRACKS_SQL = (
    "SELECT p.p_partkey AS part_id, concat('T', CAST(p.p_partkey AS STRING)) AS track_id, p.p_name AS track_name, "
    "concat(p.p_brand, '; Ártist ', CAST(p.p_size AS STRING)) AS artists, lower(p.p_type) AS track_genre, "
    "CAST(f.popularity AS INT) AS popularity, f.duration_ms, "
    + ", ".join(f"f.{c}" for c in TRACK_MEANS)
    + " FROM part p JOIN (SELECT track_id, max(popularity) AS popularity, CAST(max(duration_ms) AS DOUBLE) AS duration_ms, "
    + ", ".join(f"round(avg({c}), 9) AS {c}" for c in TRACK_MEANS)
    + f" FROM ({FEATURES_SQL}) x GROUP BY track_id) f ON f.track_id = concat('T', CAST(p.p_partkey AS STRING))"
)


def tracks(spark, sf) -> DataFrame:
    """One row per part with mean features."""
    from pyspark.sql import functions as F

    f = features(spark, sf).groupBy("track_id").agg(
        F.max("popularity").alias("popularity"),
        F.max("duration_ms").cast("double").alias("duration_ms"),
        *[F.round(F.avg(c), 9).alias(c) for c in TRACK_MEANS],
    )
    p = load(spark, sf, "part").selectExpr(
        "p_partkey AS part_id", "concat('T', CAST(p_partkey AS STRING)) AS track_id", "p_name AS track_name",
        "concat(p_brand, '; Ártist ', CAST(p_size AS STRING)) AS artists", "lower(p_type) AS track_genre",
    )
    return p.join(f, "track_id").select(
        "part_id", "track_id", "track_name", "artists", "track_genre", "popularity", "duration_ms", *TRACK_MEANS
    )


# z-scored tracks with pseudo-model shares: what the mood and ranking operators start from
SCALED = [*TRACK_MEANS, "duration_ms"]


def modelled_sql() -> str:
    scaled = ", ".join(f"(t.{c} - s.m_{c}) / coalesce(nullif(s.s_{c}, 0), 1) AS {c}" for c in SCALED)
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in SCALED)
    total = " + ".join(f"({e})" for e in PSEUDO_MODEL.values())
    shares = ", ".join(f"({e}) / ({total}) AS {m}" for m, e in PSEUDO_MODEL.items())
    return (
        f"SELECT t.part_id, t.track_id, t.track_name, t.artists, t.track_genre, t.popularity, t.m_sad, t.m_happy, t.m_energetic, t.m_calm, {scaled} "
        f"FROM (SELECT *, {shares} FROM tracks) t CROSS JOIN (SELECT {stats} FROM tracks) s"
    )


def modelled(spark, sf) -> DataFrame:
    from ..operators import prepare as R

    t = tracks(spark, sf)
    total = " + ".join(f"({e})" for e in PSEUDO_MODEL.values())
    t2 = t.selectExpr("*", *[f"({e}) / ({total}) AS {m}" for m, e in PSEUDO_MODEL.items()])
    return R.apply_scaler(t2, R.scaler_stats(t, SCALED), SCALED)


MODEL_COLUMNS = {m: f"m_{m}" for m in MOODS}
