"""Cleaning queries: Bronze -> Silver -> Gold, validation, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import UNIT_FEATURES
from ..functions import numeric as N
from ..functions import parse as P
from ..functions import text as X
from ..operators import columns as C
from ..operators import filters as Q
from ..operators import layers as L
from ..operators import ranking as K
from . import standins as S
from .registry import load, query, rnd, rounded

SQ = r"trim(regexp_replace({c}, '\s+', ' ', 'g'))"
DBL = "TRY_CAST({c} AS DOUBLE)"
LONG = "CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS BIGINT)"
INT = "CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS INTEGER)"
RANGES = (
    " AND ".join(f"{c} BETWEEN 0 AND 1" for c in UNIT_FEATURES)
    + " AND duration_ms > 0 AND tempo >= 0 AND loudness BETWEEN -80 AND 10"
)


def _typed(columns: dict[str, str], raw: str, drop_null: str | None) -> str:
    body = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    keep = f" WHERE {drop_null} IS NOT NULL" if drop_null else ""
    return f"SELECT {body} FROM ({raw}) r{keep}"


def _silver(columns: dict[str, str], raw: str, key: str, drop_null: str | None = None, extra: str = "") -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in columns if c != key)
    names = ", ".join(columns)
    return (
        f"SELECT {names} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
        f"FROM ({_typed(columns, raw, drop_null)}) t) d WHERE rn = 1 AND {RANGES}{extra}"
    )


_text = lambda c: f"coalesce({SQ.format(c=c)}, 'unknown')"
_num = lambda kind, c, src=None: f"coalesce({kind.format(c=src or c)}, 0)"

TRACK_COLUMNS = {
    "track_id": _text("track_id"), "artists": _text("artists"), "album_name": _text("album_name"),
    "track_name": _text("track_name"), "track_genre": _text("track_genre"),
    "popularity": _num(INT, "popularity"), "duration_ms": _num(LONG, "duration_ms"),
    "explicit": "coalesce(TRY_CAST(explicit AS BOOLEAN), false)",
    "key": _num(INT, "key"), "mode": _num(INT, "mode"), "time_signature": _num(INT, "time_signature"),
    **{c: _num(DBL, c) for c in (*UNIT_FEATURES, "loudness", "tempo")},
}
# the column order of the stand-in decides the survivor of a dedup
TRACK_COLUMNS = {c: TRACK_COLUMNS[c] for c in S.RAW_TRACKS}
MOOD_COLUMNS = {
    "uri": "coalesce(uri, 'unknown')", "duration_ms": _num(LONG, "duration_ms", "raw_duration"),
    **{c: _num(DBL, c) for c in (*UNIT_FEATURES, "loudness", "tempo", "spec_rate")},
    "mood_label": INT.format(c="labels"),
}
LYRIC_COLUMNS = {
    "track_id": _text("id"), "track_name": _text("name"), "album_name": _text("album_name"), "artists": _text("artists"),
    "key": _num(INT, "key"), "mode": _num(INT, "mode"), "duration_ms": _num(LONG, "duration_ms"), "lyrics": SQ.format(c="lyrics"),
    **{c: _num(DBL, c) for c in (*UNIT_FEATURES, "loudness", "tempo")},
}
RAW_T, RAW_M, RAW_L = (S.view_sql(v, t) for v, t in ((S.RAW_TRACKS, "lineitem"), (S.RAW_MOOD, "lineitem"), (S.RAW_LYRICS, "documents")))
SILVER_TRACKS = _silver(TRACK_COLUMNS, RAW_T, "track_id", "track_id")
SILVER_MOOD = _silver(MOOD_COLUMNS, RAW_M, "uri", "uri", " AND mood_label IS NOT NULL")
SILVER_LYRICS = _silver(LYRIC_COLUMNS, RAW_L, "track_id", "id")
FLOATS = [*UNIT_FEATURES, "loudness", "tempo"]


def _round_sql(inner: str, columns, floats=FLOATS) -> str:
    return "SELECT " + ", ".join(rnd(c, c) if c in floats else c for c in columns) + f" FROM ({inner}) z"


@query("silver_tracks", _round_sql(SILVER_TRACKS, TRACK_COLUMNS))
def silver_tracks(spark, sf):
    return rounded(L.silver_tracks(S.raw_tracks(spark, sf)), FLOATS)


@query("silver_tracks_fill_first", _round_sql(_silver(TRACK_COLUMNS, RAW_T, "track_id"), TRACK_COLUMNS))
def silver_tracks_fill_first(spark, sf):
    return rounded(L.silver_tracks(S.raw_tracks(spark, sf), compat=True), FLOATS)


@query("silver_mood", _round_sql(SILVER_MOOD, MOOD_COLUMNS, [*FLOATS, "spec_rate"]))
def silver_mood(spark, sf):
    return rounded(L.silver_mood(S.raw_mood(spark, sf)), [*FLOATS, "spec_rate"])


@query("silver_lyrics", _round_sql(SILVER_LYRICS, LYRIC_COLUMNS))
def silver_lyrics(spark, sf):
    return rounded(L.silver_lyrics(S.raw_lyrics(spark, sf)), FLOATS)


@query(
    "gold_tracks",
    f"""SELECT track_id, track_genre, popularity,
      CASE WHEN energy >= 0.65 AND valence >= 0.55 THEN 'active_positive' WHEN energy < 0.45 AND valence < 0.45 THEN 'calm_sad_candidate'
           WHEN acousticness >= 0.65 THEN 'acoustic' ELSE 'general' END AS context_tag,
      CAST(NULL AS VARCHAR) AS predicted_mood,
      round((popularity / 100.0 + valence + energy) / 3, 6) AS recommendation_score
    FROM ({SILVER_TRACKS}) s""",
)
def gold_tracks(spark, sf):
    g = L.gold_tracks(L.silver_tracks(S.raw_tracks(spark, sf)))
    return rounded(g.select("track_id", "track_genre", "popularity", "context_tag", "predicted_mood", "recommendation_score"), ["recommendation_score"])


@query(
    "gold_mood",
    f"""SELECT uri, duration_ms, {", ".join(rnd(c, c) for c in [*FLOATS, "spec_rate"])}, mood_label,
      CASE mood_label WHEN 0 THEN 'sad' WHEN 1 THEN 'happy' WHEN 2 THEN 'energetic' WHEN 3 THEN 'calm' END AS mood_name
    FROM ({SILVER_MOOD}) s""",
)
def gold_mood(spark, sf):
    return rounded(L.gold_mood(L.silver_mood(S.raw_mood(spark, sf))), [*FLOATS, "spec_rate"])


@query(
    "gold_lyrics",
    rf"""SELECT track_id, 'spotify_unknown' AS track_genre, 0 AS popularity, false AS explicit,
      CASE WHEN coalesce(lyrics, '') = '' THEN 0 ELSE len(string_split_regex(lyrics, '\s+')) END AS lyrics_word_count,
      length(coalesce(lyrics, '')) AS lyrics_length, CAST(length(coalesce(lyrics, '')) > 0 AS INTEGER) AS has_lyrics
    FROM ({SILVER_LYRICS}) s""",
)
def gold_lyrics(spark, sf):
    g = L.gold_lyrics(L.silver_lyrics(S.raw_lyrics(spark, sf)))
    return g.select("track_id", "track_genre", "popularity", "explicit", F.col("lyrics_word_count").cast("bigint"), F.col("lyrics_length").cast("bigint"), "has_lyrics")


# --- validation ------------------------------------------------------------------------------------
_BAD = {
    **{f"{c} debe estar entre 0 y 1": f"NOT ({c} BETWEEN 0 AND 1)" for c in UNIT_FEATURES},
    "tempo debe ser mayor o igual que 0": "tempo < 0",
    "duration_ms debe ser mayor que 0": "duration_ms <= 0",
    "loudness debe estar entre -80 y 10": "NOT (loudness BETWEEN -80 AND 10)",
    "danceability falta o no es numerico": "danceability IS NULL",
}
_TYPED_NULLS = {c: DBL.format(c=c) for c in (*UNIT_FEATURES, "loudness", "tempo", "duration_ms")}


@query(
    "range_violations",
    " UNION ALL ".join(
        f"SELECT rule, rows FROM (SELECT '{m}' AS rule, count(*) AS rows FROM (SELECT {', '.join(f'{e} AS {c}' for c, e in _TYPED_NULLS.items())} FROM ({RAW_T}) r) t WHERE {cond}) q WHERE rows > 0"
        for m, cond in _BAD.items()
    ),
)
def range_violations(spark, sf):
    typed = C.cast_safely(S.raw_tracks(spark, sf), {c: "double" for c in _TYPED_NULLS})
    return Q.count_failed_rules(typed, ["danceability"])


@query(
    "corrupt_purge",
    f"""SELECT track_id, track_genre, count(*) AS rows, {rnd("sum(danceability)", "sum_danceability")} FROM (
      SELECT track_id, track_genre, TRY_CAST(danceability AS DOUBLE) AS danceability, TRY_CAST(popularity AS DOUBLE) AS popularity FROM ({RAW_T}) r) t
    WHERE danceability IS NOT NULL AND popularity IS NOT NULL AND track_genre IS DISTINCT FROM 'genre-af' GROUP BY track_id, track_genre""",
)
def corrupt_purge(spark, sf):
    kept = Q.purge_corrupt(S.raw_tracks(spark, sf), ["danceability", "popularity"], ("track_genre", "genre-af"))
    return kept.groupBy("track_id", "track_genre").agg(F.count("*").alias("rows"), F.round(F.sum("danceability"), 6).alias("sum_danceability"))


@query(
    "upload_defaults",
    f"""SELECT artists, track_genre, explicit, popularity, count(*) AS rows FROM (
      SELECT coalesce(artists, 'Artista desconocido') AS artists, coalesce(track_genre, 'realtime_input') AS track_genre,
        lower(explicit) IN ('true', '1', 'yes', 'si', 'sí') AS explicit,
        least(greatest(coalesce(TRY_CAST(popularity AS DOUBLE), 0), 0), 100) AS popularity FROM ({RAW_T}) r) t
    GROUP BY artists, track_genre, explicit, popularity""",
)
def upload_defaults(spark, sf):
    raw = S.raw_tracks(spark, sf).withColumnsRenamed({"track_genre": " Genre ", "artists": "Artist"})
    up = C.with_defaults(C.normalise_upload_names(raw), {"artists": "Artista desconocido", "track_genre": "realtime_input"})
    pop = F.coalesce(N.clip(N.safe_double(F.col("popularity")), 0, 100), F.lit(0.0))
    up = up.withColumns({"explicit": N.truthy(F.col("explicit")), "popularity": pop})
    return up.groupBy("artists", "track_genre", "explicit", "popularity").agg(F.count("*").alias("rows"))


@query(
    "tolerant_projection",
    f"SELECT track_id, {rnd('energy', 'energy')}, CAST(0 AS DOUBLE) AS spec_rate FROM ({S.FEATURES_SQL}) f",
)
def tolerant_projection(spark, sf):
    kept = C.keep_existing(S.features(spark, sf), ["track_id", "not_there", "energy", "spec_rate"])
    return rounded(C.ensure_numeric(kept, ["spec_rate"]), ["energy"])


# --- filters ---------------------------------------------------------------------------------------
@query("genre_filter", f"SELECT track_id, track_genre FROM ({S.TRACKS_SQL}) t WHERE lower(track_genre) = 'economy'")
def genre_filter(spark, sf):
    return Q.by_genre(S.tracks(spark, sf), " Economy ").select("track_id", "track_genre")


@query(
    "artist_filter",
    f"""SELECT track_id, artists FROM ({S.TRACKS_SQL}) t WHERE len(list_filter(list_append(list_transform(string_split_regex(artists, '[;,/&]+'),
      lambda x: regexp_replace(strip_accents(lower(trim(x))), '[^a-z0-9]+', '', 'g')), regexp_replace(strip_accents(lower(artists)), '[^a-z0-9]+', '', 'g')), lambda n: contains(n, 'artist7') OR contains(n, 'brand12'))) > 0""",
)
def artist_filter(spark, sf):
    return Q.by_artist(S.tracks(spark, sf), "ÁRTIST 7 / brand#12").select("track_id", "artists")


@query(
    "score_range_filter",
    f"SELECT track_id, round(score, 6) AS recommendation_score FROM (SELECT track_id, (popularity / 100.0 + valence + energy) / 3 AS score FROM ({S.TRACKS_SQL}) t) s WHERE score >= 0.60 AND score < 0.75",
)
def score_range_filter(spark, sf):
    from ..functions.rules import base_score

    scored = S.tracks(spark, sf).select("track_id", base_score(F.col("popularity"), F.col("valence"), F.col("energy")).alias("recommendation_score"))
    return rounded(Q.by_score_range(scored, "0.60 - 0.75"), ["recommendation_score"])


@query(
    "text_search",
    "SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'tion') AND contains(lower(source), 'src1')",
)
def text_search(spark, sf):
    d = load(spark, sf, "documents")
    return d.filter(X.contains_ci(F.col("text"), "TION") & X.contains_ci(F.col("source"), "src1")).select("doc_id", "lang")


@query(
    "mood_alias",
    """SELECT mood, count(*) AS rows FROM (SELECT CASE o_custkey % 5 WHEN 0 THEN 'sad' WHEN 1 THEN 'energetic' WHEN 2 THEN 'calm'
        ELSE 'happy' END AS mood FROM orders) t GROUP BY mood""",
)
def mood_alias(spark, sf):
    spoken = F.element_at(F.array(*[F.lit(x) for x in (" Triste", "ENERGICO ", "tranquilo", "alegre", "other")]), (F.col("o_custkey") % 5 + 1).cast("int"))
    return load(spark, sf, "orders").select(P.mood_alias(spoken).alias("mood")).groupBy("mood").agg(F.count("*").alias("rows"))


# --- dedup and set operations ----------------------------------------------------------------------
@query(
    "first_source_wins",
    """SELECT track_id, src, genre FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY r, genre ASC NULLS FIRST, qty) AS rn FROM (
      SELECT l_partkey AS track_id, 'tracks' AS src, l_returnflag AS genre, 0 AS r, l_quantity AS qty FROM lineitem WHERE l_partkey % 2 = 0
      UNION ALL SELECT l_partkey, 'lyrics', NULL, 1, l_quantity FROM lineitem) u) t WHERE rn = 1""",
)
def first_source_wins(spark, sf):
    li = load(spark, sf, "lineitem").withColumnRenamed("l_partkey", "track_id")
    a = li.filter("track_id % 2 = 0").select("track_id", F.lit("tracks").alias("src"), F.col("l_returnflag").alias("genre"), F.col("l_quantity").alias("qty"))
    b = li.select("track_id", F.lit("lyrics").alias("src"), F.col("l_quantity").alias("qty"))
    out = K.first_source_wins([a, b], ["track_id"], [F.col("genre").asc_nulls_first(), F.col("qty").asc()])
    return out.select("track_id", "src", "genre")


@query(
    "distinct_rows",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_discount, l_tax FROM lineitem",
)
def distinct_rows(spark, sf):
    return load(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_discount", "l_tax").distinct()


@query(
    "union_missing_columns",
    """SELECT kind, key, amount, status FROM (SELECT 'order' AS kind, o_orderkey AS key, o_totalprice AS amount, o_orderstatus AS status FROM orders
      UNION ALL SELECT 'customer', c_custkey, c_acctbal, NULL FROM customer) u""",
)
def union_missing_columns(spark, sf):
    o = load(spark, sf, "orders").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"))
    c = load(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount"))
    return o.unionByName(c, allowMissingColumns=True)
