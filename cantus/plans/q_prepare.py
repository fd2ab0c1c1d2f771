"""Feature preparation, splits, samples, numeric and parsing functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import BUCKETS
from ..functions import numeric as N
from ..functions import parse as P
from ..operators import columns as C
from ..operators import prepare as R
from ..operators import ranking as K
from . import standins as S
from .registry import load, query, rnd, rounded

ENGINEERED = {
    "energy_valence_interaction": "energy * valence",
    "energy_squared": "energy * energy",
    **{
        f"{f}_bucket_{b}": f"CASE WHEN (CASE WHEN {f} < 0.33 THEN 'low' WHEN {f} < 0.66 THEN 'mid' ELSE 'high' END) = '{b}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
        for f in ("energy", "valence")
        for b in BUCKETS
    },
    "tempo_log1p": "ln(1 + greatest(tempo, 0))",
    "duration_sqrt": "sqrt(greatest(duration_ms, 0))",
    "acoustic_instrumental_mix": "acousticness * instrumentalness",
}


@query("engineered_features", f"SELECT row_id, {', '.join(rnd(e, c) for c, e in ENGINEERED.items())} FROM ({S.FEATURES_SQL}) f")
def engineered_features(spark, sf):
    return rounded(R.engineered(S.features(spark, sf)).select("row_id", *ENGINEERED), list(ENGINEERED))


SCALE = ["energy", "valence", "loudness", "tempo"]
_STATS = " UNION ALL ".join(f"SELECT '{c}' AS feature, avg({c}) AS mean, coalesce(nullif(stddev_samp({c}), 0), 1) AS std FROM ({S.FEATURES_SQL}) f" for c in SCALE)


@query("scaler_stats", f"SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std FROM ({_STATS}) s")
def scaler_stats(spark, sf):
    return rounded(R.scaler_stats(S.features(spark, sf), SCALE), ["mean", "std"])


def _scaled_sql(expr: str) -> str:
    cols = ", ".join(rnd(expr.format(c=c), c) for c in SCALE)
    stats = ", ".join(f"avg({c}) AS mean_{c}, stddev_samp({c}) AS std_{c}" for c in SCALE)
    return f"SELECT row_id, {cols} FROM ({S.FEATURES_SQL}) f, (SELECT {stats} FROM ({S.FEATURES_SQL}) g) s"


@query("zscore_features", _scaled_sql("({c} - mean_{c}) / std_{c}"))
def zscore_features(spark, sf):
    f = S.features(spark, sf)
    return rounded(R.apply_scaler(f, R.scaler_stats(f, SCALE), SCALE).select("row_id", *SCALE), SCALE)


@query("unscale_features", f"SELECT row_id, {', '.join(rnd(c, c) for c in SCALE)} FROM ({S.FEATURES_SQL}) f")
def unscale_features(spark, sf):
    f = S.features(spark, sf)
    stats = R.scaler_stats(f, SCALE)
    return rounded(R.invert_scaler(R.apply_scaler(f, stats, SCALE), stats, SCALE).select("row_id", *SCALE), SCALE)


@query(
    "clip_iqr",
    f"""WITH f AS ({S.FEATURES_SQL}), b AS (SELECT quantile_cont(tempo, 0.25) AS t1, quantile_cont(tempo, 0.75) AS t3 FROM f)
    SELECT row_id, round(least(greatest(tempo, t1 - 1.5 * (t3 - t1)), t3 + 1.5 * (t3 - t1)), 6) AS tempo, round(energy, 6) AS energy FROM f, b""",
)
def clip_iqr(spark, sf):
    return rounded(R.clip_iqr(S.features(spark, sf), ["energy", "tempo"], exact=True).select("row_id", "tempo", "energy"), ["tempo", "energy"])


@query("clip_iqr_approx")
def clip_iqr_approx(spark, sf):
    return R.clip_iqr(S.features(spark, sf), ["energy", "loudness", "tempo", "duration_ms"]).select("row_id", "energy", "loudness", "tempo", "duration_ms")


# --- splits, folds, samples ------------------------------------------------------------------------
TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "stratified_split",
    """SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5(CAST(event_id AS VARCHAR))) <= floor(0.8 * count(*) OVER (PARTITION BY event_type)) AS is_train FROM events""",
)
def stratified_split(spark, sf):
    return K.stratified_split(load(spark, sf, "events"), "event_type", TYPES, ["event_id"]).select("event_id", "event_type", "is_train")


_FOLD = """SELECT event_id, CAST((rn > floor(cnt * (1.0 / 3))) AS INTEGER) + CAST((rn > floor(cnt * (2.0 / 3))) AS INTEGER) AS fold
  FROM (SELECT event_id, row_number() OVER ({by} ORDER BY md5(CAST(event_id AS VARCHAR))) AS rn, count(*) OVER ({by}) AS cnt FROM events) t"""


@query("stratified_folds", _FOLD.format(by="PARTITION BY event_type"))
def stratified_folds(spark, sf):
    return K.fold_column(load(spark, sf, "events"), ["event_id"], 3, "event_type", TYPES).select("event_id", "fold")


@query("plain_folds", _FOLD.format(by="PARTITION BY 1"))
def plain_folds(spark, sf):
    return K.fold_column(load(spark, sf, "events"), ["event_id"], 3).select("event_id", "fold")


@query("sample_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(concat('42|', CAST(o_orderkey AS VARCHAR))) LIMIT 1000")
def sample_rows(spark, sf):
    return K.sample_rows(load(spark, sf, "orders"), ["o_orderkey"], 1000).select("o_orderkey", "o_totalprice")


@query("positions", "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS sample_index FROM orders")
def positions(spark, sf):
    return K.positions(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "running_total",
    """SELECT l_returnflag, l_extendedprice, CAST(sum(n) OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS BIGINT) AS upto FROM
       (SELECT l_returnflag, l_extendedprice, count(*) AS n FROM lineitem GROUP BY 1, 2) t""",
)
def running_total(spark, sf):
    counts = load(spark, sf, "lineitem").groupBy("l_returnflag", "l_extendedprice").agg(F.count("*").alias("n"))
    return K.running_total(counts, ["l_returnflag"], "l_extendedprice", F.col("n"), to="upto").select("l_returnflag", "l_extendedprice", "upto")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(spark, sf):
    return K.top_k(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 20, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])


@query(
    "top_k_per_key",
    "SELECT c_nationkey, c_custkey, CAST(rank AS INTEGER) AS rank FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer) t WHERE rank <= 5",
)
def top_k_per_key(spark, sf):
    c = load(spark, sf, "customer")
    return K.top_k_per(c, ["c_nationkey"], 5, [F.col("c_acctbal").desc(), F.col("c_custkey").asc()]).select("c_nationkey", "c_custkey", "rank")


@query("seeded_shuffle", "SELECT p_partkey, p_name FROM part ORDER BY md5(concat('7|', CAST(p_partkey AS VARCHAR))), p_partkey LIMIT 25")
def seeded_shuffle(spark, sf):
    return K.shuffled(load(spark, sf, "part"), ["p_partkey"], 25, 7).select("p_partkey", "p_name")


# --- numeric functions ------------------------------------------------------------------------------
@query(
    "numeric_functions",
    """SELECT event_id, round(1 / (1 + exp(-least(greatest(value - 30, -20), 20))), 6) AS sig, round(least(greatest(1 - abs(value / 50 - 0.85) / 4.0, 0), 1), 6) AS close,
      round(least(greatest(value, 0), 100) / 100, 6) AS pop, round(ln(1 + value), 6) AS log1p, round(value * 2.5 + 1, 6) AS unscaled,
      CASE WHEN value / 100 < 0.33 THEN 'low' WHEN value / 100 < 0.66 THEN 'mid' ELSE 'high' END AS bucket,
      round(value / greatest(user_id, 1), 10) AS rate FROM events""",
)
def numeric_functions(spark, sf):
    v = F.col("value")
    out = load(spark, sf, "events").select(
        "event_id", N.sigmoid(v - 30).alias("sig"), N.closeness(v / 50, 0.85).alias("close"), N.popularity_unit(v).alias("pop"),
        F.log1p(v).alias("log1p"), N.unscale(v, 1, 2.5).alias("unscaled"), N.bucket3(v / 100).alias("bucket"), N.spec_rate(v, F.col("user_id")).alias("rate"),
    )
    return rounded(rounded(out, ["sig", "close", "pop", "log1p", "unscaled"]), ["rate"], 10)


@query(
    "row_argmax",
    """SELECT row_id, CASE WHEN energy >= valence AND energy >= danceability AND energy >= liveness THEN 'energy' WHEN valence >= danceability AND valence >= liveness THEN 'valence'
        WHEN danceability >= liveness THEN 'danceability' ELSE 'liveness' END AS best, round(greatest(energy, valence, danceability, liveness), 6) AS top,
      round(energy / CASE WHEN energy + valence + danceability + liveness = 0 THEN 1 ELSE energy + valence + danceability + liveness END, 6) AS share FROM (""" + S.FEATURES_SQL + ") f",
)
def row_argmax(spark, sf):
    names = ["energy", "valence", "danceability", "liveness"]
    cols = [F.col(c) for c in names]
    out = S.features(spark, sf).select("row_id", N.argmax_name(cols, names).alias("best"), F.greatest(*cols).alias("top"), N.normalise(cols)[0].alias("share"))
    return rounded(out, ["top", "share"])


# --- parsers ------------------------------------------------------------------------------------------
_DIRTY = {
    "event_id": "event_id",
    "pct": "CASE event_id % 5 WHEN 0 THEN concat(CAST(user_id % 120 AS STRING), ',5') WHEN 1 THEN CAST(user_id % 120 AS STRING) WHEN 2 THEN '-3' WHEN 3 THEN 'abc' ELSE '0.25' END",
    "clock": "CASE event_id % 6 WHEN 0 THEN concat(CAST(user_id % 60 AS STRING), ':07') WHEN 1 THEN concat('1:02:', CAST(user_id % 60 AS STRING)) WHEN 2 THEN '215' WHEN 3 THEN '185000' WHEN 4 THEN 'x:y' ELSE '12,5' END",
    "loud": "CASE event_id % 4 WHEN 0 THEN concat('-', CAST(user_id % 60 AS STRING), ' dB') WHEN 1 THEN CAST(user_id % 100 AS STRING) WHEN 2 THEN '0.5' ELSE '' END",
    "is_text": "event_id % 4 = 0",
    "ms": "user_id * 1234 - 1000",
}
_N = "TRY_CAST(replace({c}, ',', '.') AS DOUBLE)"


@query(
    "value_parsers",
    f"""WITH d AS ({S.view_sql(_DIRTY, "events")}), n AS (SELECT *, {_N.format(c="pct")} AS p, {_N.format(c="clock")} AS t, string_split(clock, ':') AS parts, TRY_CAST(loud AS DOUBLE) AS l FROM d)
    SELECT event_id,
      round(coalesce(CASE WHEN p < 0 THEN 0 WHEN p > 1 THEN least(p / 100, 1) ELSE p END, 0), 6) AS unit,
      CAST(coalesce(CASE WHEN p IS NULL OR p < 0 THEN 0 ELSE round_even(least(CASE WHEN p > 0 AND p < 1 THEN p * 100 ELSE p END, 100), 0) END, 0) AS INTEGER) AS pop,
      CAST(coalesce(CASE WHEN contains(clock, ':') AND regexp_matches(clock, '^[0-9:]+$') THEN CASE WHEN len(parts) = 2 THEN (CAST(parts[1] AS BIGINT) * 60 + CAST(parts[2] AS BIGINT)) * 1000
          ELSE (CAST(parts[1] AS BIGINT) * 3600 + CAST(parts[2] AS BIGINT) * 60 + CAST(parts[3] AS BIGINT)) * 1000 END
        WHEN t <= 0 THEN 0 WHEN t < 1000 THEN CAST(floor(t * 1000) AS BIGINT) ELSE CAST(floor(t) AS BIGINT) END, 0) AS BIGINT) AS duration,
      round(coalesce(CASE WHEN is_text THEN TRY_CAST(trim(replace(lower(loud), 'db', '')) AS DOUBLE)
        WHEN (CASE WHEN l BETWEEN 0 AND 1 THEN l * 100 ELSE l END) BETWEEN 0 AND 100 THEN (CASE WHEN l BETWEEN 0 AND 1 THEN l * 100 ELSE l END) / 100 * 60 - 60 ELSE l END, 0), 6) AS loudness,
      CASE WHEN ms > 0 THEN concat(CAST(CAST(floor(CAST(round_even(ms / 1000.0, 0) AS BIGINT) / 60.0) AS BIGINT) AS VARCHAR), ':', lpad(CAST(CAST(round_even(ms / 1000.0, 0) AS BIGINT) % 60 AS VARCHAR), 2, '0')) ELSE '-' END AS shown
    FROM n""",
)
def value_parsers(spark, sf):
    d = S.view(spark, sf, _DIRTY, "events")
    out = d.select(
        "event_id", P.unit_value(F.col("pct")).alias("unit"), P.popularity_100(F.col("pct")).alias("pop"), P.duration_ms(F.col("clock")).alias("duration"),
        P.loudness_db(F.col("loud"), F.col("is_text")).alias("loudness"), P.format_duration(F.col("ms")).alias("shown"),
    )
    return rounded(out, ["unit", "loudness"])


@query(
    "url_ids",
    r"""SELECT page_id, nullif(regexp_extract(url, '^https?://[a-z.]+/([a-z]{2})/([0-9]+)', 2), '') AS found,
      concat('https://open.spotify.com/intl-es/track/', nullif(regexp_extract(url, '^https?://[a-z.]+/([a-z]{2})/([0-9]+)', 2), '')) AS built FROM pages""",
)
def url_ids(spark, sf):
    found = P.track_id_from_url(F.col("url"), r"^https?://[a-z.]+/[a-z]{2}/([0-9]+)")
    return load(spark, sf, "pages").select("page_id", found.alias("found")).withColumn("built", F.when(F.col("found").isNotNull(), P.track_url(F.col("found"))).otherwise(F.lit("https://open.spotify.com/intl-es/track/")))


@query(
    "object_keys",
    """SELECT layer, dataset, count(*) AS rows FROM (SELECT CASE WHEN len(p) >= 2 AND p[1] <> '' THEN p[1] ELSE 'unknown' END AS layer, CASE WHEN len(p) >= 2 AND p[2] <> '' THEN p[2] ELSE 'unknown' END AS dataset
      FROM (SELECT string_split(CASE WHEN event_id % 10 = 0 THEN 'loose.parquet' ELSE concat(event_type, '/', CASE WHEN user_id % 4 = 0 THEN '' ELSE concat('set ', CAST(user_id % 4 AS VARCHAR)) END, '/part.parquet') END, '/') AS p FROM events) x) t GROUP BY layer, dataset""",
)
def object_keys(spark, sf):
    raw = F.expr("CASE WHEN event_id % 10 = 0 THEN 'loose.parquet' ELSE concat(event_type, '/', CASE WHEN user_id % 4 = 0 THEN '' ELSE concat('set+', CAST(user_id % 4 AS STRING)) END, '%2Fpart.parquet') END")
    return load(spark, sf, "events").select(P.object_key(raw).alias("k")).groupBy(F.col("k.layer").alias("layer"), F.col("k.dataset").alias("dataset")).agg(F.count("*").alias("rows"))


@query("label_codes", "SELECT o_orderpriority, count(*) AS rows, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code FROM orders GROUP BY o_orderpriority")
def label_codes(spark, sf):
    from pyspark.ml.feature import StringIndexer

    o = load(spark, sf, "orders").select("o_orderpriority")
    model = StringIndexer(inputCol="o_orderpriority", outputCol="code", stringOrderType="alphabetAsc").fit(o)
    return model.transform(o).groupBy("o_orderpriority", F.col("code").cast("int").alias("code")).agg(F.count("*").alias("rows"))


@query("rounded_display", 'SELECT c_custkey AS "Track ID", round_even(c_acctbal / 7, 4) AS "Score" FROM customer')
def rounded_display(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("track_id"), (F.col("c_acctbal") / 7).alias("recommendation_score"))
    return C.display_names(C.rounded(c, ["recommendation_score"], 4), {"track_id": "Track ID", "recommendation_score": "Score"})
