"""Runs over time: clean or accumulated Bronze, registration, stored statistics, resumed streams, TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import SHARED_FEATURES
from ..operators import metadata as MD
from ..operators import phrases as PH
from ..operators import prepare as R
from ..operators import upload as U
from ..session import shared_dir
from ..sources import io
from ..streaming import jobs as X
from . import standins as S
from .registry import load, query, rounded


@query(
    "bronze_runs",
    """SELECT 'accumulate' AS mode, o_orderstatus, count(*) AS rows FROM (SELECT o_orderstatus FROM orders UNION ALL SELECT o_orderstatus FROM orders WHERE o_orderkey % 2 = 0) a GROUP BY o_orderstatus
    UNION ALL SELECT 'clean', o_orderstatus, count(*) FROM orders GROUP BY o_orderstatus""",
)
def bronze_runs(spark, sf):
    """A second ingest on top of historical Bronze, and one that starts clean."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    out = None
    for mode in ("accumulate", "clean"):
        path = shared_dir(spark, f"bronze-{mode}")
        io.append_json_lines(o.filter("o_orderkey % 2 = 0"), path)
        io.append_json_lines(o, path, clean=mode == "clean")
        rows = io.good_lines(io.read_bronze(spark, path, o.schema)).groupBy("o_orderstatus").agg(F.count("*").alias("rows"))
        one = rows.select(F.lit(mode).alias("mode"), "o_orderstatus", "rows")
        out = one if out is None else out.unionByName(one)
    return out


def _dataset_runs(spark, sf, entries: list[tuple[str, str, str]]) -> DataFrame:
    out = None
    for run, name, status in entries:
        one = MD.dataset_summary(load(spark, sf, name)).select(
            F.lit(run).alias("run_id"), F.lit(name).alias("dataset_name"), F.lit("gold").alias("layer_name"),
            "row_count", "file_count", "size_bytes", F.lit(status).alias("status"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "metadata_registration",
    """WITH d AS (SELECT 'r1' AS run_id, 'customer' AS dataset_name, 'running' AS status, (SELECT count(*) FROM customer) AS row_count
      UNION ALL SELECT 'r1', 'orders', 'success', (SELECT count(*) FROM orders) UNION ALL SELECT 'r1', 'lineitem', 'success', (SELECT count(*) FROM lineitem)
      UNION ALL SELECT 'r2', 'customer', 'success', (SELECT count(*) FROM customer))
    SELECT run_id, CASE run_id WHEN 'r1' THEN 'success' ELSE 'running' END AS run_status, dataset_name, 'gold' AS layer_name, row_count, CAST(1 AS BIGINT) AS file_count, status,
      CAST(sum(row_count) OVER (PARTITION BY run_id) AS BIGINT) AS total_rows, count(*) OVER (PARTITION BY run_id) AS datasets FROM d""",
)
def metadata_registration(spark, sf):
    """Runs and dataset runs are registered when they start and again when they end."""
    first = _dataset_runs(spark, sf, [("r1", n, "running") for n in ("customer", "orders", "lineitem")])
    later = _dataset_runs(spark, sf, [("r1", "orders", "success"), ("r1", "lineitem", "success"), ("r2", "customer", "success")])
    data = MD.register_dataset_run(first, later)
    runs = lambda *rows: spark.createDataFrame(rows, "run_id string, run_status string")
    done = MD.register_run(runs(("r1", "running")), runs(("r1", "success"), ("r2", "running")))
    out = data.join(done, "run_id").join(MD.run_totals(data), "run_id")
    return out.select("run_id", "run_status", "dataset_name", "layer_name", "row_count", "file_count", "status", "total_rows", "datasets")


_COLUMNS = {"customer": ("c_custkey", "c_name", "c_mktsegment"), "orders": ("o_orderkey", "o_custkey", "o_orderstatus")}


@query(
    "column_registration",
    " UNION ALL ".join(
        f"SELECT '{t}' AS dataset_name, '{c}' AS column_name, count(*) - count({c}) AS null_count, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM {t}"
        for t, own in _COLUMNS.items() for c in own
    ),
)
def column_registration(spark, sf):
    """A dataset's column statistics replace those that the same run registered before."""

    def stats(table, names):
        one = MD.column_stats(load(spark, sf, table), list(names))
        return one.select(F.lit("r1").alias("run_id"), F.lit(table).alias("dataset_name"), F.lit("gold").alias("layer_name"), "*")

    old = stats("customer", ["c_custkey", "c_acctbal"]).unionByName(stats("orders", _COLUMNS["orders"]))
    out = MD.register_column_stats(old, stats("customer", _COLUMNS["customer"]))
    return out.select("dataset_name", "column_name", "null_count", "min_value", "max_value")


_SCALED = ("l_quantity", "l_extendedprice")


@query(
    "stored_scaler",
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(f"round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_samp({c}) FROM lineitem), 6) AS {c}" for c in _SCALED)
    + " FROM lineitem",
)
def stored_scaler(spark, sf):
    """Scaler statistics are stored, found again behind two unfit candidates, and applied."""
    path = shared_dir(spark, "scaler")
    lines = load(spark, sf, "lineitem")
    io.write_layer(R.scaler_stats(lines, list(_SCALED)), path)
    stats = io.load_scaler_stats(spark, [f"{path}/missing.csv", f"{sf}/customer.parquet", path])
    out = R.apply_scaler(lines, stats, list(_SCALED)).select("l_orderkey", "l_linenumber", "l_partkey", *_SCALED)
    return rounded(out, list(_SCALED))


# An upload with the usual faults: rows without a link, energy out of range, missing values.
_UPLOAD = {
    **{c: S.FEATURES[c] for c in SHARED_FEATURES},
    "energy": f"CASE WHEN l_quantity = 13 THEN 1.5 ELSE {S.FEATURES['energy']} END",
    "danceability": f"CASE WHEN l_quantity = 7 THEN NULL ELSE {S.FEATURES['danceability']} END",
    "spotify_url": "CASE WHEN l_linenumber = 7 THEN '' ELSE concat('https://open.spotify.com/track/', lpad(CAST(l_partkey AS STRING), 22, '0')) END",
}
# Stand-in for a fitted model: shares as a fixed function of the scaled features.
_SHARES = {"sad": "1 / (1 + exp(valence))", "happy": "1 / (1 + exp(0 - valence))", "energetic": "1 / (1 + exp(0 - energy))", "calm": "1 / (1 + exp(energy))"}
_Z = ", ".join(f"({c} - (SELECT avg({c}) FROM f)) / (SELECT stddev_samp({c}) FROM f) AS {c}" for c in ("energy", "valence"))


@query(
    "upload_catalog",
    f"""WITH f AS ({S.FEATURES_SQL}), u AS ({S.view_sql(_UPLOAD, "lineitem")}), ok AS (SELECT * FROM u WHERE spotify_url <> '' AND energy <= 1 AND danceability IS NOT NULL),
    z AS (SELECT {_Z} FROM ok), p AS (SELECT {", ".join(f"({e}) / 2 AS {m}" for m, e in _SHARES.items())} FROM z),
    c AS (SELECT greatest(sad, happy, energetic, calm) AS top, CASE WHEN sad >= greatest(happy, energetic, calm) THEN 'sad' WHEN happy >= greatest(energetic, calm) THEN 'happy' WHEN energetic >= calm THEN 'energetic' ELSE 'calm' END AS mood FROM p),
    h AS (SELECT mood, count(*) AS n, round(sum(top), 4) AS total FROM c GROUP BY mood)
    SELECT 'catalog' AS part, 'base' AS source, 'calm' AS predicted_mood, count(*) AS rows, CAST(count(*) AS DOUBLE) AS confidence FROM part
    UNION ALL SELECT 'catalog', 'realtime_prediction', mood, n, total FROM h UNION ALL SELECT 'history', 'realtime_prediction', mood, n, total FROM h
    UNION ALL SELECT 'rejected', NULL, NULL, (SELECT count(*) FROM u) - (SELECT count(*) FROM ok), NULL""",
)
def upload_catalog(spark, sf):
    """An upload is checked, scaled with stored statistics, classified, and appended to catalog and history."""
    base = shared_dir(spark, "upload")
    io.write_layer(R.scaler_stats(S.features(spark, sf), list(SHARED_FEATURES)), f"{base}/scaler")
    catalog = load(spark, sf, "part").selectExpr(
        "concat('T', CAST(p_partkey AS STRING)) AS track_id", "p_name AS track_name", "'calm' AS predicted_mood", "CAST(1 AS DOUBLE) AS mood_confidence",
        "'base' AS source", "CAST(NULL AS STRING) AS cover_url",
    )
    io.write_layer(catalog, f"{base}/catalog")
    uploaded = S.view(spark, sf, _UPLOAD, "lineitem").withColumnsRenamed({"duration_ms": "Duration (ms)", "spotify_url": "URL"})
    score = lambda df: df.withColumns({f"p_{m}": F.expr(f"({e}) / 2") for m, e in _SHARES.items()})
    done, rejected = U.classify_upload(uploaded, score, io.load_scaler_stats(spark, [f"{base}/scaler"]))
    io.append_classified(done, f"{base}/catalog", f"{base}/history")
    out = rejected.agg(
        F.lit("rejected").alias("part"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("predicted_mood"),
        F.count("*").alias("rows"), F.lit(None).cast("double").alias("confidence"),
    )
    for part in ("catalog", "history"):
        rows = io.read_layer(spark, f"{base}/{part}").groupBy("source", "predicted_mood")
        sums = rows.agg(F.count("*").alias("rows"), F.round(F.sum("mood_confidence"), 4).alias("confidence"))
        out = out.unionByName(sums.withColumn("part", F.lit(part)))
    return out


@query("stream_history", "SELECT event_type, 2 * count(*) AS rows, round(2 * sum(value), 4) AS total, CAST(2 AS BIGINT) AS runs, 3 AS last_batch FROM events GROUP BY event_type")
def stream_history(spark, sf):
    """Several files and batches; a job that goes on with later files, then a second job: both histories stay."""
    base = shared_dir(spark, "history")
    e = load(spark, sf, "events").select("event_id", "event_type", "value")

    def job(name):
        stream = X.file_stream(spark, f"{base}/in", e.schema, max_files=2)
        X.classify_online(stream, lambda batch: batch, f"{base}/delta", f"{base}/history", f"{base}/{name}")

    e.filter("event_id % 4 > 0").repartition(6, "event_id").write.parquet(f"{base}/in")
    job("first")
    e.filter("event_id % 4 = 0").repartition(2, "event_id").write.mode("append").parquet(f"{base}/in")
    job("first")
    job("second")
    out = io.read_layer(spark, f"{base}/history").groupBy("event_type")
    return out.agg(
        F.count("*").alias("rows"), F.round(F.sum("value"), 4).alias("total"), F.countDistinct("run").alias("runs"), F.max("batch").alias("last_batch")
    )


@query(
    "tf_idf",
    r"""WITH t AS (SELECT conv_id * 1000 + turn AS text_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}_]+'), lambda x: length(x) >= 2) AS w,
      list_filter(string_split_regex(lower(text), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS c FROM conversations),
    p AS (SELECT text_id, p, unnest([3, 4, 5]) AS n FROM (SELECT text_id, ' ' || unnest(c) || ' ' AS p FROM t) q),
    g AS (SELECT text_id, 0 AS kind, unnest(w) AS term FROM t
      UNION ALL SELECT text_id, 0, w[i] || ' ' || w[i + 1] FROM (SELECT text_id, w, unnest(range(1, len(w))) AS i FROM t) x
      UNION ALL SELECT text_id, 1, substr(p, i, n) FROM (SELECT text_id, p, n, unnest(range(1, length(p) - n + 2)) AS i FROM p) x),
    tf AS (SELECT text_id, kind, term, count(*) AS tf FROM g GROUP BY text_id, kind, term),
    idf AS (SELECT kind, term, ln((1.0 + (SELECT count(*) FROM conversations)) / (1.0 + count(*))) + 1 AS idf FROM tf GROUP BY kind, term),
    x AS (SELECT text_id, kind, tf * idf AS w FROM tf JOIN idf USING (kind, term))
    SELECT text_id, kind, count(*) AS terms, round(sum(w) / sqrt(sum(w * w)), 4) AS total, round(max(w) / sqrt(sum(w * w)), 4) AS top FROM x GROUP BY text_id, kind""",
)
def tf_idf(spark, sf):
    """Weights of the words, word pairs and character grams of all turns, per text and kind."""
    c = load(spark, sf, "conversations").selectExpr("conv_id * 1000 + turn AS text_id", "text")
    weights = PH.tf_idf(c, "text_id", "text")
    return weights.groupBy("text_id", "kind").agg(
        F.count("*").alias("terms"), F.round(F.sum("weight"), 4).alias("total"), F.round(F.max("weight"), 4).alias("top")
    )
