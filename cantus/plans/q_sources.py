"""Source, sink and streaming queries.  Each writes what it reads back below the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import MOODS
from ..operators import joins as J
from ..operators import layers as L
from ..operators import mood as M
from ..operators import ranking as K
from ..schemas import TRACKS
from ..session import shared_dir
from ..sources import io
from ..streaming import jobs as X
from . import standins as S
from .q_layers import RAW_T, SILVER_TRACKS
from .registry import load, query, rounded

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
    ]
)


def events_stream(spark, sf):
    schema = load(spark, sf, "events").schema  # keeps the file's own timestamp type
    return X.file_stream(spark, f"{sf}/events.parquet", schema, max_files=64)


@query("csv_round_trip", f"SELECT track_genre, explicit, count(*) AS rows, CAST(sum(TRY_CAST(popularity AS DOUBLE)) AS BIGINT) AS popularity FROM ({RAW_T}) r GROUP BY track_genre, explicit")
def csv_round_trip(spark, sf):
    path = shared_dir(spark, "csv")
    raw = S.raw_tracks(spark, sf).select(*[F.col(f"`{c}`").cast("string") for c in TRACKS.columns])
    io.write_csv(raw, path)
    back = io.read_csv(spark, path, TRACKS)
    return back.groupBy("track_genre", "explicit").agg(F.count("*").alias("rows"), F.sum(F.col("popularity").try_cast("double")).cast("bigint").alias("popularity"))


@query(
    "bronze_to_silver",
    f"SELECT track_id, artists, track_genre, popularity, duration_ms, explicit, round(energy, 6) AS energy FROM ({SILVER_TRACKS}) s",
)
def bronze_to_silver(spark, sf):
    """Raw rows -> envelopes -> Bronze JSON Lines -> typed Silver."""
    raw = S.raw_tracks(spark, sf).drop("Unnamed: 0")
    path = shared_dir(spark, "bronze")
    payload = io.open_envelope(io.envelope(raw, "tracks_dataset", "track_id"), raw.schema, "tracks_dataset")
    io.append_json_lines(payload, path)
    silver = L.silver_tracks(io.good_lines(io.read_bronze(spark, path, raw.schema)))
    return rounded(silver.select("track_id", "artists", "track_genre", "popularity", "duration_ms", "explicit", "energy"), ["energy"])


@query("envelope_round_trip", "SELECT event_type, count(*) AS rows, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def envelope_round_trip(spark, sf):
    e = load(spark, sf, "events")
    wire = io.envelope(e.withColumn("ts", F.col("ts").cast("string")), "events", "event_id")
    schema = T.StructType([f if f.name != "ts" else T.StructField("ts", T.StringType()) for f in e.schema])
    back = io.open_envelope(wire, schema, "events")
    return back.groupBy("event_type").agg(F.count("*").alias("rows"), F.round(F.sum("value"), 4).alias("total"))


@query("layer_write_and_append", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders WHERE o_orderkey % 2 = 1")
def layer_write_and_append(spark, sf):
    """Overwrite a layer, append rows with a missing and an extra column, read it back pruned."""
    path = shared_dir(spark, "layer")
    o = load(spark, sf, "orders")
    io.write_layer(o.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), path, observe="orders")
    io.append_aligned(o.filter("o_orderkey % 2 = 1").select("o_totalprice", "o_orderkey", "o_orderpriority"), path)
    return io.read_layer(spark, path, ["o_orderkey", "o_orderstatus", "o_totalprice"])


@query("registered_table", "SELECT c_mktsegment, count(*) AS rows FROM customer GROUP BY c_mktsegment")
def registered_table(spark, sf):
    path = shared_dir(spark, "table")
    io.write_layer(load(spark, sf, "customer"), path)
    table = io.register_table(spark, "Gold-Customer." + path[-12:], path)
    return spark.sql(f"SELECT c_mktsegment, count(*) AS rows FROM {table} GROUP BY c_mktsegment")


# --- streams ---------------------------------------------------------------------------------------------
@query("stream_ingest", "SELECT event_id, event_type, value FROM events")
def stream_ingest(spark, sf):
    """Envelopes of all event types, routed by one bounded run into a Bronze folder each."""
    base = shared_dir(spark, "ingest")
    e = events_stream(spark, sf)
    body = F.struct("event_id", "event_type", "value")
    wire = e.select(F.to_json(F.struct(F.col("event_type").alias("dataset"), body.alias("payload"))).alias("value"))
    schema = T.StructType([f for f in EVENT_SCHEMA if f.name in ("event_id", "event_type", "value")])
    X.ingest(wire, f"{base}/bronze", f"{base}/checkpoint")
    return io.good_lines(io.read_bronze(spark, f"{base}/bronze", schema)).filter(F.col("dataset") == F.col("event_type")).drop("dataset")


@query("stream_dedup", "SELECT user_id, count(*) AS rows FROM (SELECT DISTINCT user_id, event_type FROM events) d GROUP BY user_id")
def stream_dedup(spark, sf):
    base = shared_dir(spark, "dedup")
    slim = events_stream(spark, sf).select("user_id", "event_type")
    X.copy_stream(X.deduplicated(slim, ["user_id", "event_type"]), f"{base}/out", f"{base}/checkpoint")
    return io.read_layer(spark, f"{base}/out").groupBy("user_id").agg(F.count("*").alias("rows"))


_SHARE = {"sad": "0.1 + event_id % 7", "happy": "0.1 + event_id % 5", "energetic": "0.1 + user_id % 4", "calm": "0.1 + user_id % 3"}
_SUM = " + ".join(f"({e})" for e in _SHARE.values())


@query(
    "stream_classify",
    "SELECT track_id, predicted_mood, round(CAST(top AS DOUBLE) / total, 6) AS mood_confidence, source FROM (SELECT event_id AS track_id, "
    f"greatest({', '.join(_SHARE.values())}) AS top, {_SUM} AS total, 'realtime_prediction' AS source, "
    f"CASE WHEN {_SHARE['sad']} >= greatest({_SHARE['happy']}, {_SHARE['energetic']}, {_SHARE['calm']}) THEN 'sad' WHEN {_SHARE['happy']} >= greatest({_SHARE['energetic']}, {_SHARE['calm']}) THEN 'happy' "
    f"WHEN {_SHARE['energetic']} >= {_SHARE['calm']} THEN 'energetic' ELSE 'calm' END AS predicted_mood FROM events) t",
)
def stream_classify(spark, sf):
    """Online classification of a stream into a catalog delta, read back as the hot catalog."""
    base = shared_dir(spark, "online")

    def classify(batch):
        shares = batch.selectExpr("event_id AS track_id", *[f"({e}) / ({_SUM}) AS p_{m}" for m, e in _SHARE.items()])
        doubles = shares.withColumns({f"p_{m}": F.col(f"p_{m}").cast("double") for m in MOODS})
        return M.realtime_tags(M.audio_distribution(doubles, {m: f"p_{m}" for m in MOODS})).drop(*[f"p_{m}" for m in MOODS])

    X.classify_online(events_stream(spark, sf), classify, f"{base}/delta", f"{base}/history", f"{base}/checkpoint")
    delta = io.read_layer(spark, f"{base}/delta")
    merged = J.hot_catalog(delta.limit(0), delta, [F.col("ingested_at").desc()])
    return rounded(merged.select("track_id", "predicted_mood", "mood_confidence", "source"), ["mood_confidence"])


_EVENT_KEY = "concat(event_type, '%2Fset+', CAST(user_id % 3 AS STRING), '%2Fpart-', CAST(event_id AS STRING), CASE WHEN event_id % 4 = 0 THEN '.tmp' ELSE '.parquet' END)"


@query(
    "stream_audit",
    """SELECT layer, dataset, count(*) AS records, count(DISTINCT location) AS locations FROM (SELECT event_type AS layer, concat('set ', CAST(user_id % 3 AS VARCHAR)) AS dataset, event_id AS location
      FROM events WHERE event_id % 4 > 0 AND event_id % 5 > 0) t GROUP BY layer, dataset""",
)
def stream_audit(spark, sf):
    """Nested object events on a stream -> audit records partitioned by layer."""
    base = shared_dir(spark, "audit")
    record = F.struct(
        F.expr("CASE WHEN event_id % 5 = 0 THEN 'other' ELSE 'aws:s3' END").alias("eventSource"), F.lit("ObjectCreated:Put").alias("eventName"),
        F.struct(F.struct(F.lit("lake").alias("name")).alias("bucket"), F.struct(F.expr(_EVENT_KEY).alias("key")).alias("object")).alias("s3"),
    )
    wire = events_stream(spark, sf).select(F.to_json(F.struct(F.array(record).alias("Records"))).alias("value"))
    X.copy_stream(X.audit_records(wire, suffix=".parquet"), f"{base}/out", f"{base}/checkpoint", partition_by=["layer"])
    out = io.read_layer(spark, f"{base}/out")
    return out.groupBy("layer", "dataset").agg(F.count("*").alias("records"), F.countDistinct("location").alias("locations"))


@query("stream_replay", "SELECT event_type, count(*) AS rows FROM events GROUP BY event_type")
def stream_replay(spark, sf):
    """A paced replay, then the count check against the batch table."""
    base = shared_dir(spark, "replay")
    X.copy_stream(events_stream(spark, sf), f"{base}/out", f"{base}/checkpoint")
    replayed = K.keep_one(io.read_layer(spark, f"{base}/out"), ["event_id"], [F.col("ts").asc()])
    return replayed.groupBy("event_type").agg(F.count("*").alias("rows"))
