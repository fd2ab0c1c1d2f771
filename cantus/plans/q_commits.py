"""Streams that stop, append once, and forget: counts expected, commit logs, bounded state."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import MOODS
from ..operators import modeling as L
from ..operators import mood as M
from ..session import shared_dir
from ..sources import commits as CM
from ..sources import io
from ..streaming import jobs as X
from . import standins as S
from .registry import load, query

ROWS_PER_FILE = 500_000  # of a stream's input


@query(
    "stream_until_counts",
    """SELECT event_type AS dataset, count(*) AS rows, 'counts' AS first_reason, TRUE AS enough, TRUE AS early, 'end' AS last_reason FROM events GROUP BY event_type""",
)
def stream_until_counts(spark, sf):
    """A stream of many files stops when a tenth of each dataset is there; the rest comes with the resume."""
    base = shared_dir(spark, "counted")
    events = load(spark, sf, "events").select("event_id", "event_type", "value")
    wrapped = events.select(F.to_json(F.struct(F.col("event_type").alias("dataset"), F.struct("event_id", "value").alias("payload"))).alias("value"))
    wrapped.repartition(12, "value").write.parquet(f"{base}/in")
    totals = {r["event_type"]: r["count"] for r in events.groupBy("event_type").count().collect()}
    expected = {d: n // 10 for d, n in totals.items()}
    stream = lambda: X.file_stream(spark, f"{base}/in", wrapped.schema, max_files=1)
    first = X.consume(stream(), f"{base}/bronze", f"{base}/checkpoint", expected)
    last = X.consume(stream(), f"{base}/bronze", f"{base}/checkpoint")
    enough = all(first["counts"].get(d, 0) >= n for d, n in expected.items())
    rows = spark.read.text(f"{base}/bronze").groupBy("dataset").agg(F.count("*").alias("rows"))
    return rows.select(
        "dataset", "rows", F.lit(first["reason"]).alias("first_reason"), F.lit(enough).alias("enough"),
        F.lit(sum(first["counts"].values()) < sum(totals.values())).alias("early"), F.lit(last["reason"]).alias("last_reason"),
    )


_INPUTS = ["energy", "valence", "danceability", "acousticness"]


@query(
    "stream_append_once",
    f"""WITH f AS ({S.FEATURES_SQL}), part_rows AS (SELECT count(*) AS n FROM part), line_rows AS (SELECT count(*) AS n FROM f)
    SELECT 'catalog' AS part, 'base' AS source, part_rows.n AS rows, 4 AS columns, CAST(0 AS BIGINT) AS unlabelled, 3 AS commits, CAST(0 AS BIGINT) AS again FROM part_rows
    UNION ALL SELECT 'catalog', 'realtime_prediction', n, 4, 0, 3, 0 FROM line_rows UNION ALL SELECT 'history', 'realtime_prediction', n, 22, 0, 3, 0 FROM line_rows""",
)
def stream_append_once(spark, sf):
    """A fitted model classifies a stream into an aligned catalog and a history; every batch is then tried again."""
    base = shared_dir(spark, "append-once")
    f = S.features(spark, sf).select("track_id", "label", *_INPUTS)
    model = L.fit(L.classifier_pipeline("logistic_regression", _INPUTS, "label", weight=None, total_weight=1.0), f)
    model.write().overwrite().save(f"{base}/model")
    from pyspark.ml import PipelineModel

    stored = PipelineModel.load(f"{base}/model")

    def classify(rows):
        scored = L.score_classifier(stored, rows.drop("label"), len(MOODS))
        return M.realtime_tags(M.audio_distribution(scored.drop("prediction"), {m: f"p{i}" for i, m in enumerate(MOODS)})).drop(*[f"p{i}" for i in range(len(MOODS))])

    io.write_layer(load(spark, sf, "part").selectExpr("concat('T', CAST(p_partkey AS STRING)) AS track_id", "'calm' AS predicted_mood", "'base' AS source", "CAST(NULL AS STRING) AS cover_url"), f"{base}/catalog")
    files = max(6, -(-f.count() // ROWS_PER_FILE))  # dealt row by row: neither the table nor one track lands in a few tasks
    f.repartition(files).write.parquet(f"{base}/in")
    X.classify_and_append(X.file_stream(spark, f"{base}/in", f.schema, max_files=-(-files // 3)), classify, f"{base}/catalog", f"{base}/history", f"{base}/checkpoint")
    done = CM.commits(spark, f"{base}/catalog")
    again = sum(sum(CM.append_classified_once(classify(f), f"{base}/catalog", f"{base}/history", c)) for c in done)
    out = None
    for part in ("catalog", "history"):
        rows = io.read_layer(spark, f"{base}/{part}")
        one = rows.groupBy("source").agg(F.count("*").alias("rows"), F.count_if(~F.col("predicted_mood").isin(list(MOODS))).alias("unlabelled"))
        one = one.select(F.lit(part).alias("part"), "source", "rows", F.lit(len(rows.columns)).alias("columns"), "unlabelled", F.lit(len(done)).alias("commits"), F.lit(again).cast("bigint").alias("again"))
        out = one if out is None else out.unionByName(one)
    return out


@query("stream_dedup_bounded", "SELECT event_type, count(DISTINCT event_id) AS rows, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def stream_dedup_bounded(spark, sf):
    """Every event comes twice, in other files; the state holds the keys of two days, not of all time."""
    base = shared_dir(spark, "dedup-bounded")
    e = load(spark, sf, "events").select("event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    # files in order of time, each event in two of them
    e.unionByName(e).repartitionByRange(8, "ts", F.rand(3)).write.parquet(f"{base}/in")
    stream = X.deduplicated_within(X.file_stream(spark, f"{base}/in", e.schema, max_files=8), ["event_id"], "ts", "2 days")
    X.copy_stream(stream, f"{base}/out", f"{base}/checkpoint")
    return io.read_layer(spark, f"{base}/out").groupBy("event_type").agg(F.count("*").alias("rows"), F.round(F.sum("value"), 4).alias("total"))


@query(
    "rejected_records",
    """SELECT 'event' AS kind, event_type AS label, count(*) AS rows FROM events WHERE event_id % 10 = 3 GROUP BY event_type
    UNION ALL SELECT 'line', event_type, count(*) FROM events WHERE event_id % 7 = 2 GROUP BY event_type
    UNION ALL SELECT 'class', event_type, count(*) FROM events WHERE event_type NOT IN ('click', 'purchase') GROUP BY event_type""",
)
def rejected_records(spark, sf):
    """Events and lines that do not parse and rows of classes that are not listed, kept and counted."""
    base = shared_dir(spark, "rejected")
    e = load(spark, sf, "events").select("event_id", "event_type", "value")
    whole = F.to_json(F.struct(F.col("event_type").alias("dataset"), F.struct("event_id", "event_type", "value").alias("payload")))
    wrapped = e.select(F.when(F.col("event_id") % 10 == 3, F.concat(F.lit("broken "), "event_type")).otherwise(whole).alias("value"))
    events = io.unopened_events(wrapped, e.schema)
    line = F.to_json(F.struct("event_id", "event_type", "value"))
    e.select(F.when(F.col("event_id") % 7 == 2, F.concat(F.lit("broken "), "event_type")).otherwise(line).alias("value")).write.text(f"{base}/bronze")
    lines = io.bad_lines(io.read_bronze(spark, f"{base}/bronze", e.schema))
    name = F.element_at(F.split("raw", " "), -1).alias("label")
    out = L.unlisted_classes(e, "event_type", ["click", "purchase"]).select(F.lit("class").alias("kind"), "label", "rows")
    for kind, raw in (("event", events), ("line", lines)):
        out = out.unionByName(raw.groupBy(name).agg(F.count("*").alias("rows")).select(F.lit(kind).alias("kind"), "label", "rows"))
    return out
