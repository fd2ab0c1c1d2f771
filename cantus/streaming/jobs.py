"""Structured Streaming jobs.  Every query runs with ``availableNow`` and a checkpoint, so it ends
by itself, resumes where it stopped, and its file sinks are exactly-once."""

from __future__ import annotations

import hashlib
import time
from collections import Counter
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse as P
from ..sources import commits as CM


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Files as a stream; ``max_files`` per trigger paces the replay."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    folder, _, name = path.rstrip("/").rpartition("/")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(p).isFile():  # the file source wants a folder
        return reader.option("pathGlobFilter", name).load(folder)
    return reader.load(path)


def kafka_stream(spark: SparkSession, servers: str, topics: list[str], max_offsets: int | None = None) -> DataFrame:
    """Bounded replay from the earliest offsets; needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def kafka_sink(events: DataFrame, servers: str, topic: str) -> None:
    events.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def run(writer, timeout: int | None = None) -> None:
    query = writer.trigger(availableNow=True).start()
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError("stream did not finish in time")


REJECTED = "rejected"


def ingest(events: DataFrame, bronze: str, checkpoint: str, timeout: int | None = None) -> None:
    """Route the payloads of all events to Bronze JSON Lines, partitioned by dataset.

    One stream reads the input once, and one file sink writes it exactly once.  An event without a
    dataset or a payload goes whole to the dataset ``rejected``.
    """
    event = F.col("value").cast("string")
    dataset, payload = F.get_json_object(event, "$.dataset"), F.get_json_object(event, "$.payload")
    good = dataset.isNotNull() & payload.isNotNull()
    routed = events.select(
        F.when(good, payload).otherwise(F.coalesce(event, F.lit(""))).alias("value"), F.when(good, dataset).otherwise(REJECTED).alias("dataset")
    )
    writer = routed.writeStream.format("text").outputMode("append").option("checkpointLocation", checkpoint).option("path", bronze)
    run(writer.partitionBy("dataset"), timeout)


class _Enough(Exception):
    """The rows that were expected are there; the batch that came after them is left for a resume."""


def _query_id(spark: SparkSession) -> str:
    """The stream's own id: kept in its checkpoint, so a resumed job has it again."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def consume(events: DataFrame, bronze: str, checkpoint: str, expected: dict[str, int] | None = None, timeout: float | None = None) -> dict:
    """Route payloads to Bronze as ``ingest`` does, until every dataset has the rows it is expected to.

    Returns ``reason`` (``counts``, ``timeout`` or ``end``: the input is used up) and the ``counts`` of
    this run by dataset, events without a dataset or payload under ``rejected``.  Counts are looked at
    after each batch; the batch after the last one needed is not begun.  The rest comes with the next
    run on the same checkpoint.  A batch writes a folder of its own by overwrite, so none counts twice.
    """
    event = F.col("value").cast("string")
    dataset, payload = F.get_json_object(event, "$.dataset"), F.get_json_object(event, "$.payload")
    good = dataset.isNotNull() & payload.isNotNull()
    routed = events.select(
        F.when(good, payload).otherwise(F.coalesce(event, F.lit(""))).alias("value"), F.when(good, dataset).otherwise(REJECTED).alias("dataset")
    )
    counts: Counter = Counter()
    met = lambda: bool(expected) and all(counts[d] >= n for d, n in expected.items())

    def sink(batch: DataFrame, batch_id: int) -> None:
        if met():
            raise _Enough
        kept = batch.persist()
        try:
            folder = f"{bronze}/run={_query_id(batch.sparkSession)}/batch={batch_id}"
            kept.write.mode("overwrite").partitionBy("dataset").text(folder)
            counts.update({r["dataset"]: r["count"] for r in kept.groupBy("dataset").count().collect()})  # one row per dataset
        finally:
            kept.unpersist()

    query = routed.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    reason, until = "end", None if timeout is None else time.monotonic() + timeout
    try:
        while not query.awaitTermination(1):
            if until is not None and time.monotonic() >= until:
                query.stop()
                reason = "timeout"
                break
    except Exception:
        if not met():
            raise
        reason = "counts"
    return {"reason": "counts" if met() else reason, "counts": dict(counts)}


def classify_and_append(stream: DataFrame, classify: Callable[[DataFrame], DataFrame], catalog: str, history: str, checkpoint: str,
                        timeout: int | None = None) -> None:
    """Classify each micro-batch; rows go to the catalog, by its columns, and whole to the history.

    Every batch is one commit in the log of either table, named by the stream's id and the batch: one
    that is tried again, after whatever failure, adds nothing twice.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        CM.append_classified_once(classify(batch), catalog, history, f"{_query_id(batch.sparkSession)}-{batch_id:08d}")

    run(stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint), timeout)


def deduplicated_within(stream: DataFrame, key: list[str], event_time: str, delay: str) -> DataFrame:
    """First occurrence per key among rows at most ``delay`` apart in event time.

    Keys leave the state once the watermark has passed them by ``delay``, so it holds the keys of a
    span of time, not of the whole stream.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(key)


def copy_stream(stream: DataFrame, path: str, checkpoint: str, timeout: int | None = None, partition_by: list[str] = ()) -> None:
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
    run(writer.partitionBy(*partition_by) if partition_by else writer, timeout)


def deduplicated(stream: DataFrame, key: list[str]) -> DataFrame:
    """First occurrence per key; the state holds every key of the bounded replay."""
    return stream.dropDuplicates(key)


def classify_online(stream: DataFrame, classify: Callable[[DataFrame], DataFrame], catalog: str, history: str, checkpoint: str,
                    timeout: int | None = None) -> None:
    """Classify each micro-batch and append it to the catalog delta and to the history.

    A batch writes into its own ``run=<id>/batch=<id>`` folder by overwrite, so a batch that is run
    again after a lost executor or driver replaces its first attempt instead of adding to it.  The
    run id belongs to the checkpoint: a resumed job goes on, a new one leaves earlier history alone.
    """
    job = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def sink(batch: DataFrame, batch_id: int) -> None:
        out = classify(batch).persist()
        try:
            for target in (catalog, history):
                out.write.mode("overwrite").parquet(f"{target}/run={job}/batch={batch_id}")
        finally:
            out.unpersist()

    run(stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint), timeout)


OBJECT_EVENT = (
    "Records ARRAY<STRUCT<eventSource: STRING, eventName: STRING, "
    "s3: STRUCT<bucket: STRUCT<name: STRING>, object: STRUCT<key: STRING>>>>"
)


def audit_records(events: DataFrame, value: str = "value", prefix: str = "", suffix: str = "", source: str = "aws:s3") -> DataFrame:
    """Object-created events as audit records; works on a batch or a stream."""
    e = events.select(F.from_json(F.col(value).cast("string"), OBJECT_EVENT).alias("e")).select(F.explode("e.Records").alias("r"))
    bucket, key = F.col("r.s3.bucket.name"), F.col("r.s3.object.key")
    e = e.filter((F.col("r.eventSource") == source) & (bucket != "") & (key != ""))
    k = P.object_key(key)
    out = e.select(
        F.lit("s3_object_created").alias("event_type"), k["layer"].alias("layer"), k["dataset"].alias("dataset"),
        F.concat(F.lit("s3://"), bucket, F.lit("/"), k["key"]).alias("location"), F.col("r.eventName").alias("source"), k["key"].alias("_key"),
    )
    return out.filter(F.col("_key").startswith(prefix) & F.col("_key").endswith(suffix)).drop("_key")


def layer_event(spark: SparkSession, layer: str, dataset: str, location: str) -> DataFrame:
    """The audit row a layer write emits."""
    row = spark.createDataFrame([("layer_written", layer, dataset, location)], "event_type string, layer string, dataset string, location string")
    return row.withColumn("created_at", F.current_timestamp())
