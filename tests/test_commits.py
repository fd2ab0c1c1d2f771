"""Commits that are tried again, streams that stop on counts, dedup whose state levels off."""

import json

import pytest
from pyspark.sql import functions as F

from cantus.sources import commits as CM
from cantus.streaming import jobs


def ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def test_a_commit_that_is_done_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert CM.append_once(spark.range(10).repartition(3), path, "c1") == 3
    assert CM.append_once(spark.range(10), path, "c1") == 0
    CM.append_once(spark.range(10, 12), path, "c2")
    assert ids(spark, path) == list(range(12)) and CM.commits(spark, path) == ["c1", "c2"]


@pytest.mark.parametrize("moved", [0, 1, 3])
def test_a_commit_goes_on_where_it_ended(spark, tmp_path, moved):
    """The try ended after the manifest and ``moved`` of three files; the retry brings other rows and must not use them."""
    path = str(tmp_path / "t")
    table = CM.Folder(spark, path)
    spark.range(9).repartition(3).write.parquet(f"{path}/_staged/c")
    names = table.files("_staged/c")
    table.write("_commits/c.files", json.dumps(names))
    for name in names[:moved]:
        table.move(f"_staged/c/{name}", f"c-{name}")
    assert CM.append_once(spark.range(100), path, "c") == 3 - moved
    assert ids(spark, path) == list(range(9))


def test_a_try_without_a_manifest_is_staged_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(f"{path}/_staged/c")
    CM.append_once(spark.range(7), path, "c")
    assert ids(spark, path) == list(range(7)) and not CM.Folder(spark, path).has("_staged/c")


def test_catalog_columns_are_kept_and_a_lost_history_is_made_good(spark, tmp_path):
    catalog, history = str(tmp_path / "c"), str(tmp_path / "h")
    spark.createDataFrame([(1, "x", "u")], "id long, name string, cover string").write.parquet(catalog)
    rows = spark.createDataFrame([("y", 2, 0.5)], "name string, id int, score double")
    CM.append_once(CM.C.align_to(rows, spark.read.parquet(catalog).schema), catalog, "c")  # ended before the history
    again = CM.append_classified_once(rows, catalog, history, "c")
    assert again[0] == 0 and again[1] > 0
    assert sorted(map(tuple, spark.read.parquet(catalog).collect())) == [(1, "x", "u"), (2, "y", None)]
    assert spark.read.parquet(history).columns == rows.columns


def test_a_stream_whose_batch_fails_in_the_middle(spark, tmp_path):
    base = str(tmp_path)
    spark.range(20).repartition(4).write.parquet(f"{base}/in")
    stream = lambda: jobs.file_stream(spark, f"{base}/in", spark.range(1).schema, max_files=2)
    failed = []

    def classify(batch):
        if not failed:
            failed.append(1)
            return batch.withColumn("bad", F.raise_error(F.lit("lost")))
        return batch

    run = lambda: jobs.classify_and_append(stream(), classify, f"{base}/c", f"{base}/h", f"{base}/check")
    with pytest.raises(Exception):
        run()
    run()
    assert ids(spark, f"{base}/c") == ids(spark, f"{base}/h") == list(range(20))


def events(spark, base, files=8):
    rows = spark.range(80).select(F.to_json(F.struct(F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("dataset"), F.struct("id").alias("payload"))).alias("value"))
    rows.repartition(files).write.parquet(f"{base}/in")
    return lambda: jobs.file_stream(spark, f"{base}/in", rows.schema, max_files=1)


def test_consume_stops_on_counts_and_resumes(spark, tmp_path):
    base = str(tmp_path)
    stream = events(spark, base)
    first = jobs.consume(stream(), f"{base}/b", f"{base}/check", {"a": 3, "b": 9})
    assert first["reason"] == "counts" and first["counts"]["a"] >= 3 and first["counts"]["b"] >= 9
    assert sum(first["counts"].values()) < 80
    written = lambda: spark.read.text(f"{base}/b").count()
    assert written() == sum(first["counts"].values())
    last = jobs.consume(stream(), f"{base}/b", f"{base}/check", {"a": 1_000})
    assert last["reason"] == "end" and written() == 80
    assert first["counts"]["a"] + last["counts"]["a"] == 20


def test_consume_stops_at_its_timeout(spark, tmp_path):
    base = str(tmp_path)
    got = jobs.consume(events(spark, base)(), f"{base}/b", f"{base}/check", {"a": 1_000}, timeout=0.5)
    assert got["reason"] in ("timeout", "end")
    assert jobs.consume(jobs.file_stream(spark, f"{base}/in", spark.read.parquet(f"{base}/in").schema), f"{base}/b", f"{base}/check")["reason"] == "end"
    assert spark.read.text(f"{base}/b").count() == 80


def test_dedup_state_levels_off(spark, tmp_path):
    base = str(tmp_path)
    for day in range(8):
        rows = spark.range(day * 50, day * 50 + 50).select("id", F.timestamp_seconds(F.lit(86_400 * (day + 1)) + F.col("id")).alias("ts"))
        rows.unionByName(rows).coalesce(1).write.mode("append").parquet(f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema
    stream = jobs.deduplicated_within(jobs.file_stream(spark, f"{base}/in", schema, max_files=1), ["id"], "ts", "1 day")
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/check").option("path", f"{base}/out").trigger(availableNow=True).start()
    query.awaitTermination()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(states) <= 200 < 400
    assert ids(spark, f"{base}/out") == list(range(400))
