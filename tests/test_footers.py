"""Footers read inside tasks against the tables they describe."""

from pyspark.sql import functions as F

from cantus.sources import footers as FT


def test_sums_equal_the_table(spark, tmp_path):
    rows = [(i, None if i % 3 == 0 else float(i), "x" * (i % 50), {"a": i}) for i in range(30_000)]
    df = spark.createDataFrame(rows, "id bigint, gap double, name string, m map<string, int>")
    path = str(tmp_path / "a b%20c")  # signs that a URI would escape
    df.repartition(3, "id").write.partitionBy().option("parquet.block.size", 32 * 1024).parquet(path)
    chunks = FT.column_chunks(spark, path).cache()
    totals = {r["leaf"]: r for r in FT.column_totals(chunks).collect()}
    assert totals["gap"]["null_count"] == 10_000 and totals["id"]["null_count"] == 0
    assert {r["row_count"] for r in totals.values()} == {30_000}
    assert {r["column_name"] for r in totals.values()} == {"id", "gap", "name", "m"} and len(totals) == 5  # a map has two leaves
    groups = FT.row_groups(chunks).collect()
    assert len(groups) > 3 and sum(g["row_count"] for g in groups) == 30_000 and {g["leaves"] for g in groups} == {5}
    files = FT.file_groups(chunks).collect()
    assert len(files) == 3 and sum(f["row_groups"] for f in files) == len(groups) and sum(f["row_count"] for f in files) == 30_000
    assert max(f["largest_group"] for f in files) == max(g["row_count"] for g in groups)


def test_broken_and_empty_files_are_kept(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(10).coalesce(1).write.parquet(str(path))
    (path / "broken.parquet").write_bytes(b"no such thing")
    (path / "nothing.parquet").write_bytes(b"")  # zero bytes: left out
    spark.range(0).coalesce(1).write.parquet(str(tmp_path / "t" / "part=1"))
    files = FT.file_groups(FT.column_chunks(spark, str(path))).withColumn("name", F.element_at(F.split("file_path", "/"), -1)).collect()
    broken = [f for f in files if f["error"]]
    assert {f["name"] for f in broken} == {"broken.parquet"} and all(f["row_count"] is None and f["row_groups"] == 0 for f in broken)
    assert sorted(f["row_count"] for f in files if not f["error"]) == [0, 10]


def test_no_files(spark, tmp_path):
    (tmp_path / "none").mkdir()
    chunks = FT.column_chunks(spark, str(tmp_path / "none"))
    assert chunks.count() == 0 and FT.row_groups(chunks).count() == 0 and FT.column_totals(chunks).count() == 0
