"""What grew with the tables: files of a stream, lines of Bronze, passes for cuts and medians, methods left uncompiled."""

import math
from pathlib import Path

from pyspark.sql import functions as F

from cantus.functions import numeric as N
from cantus.operators import columns as C
from cantus.operators import modeling as L
from cantus.operators import ranking as K
from cantus.plans import q_commits as QC
from cantus.plans.registry import QUERIES
from cantus.session import METHOD_LIMIT
from cantus.sources import io


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_stream_is_dealt_by_its_rows_in_three_commits(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(QC, "ROWS_PER_FILE", 500)
    monkeypatch.setattr(QC, "shared_dir", lambda spark, purpose: f"{tmp_path}/{purpose}")
    told = QC.stream_append_once(spark, sf).collect()
    rows = spark.read.parquet(f"{tmp_path}/append-once/in").groupBy(F.input_file_name()).count().toPandas()["count"]
    assert len(rows) == math.ceil(rows.sum() / 500) and rows.max() <= 550
    assert {r.commits for r in told} == {3} and {r.again for r in told} == {0}
    assert {r.rows for r in told if r.source == "realtime_prediction"} == {rows.sum()}


def test_medians_are_fitted_once_per_fold(spark, monkeypatch):
    fits, fit = [], L.Imputer._fit
    monkeypatch.setattr(L.Imputer, "_fit", lambda self, df: fits.append(1) or fit(self, df))
    rows = [(i, i % 3, float(i % 7) if i % 5 else None, float(i % 2 + i % 3), f"text {i}") for i in range(90)]
    df = spark.createDataFrame(rows, "id int, y int, a double, b double, other string")
    options = {"C": [0.1, 1.0], "fit_intercept": [True, False]}
    _, found = L.search_classifiers(df, ["a", "b"], "y", [0, 1, 2], ["id"], {"logistic_regression": options}, k=3)["logistic_regression"]
    assert len(fits) == 3 + 1  # three folds and the best point on all rows
    # the same as whole pipelines, one after the other
    folds, score = K.fold_column(df, ["id"], 3, "y", [0, 1, 2]), L.MacroF1(labelCol="y", labels=[0, 1, 2])
    whole = []
    for p in L.param_sets(options):
        make = lambda: L.classifier_pipeline("logistic_regression", ["a", "b"], "y", total_weight=60.0, **p)  # noqa: B023, E731
        side = lambda i: L.balanced_weights(folds.filter(F.col("fold") != i), "y", [0, 1, 2])
        whole.append(sum(score.evaluate(make().fit(side(i)).transform(folds.filter(F.col("fold") == i))) for i in range(3)) / 3)
    assert [round(m, 9) for _, m in found] == [round(m, 9) for m in whole]


def test_stages_that_differ_are_not_shared(spark):
    df = spark.createDataFrame([(i, float(i), float(i % 2)) for i in range(20)], "id int, a double, b double")
    make = lambda names: L.Pipeline(stages=[L.VectorAssembler(inputCols=names, outputCol="features"), L.LogisticRegression(labelCol="b")])
    pipelines = [make(["a"]), make(["a", "b"])]
    assert L._prepared(pipelines, df, df)[0] is pipelines
    assert len(L._prepared([make(["a"]), make(["a"])], df, df)[1].columns) == 4


def test_cuts_are_worked_out_once(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(300)] + [(300, None), (301, 9)], "id int, y int")
    split = K.stratified_split(df, "y", [0, 1, 2, 5], ["id"])
    folds = K.fold_column(df, ["id"], 3, "y", [0, 1, 2])
    for out in (split, folds, K.fold_column(df, ["id"], 3)):
        assert "Aggregate" not in plan(out) and "scalar-subquery" not in plan(out)
    assert {(r.y, r["count"]) for r in split.filter("is_train").groupBy("y").count().collect()} == {(y, 80) for y in range(3)}
    assert split.filter("is_train IS NULL").count() == 2
    assert {r["count"] for r in folds.filter("y < 3").groupBy("y", "fold").count().collect()} <= {33, 34}
    # copies of a key stay on one side, and the cut is reached
    copies = spark.range(50).withColumn("k", F.col("id") % 5)
    assert sorted(r["count"] for r in K.fold_column(copies, ["k"], 2).groupBy("fold").count().collect()) == [20, 30]


def test_bronze_lines_are_compressed_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(io, "LINES_PER_FILE", 100)
    df = spark.range(1000).coalesce(1).select("id", F.concat(F.lit("Song é "), "id").alias("name"))
    io.append_json_lines(df, f"{tmp_path}/bronze")
    files = [p.name for p in Path(f"{tmp_path}/bronze").glob("part-*")]
    assert len(files) == 10 and all(f.endswith(".json.gz") for f in files)
    back = io.good_lines(io.read_bronze(spark, f"{tmp_path}/bronze", df.schema))
    assert sorted(back.collect()) == sorted(df.collect())


def test_doubles_are_not_written_out_as_text(spark):
    values = [0.1 + 0.2, -0.0, 1e300, float("inf"), float("nan"), None]
    df = spark.createDataFrame([(v, None if v is None else str(v)) for v in values], "d double, t string")
    for out in (C.cast_safely(df, {"d": "double", "t": "double"}), C.ensure_numeric(df, ["d", "t"], 7.0)):
        assert "cast(d" not in plan(out)
        assert [r.d for r in out.collect()] == [r.t for r in out.collect()]
    assert [r.d for r in C.cast_safely(df, {"d": "double"}).collect()] == [*values[:4], None, None]


def test_a_text_is_read_as_a_number_once(spark):
    df = spark.createDataFrame([("1.5",), ("NaN",), ("bad",), (None,), ("Infinity",)], "t string")
    out = df.select(N.safe_double(F.col("t")).alias("d"))
    assert plan(out).count("try_cast(") == 1
    assert [r.d for r in out.collect()] == [1.5, None, None, None, float("inf")]


def test_queries_settle_a_session_made_elsewhere(spark, sf):
    name, limit = METHOD_LIMIT
    other = spark.newSession()
    other.conf.unset(name)
    QUERIES["silver_tracks"](other, sf)
    assert other.conf.get(name) == limit
    other.conf.set(name, "4000")
    QUERIES["gold_tracks"](other, sf)
    assert other.conf.get(name) == "4000"  # the caller's own stays
