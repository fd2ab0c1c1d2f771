"""Steps whose cost must not grow faster than their input: how often something is worked out, and how work is dealt."""

import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cantus.functions import text as X
from cantus.operators import activity as A
from cantus.operators import modeling as L
from cantus.operators import neighbours as NB
from cantus.operators import phrases as PH
from cantus.operators import recommend as R


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_are_split_once_per_text(spark):
    df = spark.createDataFrame([(1, "Uno dos, tres a"), (2, "solo"), (3, ""), (4, None)], "k int, t string")
    out = df.select("k", PH.word_grams(F.col("t")).alias("g"))
    assert plan(out).count("split(") == 1
    got = {r.k: r.g for r in out.collect()}
    assert got == {1: ["uno", "dos", "tres", "uno dos", "dos tres"], 2: ["solo"], 3: [], 4: None}


def test_a_phrase_is_folded_once_for_all_templates(spark):
    df = spark.createDataFrame([(1, "  Corrér  "), (1, None), (2, "")], "k int, p string")
    out = A.expand_phrases(df, "p", templates=("{}", "{} x", "{}", "a {}"))
    generator = next(line for line in plan(out).splitlines() if "Generate" in line)
    assert "translate(" not in generator and out.columns == ["k", "p", "text"]
    assert sorted((r.k, r.text) for r in out.collect() if r.text is not None) == [(1, "a correr"), (1, "correr"), (1, "correr x"), (2, ""), (2, " x"), (2, "a ")]
    assert [r.p for r in out.collect() if r.text is None] == [None]


def test_a_growing_vocabulary_is_not_broadcast(spark):
    df = spark.createDataFrame([(1, "uno dos"), (2, "dos")], "k int, t string")
    assert "Broadcast" not in PH.tf_idf(df, "k", "t")._jdf.queryExecution().executedPlan().toString()


def test_counted_terms_stay_with_their_texts(spark, monkeypatch):
    texts = [(i, f"uno dos tres {i % 7} {'cuatro' * (i % 3)}") for i in range(40)] + [(1, "uno uno"), (None, "dos"), (41, None)]
    df = spark.createDataFrame(texts, "k int, t string")
    whole = sorted(map(str, PH.tf_idf(df, "k", "t").selectExpr("k", "kind", "term", "round(weight, 9)").collect()))
    monkeypatch.setattr(PH, "GROUP_CHARS", 30)
    out = PH.tf_idf(df, "k", "t")
    told = out._jdf.queryExecution().executedPlan().toString()
    exchanges = [line.split("hashpartitioning(")[1].split(", ")[:-1] for line in told.splitlines() if "Exchange hashpartitioning" in line]
    # texts by their group, a group's distinct terms over all groups and back; no exchange of a row per text and term
    assert len(exchanges) == 4 and not any(c.startswith("k#") for e in exchanges for c in e)
    assert whole == sorted(map(str, out.selectExpr("k", "kind", "term", "round(weight, 9)").collect())) and any("k=None" in r for r in whole)


def test_texts_are_dealt_by_their_characters(spark, monkeypatch):
    monkeypatch.setattr(PH, "PART_CHARS", 50)
    df = spark.createDataFrame([(i, "quiero correr por el parque") for i in range(60)], "k int, t string")
    near = PH.nearest_phrases(df, "k", "t", PH.phrase_rows(spark))
    told = near._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [k#" in told and ", 33" in told  # 60 texts of 27 characters
    assert near.count() == 180
    # no window sorts postings
    assert not any("postings" in line for line in told.splitlines() if line.strip(" +-:").startswith("Window"))


def peak_mb(work) -> float:
    tracemalloc.start()
    work()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak


def test_folding_holds_no_batch_twice_over(spark):
    fold = X.fold_name_udf().func
    texts = pd.Series([f"Canción {i} " * 5_000 for i in range(100)])  # 6 MB, and as much folded
    assert peak_mb(lambda: fold(texts)) < 9
    assert fold(pd.Series([" Beyoncé ﬁ", None, ""])).tolist() == ["beyoncefi", None, ""]


def test_pivot_distances_are_worked_out_in_slices(spark):
    rng = np.random.default_rng(2)
    vectors, centres = rng.normal(size=(3_000, 64)), rng.normal(size=(32, 64))
    compute, column = NB._pivot_distances(centres.tolist()).func, pd.Series(list(vectors))
    assert peak_mb(lambda: compute(column)) < 20  # all gaps at once are 49 MB
    assert np.allclose(np.stack(compute(column)), np.sqrt(((vectors[:, None] - centres) ** 2).sum(axis=2)))


def test_the_product_with_the_grid_is_dealt_by_its_rows(spark, monkeypatch):
    monkeypatch.setattr(R, "GRID_ROWS", 1_000)
    names = [*[c for c in R.RECOMMENDER_FEATURES], *[f"proba_{m}" for m in R.MOODS], "mood_confidence"]
    tracks = spark.range(500).coalesce(1).select(F.concat(F.lit("T"), "id").alias("track_id"), *[(F.col("id") % 7 / 7).alias(c) for c in names])
    out = R.weak_supervision(tracks, ["track_id"])
    per_part = out.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert per_part.sum() == 500 * 56 and per_part.max() < 3_000


def test_a_fit_keeps_no_second_copy_of_kept_rows(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("target_score"), (F.col("id") % 3).alias("fold"))
    kept = df.persist()
    try:
        L.fit(L.regressor_pipeline("random_forest", ["a"], n_trees=2, max_depth=2), kept)
        assert kept.storageLevel.useMemory  # the rows of the caller stay
    finally:
        kept.unpersist()
