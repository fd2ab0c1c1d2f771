"""The pipeline's stages, each against what its predecessor kept."""

import corpus_pipeline
import pytest
from cantus.llm import quality
from cantus.llm.common import written
from test_corpus import brute_print, closure


@pytest.fixture(scope="module")
def steps(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf), name.replace(" ", "-")))
    return out


def test_stages_keep_the_columns(steps):
    for step in steps[1:-1]:
        assert step.columns == steps[0].columns


def test_quality_filter(spark, sf, steps):
    scores = quality.quality_scores(steps[0], spark.read.parquet(f"{sf}/labels.parquet"))
    want = {r.doc_id for r in scores.where("predicted = 1").collect()}
    assert {r.doc_id for r in steps[1].collect()} == want


def test_near_copies_leave_one_per_group(steps):
    prints = {r.doc_id: brute_print((r.text or "").encode()) for r in steps[2].collect()}
    root = closure(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    assert {r.doc_id for r in steps[3].collect()} == set(root.values())


def test_no_window_repeats_from_an_earlier_document(steps):
    before = {r.doc_id: (r.text or "").split() for r in steps[3].collect()}
    after = {r.doc_id: (r.text or "").split() for r in steps[4].collect()}
    seen = set()
    for doc in sorted(before):
        words, gone = before[doc], set()
        for k in range(len(words) - 19):
            key = tuple(words[k : k + 20])
            if key in seen:
                gone.update(range(k, k + 20))
            seen.add(key)
        assert after[doc] == [w for k, w in enumerate(words) if k not in gone]


def test_every_document_is_packed(steps):
    rows = steps[5].collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in steps[4].collect()}
    assert max(r.offset + r.length for r in rows) <= 2048


OWN = ["n_words", "n_lines", "n_removed", "n_removed_lines", "batch_id", "component_id", "score"]
TWO_LINES = "first shared line of some words\nsecond shared line of some words"
PASSAGE = " ".join(f"word{i}" for i in range(60))


@pytest.fixture(scope="module")
def odd(spark):
    texts = [None, "", TWO_LINES + "\nown", "mine\n" + TWO_LINES, PASSAGE + " a", "b c " + PASSAGE, "long " * 40_000, PASSAGE + " a", None]
    rows = [(i, t, *["mine"] * len(OWN)) for i, t in enumerate(texts)] + [(3, texts[3], *["again"] * len(OWN))]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in OWN))


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_stages_leave_own_columns_alone(spark, sf, odd, stage):
    got = stage(spark, odd, sf)
    assert got.columns == odd.columns
    rows = got.collect()
    assert rows and all(r[c] in ("mine", "again") for r in rows for c in OWN)
    assert stage(spark, odd.where("false"), sf).count() == 0


def test_line_stage_cuts_repeated_runs(spark, sf, odd):
    got = {(r.doc_id, r.n_words): r.text for r in corpus_pipeline.drop_repeated_lines(spark, odd, sf).collect()}
    assert got[0, "mine"] is None and got[1, "mine"] == "" and got[2, "mine"] == TWO_LINES + "\nown"
    assert sorted([got[3, "mine"], got[3, "again"]]) in (["", "mine"], ["mine", "mine"])


def test_line_stage_against_all_pairs_of_lines(steps):
    """A line goes if it and a neighbour, not both blank, occur earlier as a pair."""
    before = {r.doc_id: (r.text or "").split("\n") for r in steps[1].collect()}
    after = {r.doc_id: (r.text or "").split("\n") for r in steps[2].collect()}
    first = {}
    for d in sorted(before):
        for i, pair in enumerate(zip(before[d], before[d][1:])):
            first.setdefault(pair, (d, i))
    checked = 0
    for d, lines in before.items():
        gone = set()
        for i, pair in enumerate(zip(lines, lines[1:])):
            at = first[pair]
            if (pair[0].strip() or pair[1].strip()) and (at[0] < d or at[1] + 1 < i):
                gone |= {i, i + 1}
        if all(x.strip() for x in lines):  # blank lines between removed ones go too
            assert after[d] == [x for i, x in enumerate(lines) if i not in gone] or (len(gone) == len(lines) and after[d] == [""])
            checked += 1
    assert checked > 50


def test_odd_rows_are_packed(spark, sf, odd):
    rows = corpus_pipeline.pack_sequences(spark, odd, sf).collect()
    assert {r.doc_id for r in rows} == set(range(9)) and max(r.offset + r.length for r in rows) <= 2048
