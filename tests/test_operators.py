"""Small fixtures with known answers, hot keys included."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cantus import fixed_values as V
from cantus.functions import numeric as N
from cantus.functions import parse as P
from cantus.functions import rules as R
from cantus.functions import text as X
from cantus.operators import activity as A
from cantus.operators import columns as C
from cantus.operators import evaluate as E
from cantus.operators import filters as Q
from cantus.operators import joins as J
from cantus.operators import layers as L
from cantus.operators import metadata as D
from cantus.operators import neighbours as NB
from cantus.operators import payloads as PL
from cantus.operators import phrases as PH
from cantus.operators import prepare as PR
from cantus.operators import quantiles as QT
from cantus.operators import ranking as K
from cantus.schemas import DATASETS
from cantus.session import shared_dir
from cantus.sources import io


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


CASES = [
    ("feliz", "cantar en la ducha", "happy", "baile_fiesta"),
    ("energico", "ordenar el armario", "energetic", "limpieza_domestica"),
    ("tranquilo", "un rato para desayunar", "calm", "alimentacion"),
    ("triste", "llorando en el sofa", "sad", "desahogo_emocional"),
    ("energico", "trabajando en casa", "energetic", "estudio_trabajo"),
    ("feliz", "salgo a correr un poco", "happy", "correr"),
    ("tranquilo", "mi entreno del lunes", "calm", "entrenamiento_intenso"),
    ("triste", "no lo tengo claro", "sad", "actividad_general"),
]


def test_interpreter_cases(spark):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(CASES)], "i int, mood string, text string, want_mood string, want string")
    out = A.interpret(df.withColumn("got_mood", P.mood_alias(F.col("mood"))), "text")
    for r in out.collect():
        assert (r["got_mood"], r["activity_name"]) == (r["want_mood"], r["want"])


def test_profile_adds_all_matching_deltas(spark):
    out = A.interpret(spark.createDataFrame([("quiero pasear y dormir mucho",)], "text string"), "text").first()
    # "pase", "pasear" and "dorm" all count; energy and calm hit their bounds
    assert out["activity_name"] == "dormir"
    assert out["activity_movement"] == pytest.approx(0.45 + 0.20 + 0.20 - 0.55)
    assert out["activity_energy"] == pytest.approx(0.0)
    assert out["activity_calm"] == pytest.approx(1.0)


def test_training_weights_by_hand():
    w = R.training_weights("sad", {"activity_energy": 0.95, "activity_calm": 0.1, "activity_positivity": 0.65})
    raw = {"sad": 0.05 + 0.35 + 0.10, "happy": 0.45, "energetic": 0.60, "calm": 0.10}
    assert w == pytest.approx({m: v / sum(raw.values()) for m, v in raw.items()})


def test_serving_weights_by_hand(spark):
    def weights(mood, e, c, p):
        cols = R.serving_weights(F.lit(mood), F.lit(e), F.lit(c), F.lit(p))
        row = spark.range(1).select(*[v.alias(m) for m, v in cols.items()]).first().asDict()
        return row

    release = {"sad": 0.82 + 0.45, "calm": 0.04 + 0.25, "happy": 0.04 * 0.2, "energetic": 0.04 * 0.15}
    assert weights("sad", 0.05, 0.95, 0.05) == pytest.approx({m: v / sum(release.values()) for m, v in release.items()})
    calm = {"sad": 0.04, "happy": 0.04, "energetic": 0.12, "calm": 0.82 + 0.45}
    assert weights("calm", 0.9, 0.9, 0.9) == pytest.approx({m: v / sum(calm.values()) for m, v in calm.items()})
    happy = {"sad": 0.04, "happy": 1.02, "energetic": 0.26, "calm": 0.04}
    assert weights("happy", 0.9, 0.1, 0.95) == pytest.approx({m: v / sum(happy.values()) for m, v in happy.items()})


# --- dedup, splits, totals ------------------------------------------------------------------------------


def test_keep_one_with_hot_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    out = K.keep_one(df, ["k"], [F.col("v").desc()])
    assert out.count() == 20_001
    assert out.filter("k = -1").first()["v"] == 29_997
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 4, 5, 1003])
def test_split_is_exact(spark, n):
    df = spark.range(n).select("id", (F.col("id") % 2).cast("int").alias("y"))
    out = K.stratified_split(df, "y", [0, 1], ["id"])
    got = {r["y"]: r["t"] for r in out.groupBy("y").agg(F.sum(F.col("is_train").cast("int")).alias("t")).collect()}
    sizes = {0: (n + 1) // 2, 1: n // 2}
    assert got == {y: math.floor(0.8 * s) for y, s in sizes.items() if s}


def test_folds_are_even_and_copies_stay_together(spark):
    df = spark.range(900).select("id").withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("id") == 7, 500).otherwise(1))))
    out = K.fold_column(df, ["id"], 3)
    assert out.groupBy("id").agg(F.countDistinct("fold").alias("n")).filter("n > 1").count() == 0
    even = K.fold_column(spark.range(900), ["id"], 3).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in even) == [300, 300, 300]


def test_sample_rows_is_exact_and_stable(spark):
    a = {r["id"] for r in K.sample_rows(spark.range(5000), ["id"], 123).collect()}
    b = {r["id"] for r in K.sample_rows(spark.range(5000).repartition(5), ["id"], 123).collect()}
    assert len(a) == 123 and a == b
    assert K.sample_rows(spark.range(10), ["id"], 50).count() == 10


def test_top_k_merged_equals_one_step(spark):
    """Ties, a key with a third of all rows, keys with fewer than k rows, more tasks than buckets."""
    df = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 700).alias("g"), (F.col("id") * 7919 % 13).alias("x")).repartition(20)
    order = [F.col("x").desc(), F.col("id").asc()]
    rows = lambda out: sorted(tuple(r) for r in out.select("g", "id", "rank").collect())
    assert rows(K.top_k_merged(df, ["g"], 9, order, buckets=3)) == rows(K.top_k_per(df, ["g"], 9, order))
    assert K.top_k_merged(df, ["g"], 9, order).columns == ["id", "g", "x", "rank"]


def test_request_statistics(spark):
    """Counted values give what counting every (track, request) pair gives; null artists and genres pass only open filters."""
    from cantus.operators import recommend

    rng = random.Random(4)
    tracks = [(rng.choice(["Ana; Bo", "BO", "Cy/Ana", None, "x"]), rng.choice(["Rock", "pop", None]), rng.choice(["sad", "happy"]), rng.uniform(-1, 1)) for _ in range(800)]
    catalog = spark.createDataFrame(tracks, "artists string, track_genre string, predicted_mood string, speechiness double")
    asked = [(1, "sad", [], ""), (2, "happy", ["ana"], ""), (3, "sad", ["bo", "x"], "pop"), (4, "happy", [], "rock"), (5, "sad", ["nobody"], "")]
    requests = spark.createDataFrame(asked, "request_id bigint, mood string, artist_queries array<string>, genre string")
    want = {}
    for i, mood, names, genre in asked:
        left = [t for t in tracks if (not names or (t[0] and any(n in t[0].lower() for n in names))) and (not genre or (t[1] or "").lower() == genre)]
        if left:
            want[i] = (max(abs(t[3]) for t in left), sum(t[2] == mood for t in left))
    got = {r["request_id"]: (r["max_speech"], r["exact_matches"]) for r in recommend.request_statistics(catalog, requests).collect()}
    assert got == want and 5 not in got
    bare = recommend.request_statistics(catalog.drop("artists", "track_genre"), requests.filter("request_id = 1")).collect()
    assert [(r["max_speech"], r["exact_matches"]) for r in bare] == [want[1]]


def test_running_total_with_hot_value(spark):
    rng = random.Random(3)
    values = [1.0] * 4000 + [rng.gauss(0, 1) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").groupBy("x").agg(F.count("*").alias("n"))
    got = {r["x"]: r["running"] for r in K.running_total(df, [], "x", F.col("n"), parts=16).collect()}
    for x in random.Random(1).sample(sorted(got), 200) + [1.0]:
        assert got[x] == sum(v <= x for v in values)


def test_running_total_of_uneven_groups(spark):
    """Groups of one row to a third of all rows, null groups and orders, doubles, both directions, clashing names."""
    rng = random.Random(9)
    rows = [(g, float(x), rng.randint(1, 9), "own") for g, n in (("a", 3000), ("b", 1), (None, 40), ("c", 900), ("d", 2000)) for x in rng.sample(range(100_000), n)]
    rows += [("a", None, 5, "own"), ("e", None, 7, "own")]
    df = spark.createDataFrame(rows, "g string, x double, v int, _offset string").repartition(6)
    key = lambda r: (r[1] is not None, r[1] or 0.0)
    for down in (False, True):
        got = {(r["g"], r["x"]): r["running"] for r in K.running_total(df, ["g"], "x", F.col("v"), parts=24, descending=down).collect()}
        want, total = {}, {}
        for r in sorted(rows, key=key, reverse=down):
            total[r[0]] = total.get(r[0], 0) + r[2]
            want[r[0], r[1]] = total[r[0]]
        assert got == want
    out = K.running_total(df, ["g"], "x", F.col("v"))
    assert out.columns == ["g", "x", "v", "_offset", "running"] and {r[0] for r in out.select("_offset").distinct().collect()} == {"own"}
    assert K.running_total(df.limit(0), ["g"], "x", F.col("v")).count() == 0


def test_ranges_are_even(spark):
    """Log-normal values in one hot and many small groups: no range holds twice its share."""
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"), F.exp(F.randn(3) * 4).alias("x"))
    sizes = [r["count"] for r in K.range_parts(df, ["g", "x"], 40).groupBy("_range").count().collect()]
    assert len(sizes) >= 38 and sum(sizes) == 60_000 and max(sizes) < 2 * 60_000 / 40


def test_positions(spark):
    df = spark.createDataFrame([(i * i,) for i in range(500)], "id bigint").repartition(7)
    assert [r["sample_index"] for r in K.positions(df, "id").orderBy("id").collect()] == list(range(500))


def test_exact_quantiles_of_a_frequent_value(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([np.full(20_000, 3.0), rng.lognormal(0, 2, 40_000)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(8)
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    got = {r["prob"]: r["q"] for r in QT.exact(df, ["x"], probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(x, p), rel=1e-12)


def test_exact_quantiles_of_odd_values(spark):
    """Neighbours of powers of two, subnormal, huge, signed, infinite and repeated values, nulls; several columns."""
    near = [np.nextafter(2.0 ** k, d) for k in range(-60, 61) for d in (0.0, np.inf)] + [2.0 ** k for k in range(-60, 61)]
    a = np.array([s * v for v in near for s in (1, -1)] + [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, 2.0 ** 1023])
    b = np.concatenate([np.full(len(a) - 40, 1e9 + 0.25), 1e9 + np.arange(40) * 1e-6])
    rows = [(float(u), float(v), None) for u, v in zip(a, b)] + [(None, float("-inf"), None), (None, float("inf"), None)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    probs = [i / 50 for i in range(51)]
    got = {(r["feature"], r["prob"]): r["q"] for r in QT.exact(df, ["a", "b", "c"], probs).collect()}
    b = np.append(b, [-np.inf, np.inf])
    assert {f for f, _ in got} == {"a", "b"}
    for name, x in (("a", np.sort(a)), ("b", np.sort(b))):
        for p in probs:
            pos = p * (len(x) - 1)
            lo, hi = x[int(np.floor(pos))], x[int(np.ceil(pos))]
            want = lo if lo == hi else lo + (hi - lo) * (pos - np.floor(pos))
            assert got[name, p] == want, (name, p)
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,)], "x double")
    assert [r["q"] for r in QT.exact(nan, ["x"], [0.0, 0.5]).orderBy("prob").collect()] == [1.0, 2.0]
    assert QT.exact(df.limit(0), ["a"], [0.5]).count() == 0


# --- neighbours and phrases -----------------------------------------------------------------------------


def test_knn_join_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    pts = rng.normal(size=(400, 3)) * 5
    pts[100:230] = pts[0]  # a group of copies holding a third of all rows
    rows = [(i, [float(v) for v in p], int(i % 4)) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>, y int")
    out = NB.knn_join(df.filter("id % 2 = 0"), df, "id", "id", "vec", 4, ["y"], exclude_self=True, pivots=8)
    got = {}
    for r in out.orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["near_id"])
    for i in range(0, 400, 2):
        d = np.sqrt(((pts - pts[i]) ** 2).sum(axis=1)).round(9)
        want = [j for j in sorted(range(400), key=lambda j: (d[j], j)) if j != i][:4]
        assert got[i] == want


def _tfidf(texts, grams):
    docs = [grams(t) for t in texts]
    vocab = sorted({g for d in docs for g in d})
    df = {g: sum(g in d for d in docs) for g in vocab}
    idf = {g: math.log((1 + len(texts)) / (1 + df[g])) + 1 for g in vocab}

    def vector(text):
        counts = {}
        for g in grams(text):
            if g in idf:
                counts[g] = counts.get(g, 0) + 1
        v = {g: c * idf[g] for g, c in counts.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {g: x / norm for g, x in v.items()} if norm else {}

    return vector


def _words(t):
    import re

    w = [x for x in re.split(r"[\W]+", t) if len(x) >= 2]
    return w + [" ".join(p) for p in zip(w, w[1:])]


def _chars(t):
    out = []
    for w in t.split():
        w = f" {w} "
        for n in range(3, 6):
            if len(w) >= n:
                out += [w[i : i + n] for i in range(len(w) - n + 1)]
    return out


def test_nearest_phrases_equal_brute_force(spark):
    rows = PH.phrase_rows(spark).collect()
    phrases = [r["text"] for r in sorted(rows, key=lambda r: r["phrase_id"])]
    texts = ["voy a bailar", "quiero meditar en silencio", "zzz qqq", "", "una sesion de gimnasio ahora", "cenar"]
    word, char = _tfidf(phrases, _words), _tfidf(phrases, _chars)

    def joined(t):
        v = {("w", g): x for g, x in word(t).items()} | {("c", g): x for g, x in char(t).items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {g: x / norm for g, x in v.items()}

    vectors = [joined(p) for p in phrases]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    got = {}
    for r in PH.nearest_phrases(df, "id", "text", PH.phrase_rows(spark)).collect():
        got.setdefault(r["id"], []).append((round(r["distance"], 9), r["phrase_id"]))
    for i, t in enumerate(texts):
        v = joined(t)
        d = [max(1 - sum(x * p.get(g, 0.0) for g, x in v.items()), 0.0) for p in vectors]
        want = sorted((round(x, 9), j) for j, x in enumerate(d))[:3]
        assert [j for _, j in sorted(got[i])] == [j for _, j in want]
        assert [x for x, _ in sorted(got[i])] == pytest.approx([x for x, _ in want], abs=1e-8)


def test_phrase_labels(spark):
    texts = ["fregar los platos", "quiero echar la siesta", "preparar una maraton ahora"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    out = {r["id"]: r for r in PH.classify_texts(df, "id", "text").collect()}
    assert [out[i]["label"] for i in range(3)] == ["limpieza_domestica", "dormir", "correr"]
    assert out[0]["confidence"] == pytest.approx(1.0)
    assert out[1]["activity_calm"] == pytest.approx(1.0)


# --- cleaning -----------------------------------------------------------------------------------------
def test_silver_tracks_edge_rows(spark):
    base = {c: "0.5" for c in V.UNIT_FEATURES}
    good = {"track_id": "a", "artists": " x \t y ", "album_name": "b", "track_name": "c", "track_genre": None, "popularity": "12",
            "duration_ms": "1000", "explicit": "maybe", "key": "1", "mode": "0", "time_signature": "4", "loudness": "-7", "tempo": "120", **base}
    bad = [{"energy": "1.2"}, {"loudness": "-81"}, {"tempo": "-1"}, {"duration_ms": "0"}, {"track_id": None}]
    odd = [{"energy": "n/a"}, {"energy": "NaN"}]
    rows = [good] + [{**good, "track_id": f"b{i}", **b} for i, b in enumerate(bad)] + [{**good, "track_id": f"o{i}", **o} for i, o in enumerate(odd)]
    cols = [c for c in DATASETS["tracks_dataset"].columns if c != "Unnamed: 0"]
    raw = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], ", ".join(f"`{c}` string" for c in cols))
    out = {r["track_id"]: r for r in L.silver_tracks(raw).collect()}
    assert set(out) == {"a", "o0", "o1"}
    assert out["a"]["artists"] == "x y" and out["a"]["track_genre"] == "unknown" and out["a"]["explicit"] is False
    assert out["o0"]["energy"] == 0.0 and out["o1"]["energy"] == 0.0
    assert set(r["track_id"] for r in L.silver_tracks(raw, compat=True).collect()) == {"a", "o0", "o1", "unknown"}


def test_word_count_of_empty_text(spark):
    assert one(spark, X.word_count(F.lit("  "))) == 0
    assert one(spark, X.word_count(F.lit("  "), empty_is_one=True)) == 1
    assert one(spark, X.word_count(F.lit(" a  b\nc "))) == 3


def test_name_folding(spark):
    for text, want in [(" Beyoncé & JAY-Z ", "beyoncejayz"), ("Ñandú №5", "nandu5"), ("Ａｂｃ", "abc")]:
        assert one(spark, X.fold_name(F.lit(text))) == want
    df = spark.createDataFrame([("Beyoncé ﬁ",)], "t string")
    assert df.select(X.fold_name_udf()("t").alias("v")).first()["v"] == "beyoncefi" == X.fold_name_literal("Beyoncé ﬁ")


def test_parsers(spark):
    url = "https://open.spotify.com/intl-es/track/0aB1cD2eF3gH4iJ5kL6mN7?si=1"
    assert one(spark, P.track_id_from_url(F.lit(url))) == "0aB1cD2eF3gH4iJ5kL6mN7"
    assert one(spark, P.track_id_from_url(F.lit("https://x.y/track/0aB1cD2eF3gH4iJ5kL6mN7"))) is None
    for text, want in [("3:05", 185000), ("1:00:01", 3601000), ("215", 215000), ("185000", 185000), ("-4", 0), ("a:b", 0), (None, 0), ("2,5", 2500)]:
        assert one(spark, P.duration_ms(F.lit(text).cast("string"))) == want
    assert one(spark, P.loudness_db(F.lit("-7 dB"), True)) == -7.0
    assert one(spark, P.loudness_db(F.lit("0.5"), False)) == -30.0
    assert one(spark, P.loudness_db(F.lit("-9"), False)) == -9.0
    assert one(spark, P.unit_value(F.lit("73,5"))) == pytest.approx(0.735)
    assert one(spark, P.format_duration(F.lit(61_500))) == "1:02"
    assert one(spark, P.format_duration(F.lit(0))) == "-"


def test_payload_search(spark):
    rows = [
        ('{"data": [{"track": {"Title": "Uno", "artist": "Solo"}}], "style": "rock", "duration": 200}',),
        ('{"name": "", "album": "LP", "x": {"name": "Dos"}, "artists": ["a", "b"], "popularity": 0.4}',),
        ("not json",),
    ]
    m = PL.track_metadata(spark.createDataFrame(rows, "p string"), "p").collect()
    assert (m[0]["track_name"], m[0]["artists"], m[0]["track_genre"], m[0]["duration_ms"]) == ("Uno", "Solo", "rock", 200000)
    assert (m[1]["track_name"], m[1]["artists"], m[1]["album_name"], m[1]["popularity"]) == ("Dos", "a, b", "LP", 40)
    assert (m[2]["track_name"], m[2]["track_genre"]) == ("Track sin nombre", "spotify_unknown")


def test_json_fields_equal_the_recursive_search(spark):
    """Random nesting, order of keys, blanks, odd texts and depths beyond the bound; no Python for plain payloads."""
    rng = np.random.default_rng(5)
    keys = ["Name", "title", "ARTIST", "x", "y", "id"]

    def node(left):
        kind = rng.integers(0, 8 if left else 5)
        if kind < 5:
            return [None, "", f"t{rng.integers(9)}", int(rng.integers(99)), '{"name": "in a text"}'][kind]
        if kind == 5:
            return [node(left - 1) for _ in range(rng.integers(0, 3))]
        return {str(k): node(left - 1) for k in rng.permutation(keys)[: rng.integers(0, 5)]}

    def deep(n):
        return {"name": "far"} if n == 0 else {"x": deep(n - 1)}

    texts = [json.dumps(node(4)) for _ in range(150)] + [json.dumps(deep(n)) for n in (1, 4, 5, 6, 9)]
    texts += [None, "", "  ", "no json", '{"name": 1} trailing', "{'name': 'single'}", '{"name": "a", "name": "b"}', '{"x": [NaN], "id": 3}', ' {"name": "é\\u00e9\\n"}', "[]", "{}", '"name"', '{"x": {"id": 1.5}}', '{"id": 1}, {"id": 2}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, p string")
    fields = {"track": ("title", "name"), "artist": ("artist",), "id": ("id",)}
    got = {r["i"]: r["_f"] for r in PL.find_fields(df, "p", fields).collect()}
    want = {r["i"]: r["w"] for r in df.withColumn("w", P.find_json_udf(fields)("p")).collect()}
    assert len(got) == len(texts)
    value = lambda v: None if v is None else json.loads(v)
    for i, t in enumerate(texts):
        for f in fields:
            assert value(got[i][f]) == value(want[i][f]), (t, f)
    plain = PL.find_fields(df, "p", fields)._jdf.queryExecution().optimizedPlan().toString()
    assert plain.count("ArrowEvalPython") == 1  # of the branch for the rest


def test_search_weighs_each_training_side_alone(spark):
    """No fit sees a weight that its held-out fold had a part in; the best set is fitted again on all rows."""
    from cantus.operators import modeling as M

    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 2))
    rows = [(i, float(a), float(b), int(a > 0.8), i % 3) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, a double, b double, label int, fold int")
    sides = []

    def weigh(side):
        sides.append(sorted(r["fold"] for r in side.select("fold").distinct().collect()))
        return M.balanced_weights(side, "label", [0, 1])

    make = lambda **p: M.classifier_pipeline("logistic_regression", ["a", "b"], "label", total_weight=80.0, **p)
    model, results = M.grid_search(df, make, {"C": [0.01, 10.0], "max_iter": [30]}, M.MacroF1(labelCol="label", labels=[0, 1]), weigh=weigh)
    assert sides == [[1, 2], [0, 2], [0, 1], [0, 1, 2]]
    assert len(results) == 2 and results[1][1] > 0.85
    facts = {r["label"]: r for r in M.score_facts(M.score_classifier(model, df, 2), "label", [0, 1]).collect()}
    assert facts[0]["rows"] + facts[1]["rows"] == 120 and all(f["sums_to_one"] and f["takes_largest"] for f in facts.values())


def test_rank_bounds_tell_a_wrong_quantile(spark):
    df = spark.createDataFrame([(float(i), None if i % 2 else 1.0) for i in range(1000)], "x double, y double")
    found = spark.createDataFrame([("x", [500.0, 700.0]), ("y", [1.0, 1.0])], "feature string, q array<double>")
    got = {(r["feature"], r["prob"]): (r["n"], r["is_value"], r["within"]) for r in QT.rank_bounds(df, found, ["x", "y"], [0.5, 0.9], 0.001).collect()}
    assert got == {("x", 0.5): (1000, True, True), ("x", 0.9): (1000, True, False), ("y", 0.5): (500, True, True), ("y", 0.9): (500, True, True)}


def test_upload_validation(spark):
    values = {**{c: 0.5 for c in V.UNIT_FEATURES}, "loudness": -5.0, "tempo": 100.0}
    good = {"URL": "https://open.spotify.com/track/0aB1cD2eF3gH4iJ5kL6mN7", "Duration (ms)": 1000.0, "Explicit": "sí", **values}
    bad_url, bad_range, missing = {**good, "URL": "nope"}, {**good, "tempo": -1.0}, {**good, "energy": None}
    names = list(good)
    schema = ", ".join(f"`{n}` {'string' if n in ('URL', 'Explicit') else 'double'}" for n in names)
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in (good, bad_url, bad_range, missing)], schema)
    ok, rejected = Q.split_valid(PL.prepare_upload(df))
    row = ok.first()
    assert ok.count() == 1 and row["track_id"] == "0aB1cD2eF3gH4iJ5kL6mN7" and row["explicit"] and row["track_genre"] == "realtime_input"
    assert rejected.count() == 3
    with pytest.raises(ValueError):
        PL.prepare_upload(df.drop("energy"))


# --- joins, metadata, io ---------------------------------------------------------------------------------
def test_split_report_matches_nulls(spark):
    train = spark.createDataFrame([(1.0, None, 0), (1.0, None, 1), (2.0, 3.0, 0)], "a double, b double, y int")
    test = spark.createDataFrame([(1.0, None, 0), (1.0, None, 0), (9.0, 9.0, 1)], "a double, b double, y int")
    r = J.split_report(train, test, ["a", "b"], "y").first()
    assert r["test_rows_with_feature_overlap"] == 2 and r["feature_overlap_label_agreement"] == pytest.approx(0.5)
    assert (r["train_duplicate_feature_rows"], r["test_duplicate_feature_rows"]) == (1, 1)


def test_upsert_and_replace(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(map(tuple, J.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(map(tuple, J.replace_by_key(old, new, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "C")]


def test_macro_auc_undefined_without_positives(spark):
    df = spark.createDataFrame([(0, 0.1, 0.9), (0, 0.2, 0.8)], "y int, a double, b double")
    assert E.macro_auc(df, "y", {0: "a", 1: "b"}).first()["roc_auc"] is None


def test_names_and_types(spark):
    assert C.safe_name("2nd Col (ms)") == "col_2nd_col_ms"
    df = spark.createDataFrame([(1, 2.0, True, "x")], "a int, b float, c boolean, d string")
    assert [C.catalog_type(f.dataType) for f in df.schema] == ["bigint", "double", "boolean", "string"]
    assert C.numeric_columns(df, ("a",)) == ["b"]
    assert len(D.schema_hash(df)) == 32 and D.schema_hash(df) != D.schema_hash(df.drop("a"))


def test_bronze_keeps_corrupt_lines_apart(spark, tmp_path):
    (tmp_path / "part-1.jsonl").write_text('{"a": "1"}\n{broken\n{"a": null}\n')
    df = io.read_bronze(spark, str(tmp_path), spark.createDataFrame([], "a string").schema).cache()
    assert df.count() == 3 and io.good_lines(df).count() == 2
    with pytest.raises(FileNotFoundError):
        io.read_layer(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError):
        io.read_upload(spark, "table.xlsx")


def test_write_layer_counts_rows_while_writing(spark):
    path = shared_dir(spark, "t")
    assert io.write_layer(spark.range(77), path, max_records_per_file=10, observe="rows") == 77
    assert io.read_layer(spark, path).count() == 77
    assert io.first_existing(spark, ["nofs://x/y", path + "/none", path]) == path


def test_scaler_with_constant_feature(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    stats = PR.scaler_stats(df, ["a", "b"])
    out = PR.apply_scaler(df, stats, ["a", "b"]).orderBy("a").collect()
    assert [r["b"] for r in out] == [0.0, 0.0] and out[0]["a"] == pytest.approx(-1 / math.sqrt(2))


def test_clip_keeps_null(spark):
    assert one(spark, N.clip(F.lit(None).cast("double"), 0, 1)) is None
    assert one(spark, N.safe_int(F.lit("1e30"))) is None
    assert one(spark, N.safe_double(F.lit("NaN"))) is None


def test_positions_tell_equal_values_apart(spark):
    df = spark.range(900).selectExpr("id", "id % 3 AS v")
    rows = K.positions(df, "v", tie=["id"]).orderBy("sample_index").collect()
    assert [r["sample_index"] for r in rows] == list(range(900))
    assert [r["v"] for r in rows] == [0] * 300 + [1] * 300 + [2] * 300


def test_unicode_blanks_are_squashed(spark):
    assert one(spark, X.squash(F.lit("a\u00a0b\u2003 c"))) == "a b c"


def test_trees_deeper_than_the_library_allows_fail():
    from cantus.operators import modeling

    with pytest.raises(ValueError):
        modeling.classifier_pipeline("random_forest", ["a"], "label", max_depth=50)


def test_large_request_ids_are_drawn(spark):
    from cantus.operators import recommend

    big = 3_000_000_000
    found = spark.createDataFrame([(big, f"t{i}", i) for i in range(20)], "request_id long, track_id string, rank int")
    assert recommend.draw(found, [recommend.Request(big, "feliz", "x", 4)], 1).count() == 4


def test_history_of_an_earlier_run_stays(spark, tmp_path):
    from cantus.streaming import jobs

    for run in range(2):
        spark.range(5 * run, 5 * run + 5).write.parquet(str(tmp_path / f"in{run}"))
        stream = jobs.file_stream(spark, str(tmp_path / f"in{run}"), spark.range(1).schema)
        for _ in range(2):  # a resumed run adds nothing twice
            jobs.classify_online(stream, lambda b: b, str(tmp_path / "catalog"), str(tmp_path / "history"), str(tmp_path / f"check{run}"))
    for name in ("catalog", "history"):
        assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / name)).collect()) == list(range(10))


def test_shared_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    from cantus import session

    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="local-cluster[2,1,1024]"))
    with pytest.raises(ValueError):
        session.shared_dir(fake, "x")


def test_rule_counts_need_no_list_per_row(spark):
    df = spark.createDataFrame([(None, -1.0), (2.0, 3.0), (0.5, 3.0)], "energy double, tempo double")
    got = {r["rule"]: r["rows"] for r in Q.count_failed_rules(df, ["energy"]).collect()}
    assert sorted(got.values()) == [1, 1, 1]


def test_name_folding_of_every_sign(spark):
    signs = [chr(c) for c in range(0x80, 0x20000) if not 0xD800 <= c < 0xE000]
    words = [f"x{c}y" for c in signs] + ["𝐚bc", "\ufb01n", "a\u00bdb\ufb01"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", X.fold_name(F.col("w")).alias("f")).collect()
    assert {r.w: r.f for r in got[-3:]} == {"𝐚bc": "abc", "\ufb01n": "fin", "a\u00bdb\ufb01": "a12bfi"}
    assert [r.w for r in got if r.f != X.fold_name_literal(r.w)] == []


def test_artist_search_spans_a_separator(spark):
    df = spark.createDataFrame([(1, "Nord & Sued"), (2, "Nord;Ost"), (3, None)], "id int, artists string")
    assert [r.id for r in Q.by_artist(df, "nord & sued").collect()] == [1]


def test_sample_rows_with_repeated_keys(spark):
    df = spark.range(100).selectExpr("id", "id % 3 AS k")
    for n in (1, 12, 34, 50, 100, 200):
        assert sorted(r.id for r in K.sample_rows(df, ["k"], n).collect()) == sorted(set(r.id for r in K.sample_rows(df, ["k"], n).collect()))
        assert K.sample_rows(df, ["k"], n).count() == min(n, 100)


def test_events_that_do_not_parse_are_kept(spark, tmp_path):
    from pyspark.sql import types as T

    from cantus.sources import io
    from cantus.streaming import jobs

    events = ['{"dataset": "a", "payload": {"x": 1}}', '{"dataset": "b", "payload": {"x": 2}}', "no json", '{"payload": {"x": 3}}', None]
    base, schema = str(tmp_path), T.StructType([T.StructField("value", T.StringType())])
    for i in range(3):  # several files and batches; the second run goes on where the first stopped
        spark.createDataFrame([(e,) for e in events], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        if i:
            jobs.ingest(jobs.file_stream(spark, f"{base}/in", schema, max_files=1), f"{base}/bronze", f"{base}/checkpoint")
    found = io.read_bronze(spark, f"{base}/bronze", T.StructType([T.StructField("x", T.LongType())]))
    assert {r["dataset"]: r["count"] for r in found.groupBy("dataset").count().collect()} == {"a": 3, "b": 3, jobs.REJECTED: 9 - spark.read.text(f"{base}/bronze").filter("value = ''").count()}
    assert sorted(r.x for r in io.good_lines(found).filter("dataset <> 'rejected'").collect()) == [1, 1, 1, 2, 2, 2]


def test_stream_timeout_then_resume(spark, tmp_path):
    import time

    from cantus.streaming import jobs

    base = str(tmp_path)
    spark.range(30).repartition(3).write.parquet(f"{base}/in")

    def job(classify, timeout=None):
        stream = jobs.file_stream(spark, f"{base}/in", spark.range(1).schema, max_files=1)
        jobs.classify_online(stream, classify, f"{base}/catalog", f"{base}/history", f"{base}/check", timeout)

    def slow(batch):
        time.sleep(4)
        raise RuntimeError("stopped")

    with pytest.raises(TimeoutError):
        job(slow, timeout=1)
    job(lambda batch: batch)
    rows = spark.read.parquet(f"{base}/history")
    assert rows.count() == rows.select("id").distinct().count() == 30
    assert rows.select("batch").distinct().count() == 3


def test_clean_bronze_replaces_earlier_runs(spark, tmp_path):
    path = str(tmp_path / "bronze")
    for clean, rows in ((False, 3), (False, 6), (True, 3)):
        io.append_json_lines(spark.range(3), path, clean=clean)
        assert spark.read.json(path).count() == rows


def test_tf_idf_has_unit_length_per_kind(spark):
    df = spark.createDataFrame([(1, "uno dos uno"), (2, "dos tres"), (3, None)], "k int, t string")
    rows = PH.tf_idf(df, "k", "t").collect()
    for key in {(r["k"], r["kind"]) for r in rows}:
        assert math.fsum(r["weight"] ** 2 for r in rows if (r["k"], r["kind"]) == key) == pytest.approx(1)
    own = {r["term"]: r["weight"] for r in rows if r["k"] == 2 and r["kind"] == 0}
    idf = lambda df: math.log(4 / (1 + df)) + 1
    assert own["dos"] / own["tres"] == pytest.approx(idf(2) / idf(1)) and "dos tres" in own
