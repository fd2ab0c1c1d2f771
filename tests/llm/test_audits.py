"""Filter audit, benchmark decontamination and hard negatives against brute force, odd rows included."""

import re
from itertools import permutations

import numpy as np
import pytest
from cantus.llm import decontamination, filter_audit, hard_negatives
from pyspark.sql import functions as F

BLANK = rb"[\x20\x09-\x0D]+"


# -- filter audit ---------------------------------------------------------------------------------

LONG = " ".join(f"w{i}" for i in range(250))
TEXTS = [None, "", "  ", LONG, LONG, LONG + " ", "same " * 300, "SHOUT " + LONG, "SHOUT" * 20 + LONG, LONG + " 100%", "a|b", "é" * 40 + " É", LONG + "x" * 30_000, LONG + "x" * 30_000, LONG + "x" * 29_999]


@pytest.fixture(scope="module")
def audited(spark):
    rows = [(i, t, "ab"[i % 2] if i % 5 else None, "mine", i) for i, t in enumerate(TEXTS)]
    rows += [(3, LONG, "a", "mine", 0), (None, LONG, "b", "mine", 0), (None, None, None, "mine", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, mask string, owner int").repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 15, 2)] + [(4, 1, None), (None, 1, 1), (3, 1, 0), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def masks_by_hand(rows):
    out = []
    for r in rows:
        text = r.text or ""
        words = [w for w in re.split(BLANK, text.encode()) if w]
        upper = sum("A" <= c <= "Z" for c in text)
        e = r.doc_id is not None and any(o.doc_id is not None and o.doc_id < r.doc_id and (o.text or "") == text for o in rows)
        m = (len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words)) + 4 * (100 * upper > 2 * len(text)) + 8 * any(c in text for c in "#$%&*|") + 16 * e
        out.append((r.doc_id, r.source or "", m))
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, *[x or 0 for x in r[:1]], *r[1:]))


@pytest.mark.parametrize("bounds", [{}, {"range_bytes": 40, "task_bytes": 10}, {"range_bytes": 4_000, "task_bytes": 1}])
def test_filter_masks(audited, bounds):
    got = filter_audit.filter_masks(audited, **bounds).collect()
    assert in_order([tuple(r) for r in got]) == in_order(masks_by_hand(audited.collect()))


def test_adaptive_prefixes_part_long_common_beginnings(spark):
    shared = "header " * 3_000
    texts = spark.createDataFrame([(bytes(f"{shared}{i:05d}" * (1 + i % 2), "utf8"),) for i in range(60)] + [(b"hot",)] * 500, "text binary")
    cuts = filter_audit.prefix_ranges(texts, 100_000)
    assert cuts == sorted(set(cuts)) and cuts[0] == b"" and len(cuts) > 10
    assert max(map(len, cuts)) > len(shared)


def test_trie_splits_edges():
    trie = filter_audit.RadixTrie()
    texts = [b"romane", b"romanus", b"rom", b"", b"romane", b"x" * 9_000, b"x" * 8_999 + b"y"]
    ends = [trie.insert(t, i) for i, t in enumerate(texts)]
    assert ends[0] == ends[4] and len(set(ends)) == 6 and trie.least[ends[4]] == 0


def test_filter_audit(spark, audited, labels):
    rows, known = masks_by_hand(audited.collect()), labels.collect()
    good = {r.doc_id for r in known if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in known if r.toxic == 1 and r.doc_id is not None}
    want = {}
    for part in {p for _, p, _ in rows}:
        own = [(i, m) for i, p, m in rows if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                gone = [x for x in left if x[1] & bit]
                kept = [x for x in left if not x[1] & bit]
                before = len([x for x in own if x[1] & bit]) - len(gone)
                want[part, "".join(order), step] = [len(kept), len(gone), before, sum(m == bit for _, m in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
                left = kept
    shapley = {}
    for (part, order, step), v in want.items():
        shapley[part, order[step - 1]] = shapley.get((part, order[step - 1]), 0) + v[1]
    got = filter_audit.filter_audit(audited, labels).collect()
    assert len(got) == len(want) == 600 * 3
    for r in got:
        assert [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost] == want[r.part, r.filter_order, r.step]
        assert r.shapley == shapley[r.part, r.filter_order[r.step - 1]]
    assert filter_audit.filter_audit(audited.where("false"), labels).count() == 0
    assert filter_audit.filter_audit(audited, labels.where("false")).agg(F.sum("good_lost")).first()[0] == 0


# -- decontamination ------------------------------------------------------------------------------


def words(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower) if w]


@pytest.fixture(scope="module")
def bench():
    rng = np.random.default_rng(3)
    prose = lambda n: " ".join(str(w) for w in rng.choice(["Ñandú", "ÉBÈNE", "the", "of", "a1", "ΟΔΟΣ", "İx", "日本"], n))
    items = [(1, prose(30)), (2, prose(14)), (3, "Zebra"), (4, "two Words"), (5, prose(9) + " nine"), (6, None), (7, " .,-"), (8, prose(11)), (None, prose(12))]
    items += [(9, items[0][1]), (1, prose(20)), (1, items[0][1])]
    texts = [None, "", "zebra", "ZEBRA two, words; two", prose(300), items[0][1], items[0][1].upper(), "x " + items[1][1].replace(" ", "\n--") + " y " + items[4][1], prose(9)]
    texts += ["the " * 5_000 + items[8][1], items[7][1] + " " + items[7][1], " ".join(items[0][1].split()[:9]), items[10][1] + " " + items[1][1]]
    return items, texts + texts[4:6]


@pytest.mark.parametrize("window, gram", [(10, 4), (10, 10), (10, 1), (3, 2)])
def test_contamination(spark, bench, window, gram):
    items, texts = bench
    docs = spark.createDataFrame([(i % 12 if i else None, t, "mine", "w") for i, t in enumerate(texts)], "doc_id long, text string, fp string, w string").repartition(2)
    listed = spark.createDataFrame(items, "item_id long, text string").withColumn("salt", F.lit("s"))
    wins = {}
    for i, t in items:
        w = words(t)
        for s in range(max(len(w) - window, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[s : s + window]), set()).add(i)
    want = []
    for i, t in enumerate(texts):
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in wins}:
            for s in range(len(w) - n + 1):
                own = wins.get(tuple(w[s : s + n]))
                if own:
                    hit.update(range(s, s + n))
                    found |= own
        want.append((i % 12 if i else None, len(w), len(hit), sorted(str(x) for x in found if x is not None), bool(hit)))
    got = decontamination.contamination(docs, listed, window=window, gram=gram).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in got], key=key) == sorted(want, key=key)
    for r in got:
        assert sum(s.length for s in r.spans) == r.n_hit
        assert all(a.start + a.length < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_contamination_of_empty_tables(spark, bench):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame(bench[0], "item_id long, text string")
    assert decontamination.contamination(docs.where("false"), items).count() == 0
    assert [r.contaminated for r in decontamination.contamination(docs, items.where("false")).collect()] == [False]
    assert decontamination.decontaminate(docs.unionByName(spark.createDataFrame([(2, "x zebra")], docs.schema)), items).columns == docs.columns


def test_full_bit_map_only_lets_more_through(spark, bench):
    assert decontamination.map_cells(0) == 1 << 12 and decontamination.map_cells(1 << 40) == 1 << 18


# -- hard negatives -------------------------------------------------------------------------------


def by_hand(rows):
    out = []
    for a in rows:
        if a[0] % 5:
            continue
        score = lambda r: sum(x * y for x, y in zip(a[2], r[2]))
        others = sorted(((-score(r), r[0], r[1]) for r in rows if r[0] != a[0] and len(r[2]) == len(a[2])))
        for s, p, _ in [o for o in others if o[2] == a[1]][:5]:
            fit = [o for o in others if o[2] != a[1] and 50 * -s <= 100 * -o[0] <= 95 * -s][:3]
            out += [(a[0], p, k, n, -s, -t) for k, (t, n, _) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("slice_rows, anchor_rows, focus", [(4_096, 2_048, 5), (7, 3, 2), (20, 4, 8)])
def test_hard_negatives(spark, slice_rows, anchor_rows, focus):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(6, 8))
    rows = [(i, (base[i % 6] + 0.4 * rng.normal(size=8)).tolist() if i % 9 else base[0].tolist(), i % 3) for i in range(150)]
    rows += [(200, None, 1), (205, [1.0] * 8, None), (210, [float("nan")] * 8, 1), (215, [None, *[1.0] * 7], 1), (220, [0.0] * 8, 1), (225, [1.0] * 3, 1), (230, [0.5] * 3, 2), (None, [1.0] * 8, 1)]
    rows += [(235, [5.0e3] * 8, 0), (236, [4.0e3] * 8, 1), (237, [6.0e3] * 8, 0), (240, [], 1), (5, rows[5][1], 2), (5, rows[5][1], 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("size", F.lit("mine")).repartition(3)
    valid = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        row = (i, label, [int(np.floor(256 * x)) for x in v])
        valid[i] = min(valid.get(i, row), row)
    got = hard_negatives.hard_negatives(table, F.col("vec_id") % 5 == 0, slice_rows=slice_rows, anchor_rows=anchor_rows, focus=focus)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.select(names).collect()) == by_hand(list(valid.values()))
    assert hard_negatives.hard_negatives(table.where("false"), F.col("vec_id") % 5 == 0).count() == 0


def test_feasible_ranges_lose_nothing():
    rng = np.random.default_rng(2)
    block = hard_negatives.Slice(np.arange(500), np.floor(256 * rng.normal(size=(500, 6))))
    pruned = 0
    for q in np.floor(256 * rng.normal(size=(40, 6))):
        for least in (1.0, 50_000.0, 200_000.0, 1e6):
            found = set(block.candidates(q, least, 4).tolist())
            assert set(np.flatnonzero(block.vectors @ q >= least).tolist()) <= found
            pruned += 500 - len(found)
    assert pruned > 0
    wide = hard_negatives.Slice(np.arange(2), np.array([[3.0e8, 1.0], [3.0e8, 2.0]]))
    assert wide.scores(np.array([3.0e8, 1.0]), np.arange(2)).tolist() == [90_000_000_000_000_001, 90_000_000_000_000_002]
