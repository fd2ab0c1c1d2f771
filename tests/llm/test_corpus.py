"""Corpus operators against brute force, on small tables with nulls, ties, repeats and odd columns."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from cantus.llm import byte_bpe, embedding_dedup, exact_dedup, line_dedup, lm_scoring, packing, quality, simhash, substring_dedup, token_counts

BLANK = re.compile(rb"[\x20\x09-\x0D]+")
WORDS = "the of thonin erasti wherea onble, and. Ébène ñandú ti tion 12 a's".split()
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def make_texts():
    rng = np.random.default_rng(5)

    def prose(n):
        return " ".join(str(w) + str(rng.integers(0, 40)) for w in rng.choice(WORDS, n))

    passage, chunk = prose(45), "\n".join(prose(6) for _ in range(9))
    texts = [None, "", "  \t\n ", "one", prose(30), passage, "x " + passage + "  tail", prose(25) + "\n" + passage]
    texts += [chunk, prose(9) + "\n" + chunk, chunk + "\n" + prose(8), "a b\tc", "a b c", "a  b\n\nc", passage.replace(" ", "  ")]
    texts += [" ".join(["same"] * 60), prose(4000), "<|endoftext|> 日本語  \x1f é́ ", "THE of\nthe OF"]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(make_texts())]
    rows += [(100, rows[4][1], "y", 0), (101, rows[6][1], "y", 0)]
    schema = "doc_id long, text string, batch_id string, n_words long"  # clashing names on purpose
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: (r.text or "").encode() for r in docs.collect()}


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_packing(docs, texts, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORD_FILE)
    tok.encode_special_tokens = True
    rows = packing.pack_documents(docs, WORD_FILE, seq_len=256, node_items=6).collect()
    got, seqs = collections.defaultdict(dict), collections.defaultdict(list)
    for r in rows:
        got[r.doc_id][r.piece] = r
        seqs[r.sequence_id].append((r.offset, r.length))
    for doc, text in texts.items():
        ids = np.array([*tok.encode(text.decode(), add_special_tokens=False).ids, 0], "<u4")
        want = [(at, len(ids[at : at + 256]), zlib.crc32(ids[at : at + 256].tobytes())) for at in range(0, len(ids), 256)]
        assert [(got[doc][k].start, got[doc][k].length, got[doc][k].ids_crc32) for k in range(len(want))] == want
        assert len(got[doc]) == len(want)
    for own in seqs.values():
        own.sort()
        assert own[0][0] == 0 and sum(n for _, n in own) <= 256 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
    assert len(seqs) <= 1.1 * sum(r.length for r in rows) / 256 + 1
    assert packing.pack_documents(empty, WORD_FILE).count() == 0


def test_best_fit_takes_fullest_bin():
    assert packing.best_fit(np.array([6, 5, 4, 3, 2]), 10).tolist() == [0, 1, 0, 1, 1]


@pytest.mark.parametrize("many", [20_000, 1])
def test_substring_dedup(docs, texts, empty, many):
    got = by_id(substring_dedup.substring_dedup(docs, batch_bytes=2_000, bytes_per_owner=4_000, many=many))
    seen = set()
    for doc in sorted(texts):
        words = texts[doc].split()
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            key = tuple(words[k : k + 20])
            if key in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(key)
        r = got[doc]
        assert (r.n_words, r.n_removed) == (len(words), sum(gone))
        assert (r.text or "").encode().split() == [w for w, g in zip(words, gone) if not g]
        if not sum(gone):
            assert (r.text or "").encode() == texts[doc]
    assert got[0].text is None and got[0].batch_id == "x"
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_substring_dedup_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = spark.createDataFrame([(None, text), (7, text), (7, text)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.n_removed) for r in substring_dedup.substring_dedup(rows).collect())
    assert got == [(False, 0), (False, 30), (True, 30)]


def test_line_dedup(docs, texts, empty):
    got = by_id(line_dedup.line_dedup(docs, batch_bytes=2_000, bytes_per_owner=4_000))
    seen, cut = set(), 0
    for doc in sorted(texts):
        kept, n = [], 0
        for _, _, lines in line_dedup.chunked([texts[doc]], 2, 4):
            body = b"\n".join(lines)
            if len(lines) > 1 and body.strip():
                if body in seen:
                    n += len(lines)
                    continue
                seen.add(body)
            kept += lines
        cut += n
        assert ((got[doc].text or "").encode(), got[doc].n_lines, got[doc].n_removed_lines) == (b"\n".join(kept), texts[doc].count(b"\n") + 1, n)
    assert cut > 0 and got[0].text is None
    assert line_dedup.line_dedup(empty).count() == 0


def brute_runs(texts):
    """Lines that go from each text: those of pairs seen before, and blank lines between such lines."""
    seen, out = {}, []
    for d, text in enumerate(texts):
        lines = text.split(b"\n")
        gone = [False] * len(lines)
        for i, pair in enumerate(zip(lines, lines[1:])):
            if b"".join(pair).strip():
                first = seen.setdefault(pair, (d, i))
                if first != (d, i) and first != (d, i - 1):
                    gone[i] = gone[i + 1] = True
        solid = [i for i, x in enumerate(lines) if x.strip()]
        for a, z in zip(solid, solid[1:]):
            if z > a + 1 and gone[a + 1] and gone[z - 1]:
                gone[a + 1 : z] = [True] * (z - a - 1)
        out.append(([x for x, g in zip(lines, gone) if not g], sum(gone)))
    return out


def test_line_runs_of_every_length(spark, empty):
    rng = np.random.default_rng(8)

    def line():
        return " ".join(str(w) for w in rng.integers(0, 10_000, 4))

    texts, passages = [], []
    for n in [2, 3, 4, 6, 8, 10, 20] * 3:
        passages.append([line() for _ in range(n)])
        for _ in range(2):
            texts.append("\n".join([line(), line(), *passages[-1], line()]))
    texts += ["a\na\na", "b\na\na\na\na\na", "one\n\n\n\n\ntwo", "x\none\n\n\n\n\ntwo\ny", "\n\n\n", "\n\n", "same", "same", "p\nq\np\nq\np", "", "q\np"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (900, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = by_id(line_dedup.line_run_dedup(docs, batch_bytes=500, bytes_per_owner=1_000))
    want = brute_runs([t.encode() for t in [*texts, texts[0]]])
    for i, (kept, n) in zip([*range(len(texts)), None], want):
        assert ((got[i].text or "").encode(), got[i].n_removed_lines) == (b"\n".join(kept), n)
    for k, own in enumerate(passages):  # the whole passage goes from the second text, its neighbours stay
        assert (got[2 * k].n_removed_lines, got[2 * k + 1].n_removed_lines, got[2 * k + 1].n_lines) == (0, len(own), len(own) + 3)
    assert got[None].n_removed_lines == got[None].n_lines and got[900].text is None
    assert line_dedup.line_run_dedup(empty).count() == 0


def brute_print(text):
    words = text.lower().split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(ids, linked):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


@pytest.mark.parametrize("most", [20_000, 1])
def test_simhash_groups(docs, texts, empty, most):
    got = by_id(simhash.simhash_groups(docs, most=most))
    prints = {d: brute_print(t) for d, t in texts.items()}
    root = closure(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {d: (f"{prints[d]:016x}", root[d]) for d in prints}
    assert simhash.simhash_groups(empty).count() == 0


def test_simhash_groups_stay_bounded(spark):
    """Fingerprints that share 46 bits: no task's group is much larger than ``most``, no link is lost."""
    rng = np.random.default_rng(6)
    free = rng.choice(64, 18, replace=False).astype(np.uint64)
    picks = rng.integers(0, 2, (300, 18)).astype(np.uint64)
    values = np.unique(np.uint64(0x0123456789ABCDEF) ^ (picks << free).sum(axis=1, dtype=np.uint64))
    values = np.concatenate([values, rng.integers(0, 2**63, 50, dtype=np.uint64)])
    rows = [(int(v), i) for i, v in enumerate(values.view(np.int64))]
    prints = spark.createDataFrame(rows, "bits long, doc_id long")
    groups = simhash.dealt(prints.withColumnRenamed("doc_id", "rep"), 3, 40)
    assert max(r["count"] for r in groups.groupBy("block", "path", "part", "pair").count().collect()) <= 80
    near = np.argwhere(np.triu(np.bitwise_count(values[:, None] ^ values[None]) <= 3, 1)).tolist()
    root = closure(range(len(values)), near)
    got = {r.node: r.component_id for r in simhash.link_fingerprints(prints, 3, most=40).collect()}
    assert len(near) > 100 and got == {i: root[i] for i in {x for p in near for x in p}}
    held = {}
    for r in groups.collect():
        held.setdefault(r.rep, set()).add((r.block, r.path, r.part, r.pair))
    assert all(held[a] & held[b] for a, b in near)


def test_simhash_fingerprint_is_the_hash_of_spark(spark):
    from pyspark.sql import functions as F

    want = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0] % 2**64
    assert simhash.fingerprint(b"One  two\tthree", 3) == want


def test_gray_links_match_brute_force():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (3, 300)).astype(np.uint64), axis=0)
    values = np.unique(np.concatenate([base, base ^ flips]))
    values = values[np.argsort(simhash.gray_rank(values))]
    got = {tuple(p) for pairs in simhash.gray_links(values, 3, block=100) for p in pairs.tolist()}
    near = np.bitwise_count(values[:, None] ^ values[None]) <= 3
    assert got == {tuple(p) for p in np.argwhere(np.triu(near, 1)).tolist()}


def test_lm_scores(docs, texts, empty):
    got = by_id(lm_scoring.lm_scores(docs, batch_bytes=2_000, bytes_per_owner=4_000))
    tokens = {d: [*t.lower().split(), b"\n"] for d, t in texts.items()}
    cls = {d: zlib.crc32(str(d).encode()) % 7 for d in texts}
    train = [d for d in texts if cls[d] != 2]
    count = collections.Counter(w for d in train for w in tokens[d])
    n, v = sum(count.values()), len(count)
    for d, own in tokens.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (cls[d] == 2, len(own), sum(w in count for w in own), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)

    # the model: weights by EM on the deleted part from counts of the rest, then counts of all training text
    def pairs_of(d):
        return list(zip([b"\n", *tokens[d][:-1]], tokens[d]))

    def model(own):
        uni = collections.Counter(w for d in own for w in tokens[d])
        return uni, collections.Counter(p for d in own for p in pairs_of(d)), sum(uni.values()), len(uni)

    def parts(counts, u, w):
        uni, bi, total, size = counts
        return int(lm_scoring.bucket_of(np.array([uni[u]]))[0]), (1 / (size + 1), uni[w] / total, bi[u, w] / max(uni[u], 1))

    core = model([d for d in train if cls[d] != 3])
    cells = [(b, 1, *p) for d in train if cls[d] == 3 for u, w in pairs_of(d) for b, p in [parts(core, u, w)]]
    weights, full = lm_scoring.learn_weights(cells), model(train)
    for d in texts:
        want = sum(math.log10(np.dot(weights.get(b, lm_scoring.DEFAULT), p)) for u, w in pairs_of(d) for b, p in [parts(full, u, w)])
        assert math.isclose(got[d].score, want, rel_tol=0.02)
    assert lm_scoring.lm_scores(empty).count() == 0


def test_lm_scores_beat_the_base_on_held_out_text(spark, sf):
    rows = lm_scoring.lm_scores(spark.read.parquet(f"{sf}/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_exact_groups(docs, texts, empty):
    got = by_id(exact_dedup.exact_groups(docs, bucket_slots=2, max_depth=6))
    groups = collections.defaultdict(list)
    for d, t in texts.items():
        groups[BLANK.sub(b" ", t)].append(d)
    want = {d: (min(own), len(own), d == min(own), sha(t)) for t, own in groups.items() for d in own}
    assert {d: tuple(r)[1:] for d, r in got.items()} == want
    assert exact_dedup.exact_dedup(docs).count() == len(groups)
    assert exact_dedup.exact_groups(empty).count() == 0


def test_directory_doubles_until_buckets_fit(spark):
    slots = spark.createDataFrame([(h << 60,) for h in range(-8, 8)] + [(5,), (6,)], "h long")
    rows = exact_dedup.directory(slots, bucket_slots=3, max_depth=4).collect()
    assert {r.cell: r.depth for r in rows}[0] == 4 and len(rows) == 16
    assert {r.depth for r in rows if r.cell >= 4} == {3}


def test_byte_bpe(docs, texts, empty):
    enc, _ = byte_bpe.encoding(RANK_FILE, public_tokenizers.PATTERN)
    got = by_id(byte_bpe.round_trip(docs, RANK_FILE, public_tokenizers.PATTERN, part_chars=50))
    for d, t in texts.items():
        ids = enc.encode_ordinary(t.decode())
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()), sha(t))
    raw = by_id(byte_bpe.decode(byte_bpe.encode(docs, RANK_FILE, public_tokenizers.PATTERN), RANK_FILE, public_tokenizers.PATTERN))
    assert {d: bytes(r.bytes) for d, r in raw.items()} == texts
    assert byte_bpe.round_trip(empty, RANK_FILE, public_tokenizers.PATTERN).count() == 0


def test_embedding_groups(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 16))
    near = np.repeat(base, 4, axis=0) + rng.normal(scale=0.05, size=(120, 16))
    rows = [(i, [float(x) for x in v], i % 2 if i % 5 else None) for i, v in enumerate([*base, *near])]
    copy = rows[1][1]
    rows += [(200 + i, copy, 1) for i in range(12)] + [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [None] * 16, 0), (304, [1.0, 2.0], 1)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, cell string").repartition(4)
    got = {r.vec_id: tuple(r)[1:] for r in embedding_dedup.embedding_groups(table, cell_rows=4, slice_rows=3).collect()}
    held = {i: np.array(v, np.float32).astype(float) for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: lab for i, _, lab in rows}

    def cosine(a, b):
        return len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98

    links = [(a, b) for a in held for b in held if a < b and label[a] == label[b] and cosine(held[a], held[b])]
    root, n = closure([r[0] for r in rows], links), collections.Counter(x for p in links for x in p)
    assert len(links) > 60
    assert got == {i: (n[i], root[i], root[i] == i) for i, _, _ in rows}
    assert embedding_dedup.embedding_groups(table.where("false")).count() == 0


def test_embedding_search_holds_bounded_pieces(spark):
    import tracemalloc

    rng = np.random.default_rng(6)
    half, codes = rng.normal(size=(4_000, 32)), rng.normal(size=(100, 32))
    tracemalloc.start()
    near, bounds = embedding_dedup.plane_bounds(half, codes)
    assert tracemalloc.get_traced_memory()[1] < 40e6  # all differences of codes at once are 102 MB
    tracemalloc.stop()
    square = ((half[:5, None] - codes[None]) ** 2).sum(2)
    for row, own, told in zip(square, near, bounds):
        gap = np.sqrt(((codes[own] - codes) ** 2).sum(1))
        assert np.allclose(np.sqrt(told), np.where(gap > 0, (row - row[own]) / np.maximum(2 * gap, 1e-12), 0))
    pieces = list(embedding_dedup.visited(bounds[:50, :6], bounds[:50, 6:12], 6, 1e9, most=100))
    assert [len(c) for _, c in pieces] == [100] * 18 and sorted(zip(sum((a.to_pylist() for a, _ in pieces), []), np.concatenate([c for _, c in pieces]))) == [(i, c) for i in range(50) for c in range(36)]
    # cells whose visitors are dealt to more chunks than their rows to slices
    vectors = np.repeat(rng.normal(size=(30, 8)), 8, axis=0) + rng.normal(size=(240, 8)) * 0.03
    table = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, label long, embedding array<double>")
    few, plain = (embedding_dedup.embedding_groups(table, cell_rows=4, slice_rows=n).orderBy("vec_id").collect() for n in (2, 2_000))
    assert few == plain and max(r.n_links for r in plain) > 1


def test_embedding_groups_of_several_lengths(spark):
    """A longer stray vector leaves the links of the others; each length links by itself."""
    rng = np.random.default_rng(4)
    rows = []
    for size, n in ((16, 60), (12, 40), (2, 12), (1, 12)):
        base = rng.normal(size=(n, size))
        rows += [[float(x) for x in v] for v in [*base, *(base + rng.normal(scale=0.02, size=base.shape))]]
    rows += [[1.0] * 17, rows[0] + [0.0]]  # the second is as near as can be, but longer
    table = spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int").repartition(4)
    held = [np.array(v) for v in rows]

    def linked(a, b):
        x, y = held[a], held[b]
        return a % 2 == b % 2 and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98

    links = [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if linked(a, b)]
    root, n = closure(range(len(rows)), links), collections.Counter(x for p in links for x in p)
    assert {len(rows[a]) for a, _ in links} == {16, 12, 2, 1}
    for rows_a_cell, sample in ((4, 20_000), (2, 64), (64, 20_000)):
        got = {r.vec_id: tuple(r)[1:] for r in embedding_dedup.embedding_groups(table, cell_rows=rows_a_cell, sample=sample, slice_rows=5).collect()}
        assert got == {i: (n[i], root[i], root[i] == i) for i in range(len(rows))}


def test_token_counts(docs, texts, empty):
    file = public_tokenizers.path("piece_bpe_32k.model")
    scores = token_counts.zipf_scores(file)
    low = min(scores.values()) - 5.0

    def cut(word):
        text = token_counts.MARK + word.decode()
        best = [(0.0, 0)]
        for end in range(1, len(text) + 1):
            size = len(text[end - 1].encode())
            ways = [(best[end - 1][0] + size * low, -(best[end - 1][1] + size))]
            ways += [(best[a][0] + scores[text[a:end]], -(best[a][1] + 1)) for a in range(end) if text[a:end] in scores]
            score, count = max(ways)
            best.append((score, -count))
        return best[-1]

    got = by_id(token_counts.token_counts(docs, file))
    for d, t in texts.items():
        if len(t) < 5_000:
            ways = [cut(w) for w in t.split()]
            assert (got[d].n_pretokens, got[d].n_tokens) == (len(ways), sum(n for _, n in ways))
            assert math.isclose(got[d].log_prob, sum(s for s, _ in ways), rel_tol=1e-9, abs_tol=1e-9)
    assert token_counts.token_counts(empty, file).count() == 0


def test_trie_forgets_and_still_counts_right():
    scores = {"▁": -3.0, "a": -1.0, "b": -2.0, "ab": -2.5, "▁a": -1.5}
    small, large = token_counts.Trie(scores, most_nodes=8), token_counts.Trie(scores)
    for words in ([b"ab", b"abab"], [b"bbbbbb"], [b"ab"]):
        small.insert_all(words)
        large.insert_all(words)
        assert {w: small.n_tokens[w] for w in words} == {w: large.n_tokens[w] for w in words}


def test_long_texts_and_words_count_like_their_parts(spark):
    """A text of 2 MB, among words of which one has 3,000 letters, holds what its words hold."""
    file = public_tokenizers.path("piece_bpe_32k.model")
    rng = np.random.default_rng(8)
    parts = ["".join(rng.choice(list("abcdeé日"), rng.integers(1, 9))) for _ in range(4_000)] + ["ab" * 1_500]
    rows = [(i, p) for i, p in enumerate(parts)] + [(-1, " ".join(parts * 60))]
    got = by_id(token_counts.token_counts(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), file))
    whole = got.pop(-1)
    assert whole.n_pretokens == 60 * len(parts)
    assert whole.n_tokens == 60 * sum(r.n_tokens for r in got.values())
    assert math.isclose(whole.log_prob, 60 * math.fsum(r.log_prob for r in got.values()), rel_tol=1e-9)


def test_quality_scores(spark, sf):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    odd = spark.createDataFrame([(-1, None, "xx"), (-2, "", "xx"), (None, "junk | junk |", "xx")], "doc_id long, text string, features string")
    got = quality.quality_scores(docs.select("doc_id", "text").unionByName(odd, allowMissingColumns=True), labels).toPandas()
    assert got.score.between(0, 1).all() and len(got) == docs.count() + 3
    assert got[got.doc_id == -1].score.item() == got[got.doc_id == -2].score.item()
    seen = got.merge(labels.toPandas(), on="doc_id")
    assert (seen.held_out == [zlib.crc32(str(int(d)).encode()) % 3 == 1 for d in seen.doc_id]).all()
    held = seen[seen.held_out]
    pos, neg = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (pos[:, None] > neg[None]).mean() > 0.95
    assert (held.predicted == held.quality).mean() > 0.9


def test_quality_without_labels_or_rows(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.quality_scores(docs, none).collect()} == {0.5}
    assert quality.quality_scores(empty, none).count() == 0


def test_quality_fit_ends_at_the_least_risk(spark, sf):
    """The risk never rises, and no plain descent from the weights found lowers it."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.feature_table(docs).toPandas().merge(labels.toPandas(), on="doc_id", how="left")
    x = np.stack(rows.features.to_numpy()).astype(float)
    positives = x[(rows.quality == 1).to_numpy()]
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "doc_id long, features array<float>").repartition(3)
    model = quality.fit(table, positives, 0.8, rounds=60)
    assert all(b < a for a, b in zip(model.risks, model.risks[1:])) and len(model.risks) > 3

    every, own = (x - model.mean) / model.scale, (positives - model.mean) / model.scale

    def risk(w):
        unlabelled, trusted = np.logaddexp(0, every @ w).mean(), np.logaddexp(0, own @ w).mean()
        return 0.8 * np.logaddexp(0, -own @ w).mean() + max(0, unlabelled - 0.8 * trusted) + 5e-4 * w @ w

    assert math.isclose(risk(model.weights), model.risks[-1], rel_tol=1e-4)
    least, w, rng = risk(model.weights), model.weights, np.random.default_rng(0)
    for _ in range(3_000):  # plain random descent
        step = w + rng.normal(size=len(w)) * rng.choice([0.003, 0.03, 0.3])
        if risk(step) < least:
            least, w = risk(step), step
    assert least > 0.9 * model.risks[-1]
    # as good as always saying 1, at least
    scores = model.score(x)
    known = rows.quality.notna().to_numpy()
    assert ((scores >= 0.5) == (rows.quality == 1).to_numpy())[known].mean() >= (rows.quality == 1)[known].mean()
