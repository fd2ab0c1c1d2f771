"""Language-model scores by deleted interpolation.

A word's probability is a mixture of a uniform, a unigram and a bigram estimate, each by maximum
likelihood.  The weights depend on how often the context was seen (one set per frequency bucket).
They are learned by expectation-maximisation on a part of the training documents that is left out
of the counts meanwhile ("deleted"); the scores then use the counts of the whole training part.

Documents are staged in batches (``batches``); each asks owner tasks for the counts of its distinct
words and word pairs, so the exchange grows with the corpus while frequent words cost one entry per
batch.  EM sees all deleted tokens, merged into cells of nearly equal estimates (``per_octave``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from . import batches as B
from .common import crc_class, written
from .substring_dedup import mixed, word_ids

TRAIN, DELETED, HELD_OUT = 0, 1, 2
_END = b"\n"  # no word holds white space


class Tokens:
    """The tokens of a batch: words in lower case and one end per text, as numbers of distinct ones."""

    def __init__(self, table: pa.Table):
        words, ends = [_END], []  # an end also begins the first text
        for t in table.column("__text").fill_null(b"").to_pylist():
            words += t.lower().split()
            words.append(_END)
            ends.append(len(words) - 1)
        ids, distinct = word_ids(words)
        self.ends = np.array(ends, np.int64)
        hashes = np.array([xxh64_intdigest(w, 42) for w in distinct], np.uint64)
        self.word_keys, rank = np.unique(hashes, return_inverse=True)
        ids = rank[ids]
        self.word = ids[1:]
        with np.errstate(over="ignore"):
            keys = self.word_keys
            pairs = mixed(keys[ids[:-1]] * np.uint64(0xD6E8FEB86659FD93) + mixed(keys[ids[1:]]))
        self.context = ids[:-1]
        self.pair_keys, self.first, self.pair = np.unique(pairs, return_index=True, return_inverse=True)
        self.pair_count = np.bincount(self.pair, minlength=len(self.pair_keys))

    def questions(self, kind: int):
        words = np.bincount(self.word, minlength=len(self.word_keys))
        out = {}
        for group, keys, n in ((0, self.word_keys, words), (1, self.pair_keys, self.pair_count)):
            counts = np.zeros((2, len(keys)), np.uint32)
            if kind != HELD_OUT:
                counts[kind] = n
            out[group] = keys, counts
        return out


def _answer(rows: pa.Table) -> pa.Table:
    """Counts of the training part without and of the deleted part, per asked key; totals at batch -1."""
    keys, place, ends = B.merged(rows)
    blobs = [B.spread(b, np.uint32).reshape(2, -1) for b in rows["counts"].to_pylist()]
    counts = np.concatenate(blobs, axis=1)
    total = np.stack([np.bincount(place, weights=c, minlength=len(keys)) for c in counts]).astype(np.int64)
    codes = [B.squeezed(c) for c in np.split(total[:, place], ends[:-1], axis=1)]
    stats = np.array([total[0].sum(), total[1].sum(), (total[0] > 0).sum(), (total.sum(axis=0) > 0).sum()], np.int64)
    owner = rows["owner"].to_pylist()
    return pa.table({
        "batch_id": pa.array([*rows["batch_id"].to_pylist(), -1], pa.int64()), "owner": pa.array([*owner, owner[0]], pa.int64()),
        "codes": pa.array([*codes, None], pa.binary()), "stats": pa.array([*[None] * len(codes), stats.tolist()], pa.list_(pa.int64())),
    })


def _counts(answers: pa.Table, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """(2, words) and (2, pairs): a batch's counts in the order of its keys."""
    order = np.argsort(answers["owner"].to_numpy(), kind="stable")
    blobs, owner = answers["codes"].to_pylist(), answers["owner"].to_numpy()
    groups: tuple[list, list] = [np.empty((2, 0), np.int64)], [np.empty((2, 0), np.int64)]
    for i in order:
        groups[owner[i] // owners].append(B.spread(blobs[i], np.int64).reshape(2, -1))
    return np.concatenate(groups[0], axis=1), np.concatenate(groups[1], axis=1)


def bucket_of(count: np.ndarray) -> np.ndarray:
    """Frequency bucket of a context: 0 for unseen, then powers of two."""
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))) + 1, 0).astype(np.int64)


def estimates(tokens: Tokens, words: np.ndarray, pairs: np.ndarray, total: int, vocabulary: int):
    """Per distinct pair of a batch: bucket of its context, and the three estimates of its word."""
    context, word = tokens.context[tokens.first], tokens.word[tokens.first]
    n_context = words[context]
    uniform = np.full(len(word), 1.0 / (vocabulary + 1))
    unigram = words[word] / max(total, 1)
    bigram = pairs / np.maximum(n_context, 1)
    return bucket_of(n_context), np.stack([uniform, unigram, bigram])


def learn_weights(cells: list, rounds: int = 50) -> dict[int, np.ndarray]:
    """EM: (bucket, tokens, mean uniform, unigram and bigram estimate) of every cell -> weights.

    An empty bucket has no entry; the caller uses ``DEFAULT``.
    """
    by: dict[int, list] = {}
    for bucket, n, *p in cells:
        by.setdefault(bucket, []).append((n, *p))
    out = {}
    for bucket, own in by.items():
        data = np.array(own, float)
        n, p = data[:, 0], data[:, 1:]
        weight = np.array([0.2, 0.4, 0.4])
        for _ in range(rounds):
            share = weight * p
            weight = (n[:, None] * share / share.sum(axis=1, keepdims=True)).sum(axis=0) + 1e-3
            weight /= weight.sum()
        out[bucket] = weight
    return out


DEFAULT = np.array([0.2, 0.6, 0.2])


def lm_scores(
    docs: DataFrame,
    parts: int = 7,
    held_out: int = 2,
    deleted: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = 6 << 20,
    bytes_per_owner: int = 8 << 20,
    per_octave: int = 4,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: one row per row.

    A document is held out if the crc32 of its id modulo ``parts`` is ``held_out``; those with
    ``deleted`` are training documents on which the weights are learned.  Null and empty texts are
    their end token; a null id counts as the empty text for the split.  Repeated rows count and
    score each; extra columns are ignored; an empty table gives no rows.  Without deleted documents
    fixed weights are used, so small inputs still score.
    """
    cols = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    part = crc_class("doc_id", parts)
    kind = F.when(part == held_out, HELD_OUT).when(part == deleted, DELETED).otherwise(TRAIN)
    staged = B.stage(cols, "text", batch_bytes, kind=kind)
    owners = B.owners_for(staged, bytes_per_owner)
    asked = B.ask(staged, lambda table, k: Tokens(table).questions(k), owners)
    answers = written(asked.groupBy("owner").applyInArrow(_answer, "batch_id long, owner long, codes binary, stats array<long>"), "counts")
    sums = answers.where(f"batch_id = -1 and owner < {owners}").agg(*[F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(4)]).first()
    core_n, deleted_n, core_v, vocabulary = (int(x) for x in sums)
    total = core_n + deleted_n
    replies = answers.where("batch_id >= 0").select("batch_id", "owner", "codes")

    def gather(batch: pa.Table, reply: pa.Table) -> pa.Table:
        out = []
        for r in batch.to_pylist():
            tokens = Tokens(B.opened(r["body"]))
            words, pairs = _counts(reply, owners)
            bucket, p = estimates(tokens, words[0], pairs[0], core_n, core_v)
            n = tokens.pair_count
            grade = np.round(np.log2(np.maximum(p[1:], 1e-12)) * per_octave).astype(np.int64)
            cell, place = np.unique(np.stack([bucket, *grade]), axis=1, return_inverse=True)
            sums = [np.bincount(place.ravel(), weights=n * x, minlength=cell.shape[1]) for x in (1.0, *p)]
            out += zip(*cell.tolist(), *[s.tolist() for s in sums])
        names = ["bucket", "g1", "g2", "n", "p0", "p1", "p2"]
        kinds = [pa.int64()] * 3 + [pa.float64()] * 4
        return pa.table({c: pa.array(v, k) for c, v, k in zip(names, zip(*out) if out else [[]] * 7, kinds)})

    left_out = staged.where(F.col("kind") == DELETED).select("batch_id", "body")
    own = replies.join(left_out.select("batch_id"), "batch_id", "left_semi")
    cells = left_out.groupBy("batch_id").cogroup(own.groupBy("batch_id")).applyInArrow(gather, "bucket long, g1 long, g2 long, n double, p0 double, p1 double, p2 double")
    # at most 64 buckets x (40 octaves x per_octave)^2 cells, whatever the input
    cells = cells.groupBy("bucket", "g1", "g2").agg(*[F.sum(c).alias(c) for c in ("n", "p0", "p1", "p2")])
    weights = learn_weights([(r.bucket, r.n, r.p0 / r.n, r.p1 / r.n, r.p2 / r.n) for r in cells.collect()])
    table = np.stack([weights.get(b, DEFAULT) for b in range(64)])

    def score(batch: pa.Table, reply: pa.Table) -> pa.Table:
        done = []
        for r in batch.to_pylist():
            rows = B.opened(r["body"])
            tokens = Tokens(rows)
            words, pairs = (c.sum(axis=0) for c in _counts(reply, owners))
            bucket, p = estimates(tokens, words, pairs, total, vocabulary)
            log_pair = np.log10((table[bucket].T * p).sum(axis=0))
            log_word = np.log10((words + 1) / (total + vocabulary + 1))
            first = np.concatenate([[0], tokens.ends[:-1]]) if len(tokens.ends) else tokens.ends
            ids = rows.column("c0")
            done.append(pa.table({
                "doc_id": ids, "held_out": pa.array(np.full(len(ids), r["kind"] == HELD_OUT)),
                "n_tokens": np.diff(np.append(first, len(tokens.word))),
                "n_known": np.add.reduceat((words[tokens.word] > 0).astype(np.int64), first),
                "train_tokens": np.full(len(ids), total, np.int64),
                "base_score": np.add.reduceat(log_word[tokens.word], first), "score": np.add.reduceat(log_pair[tokens.pair], first),
            }))
        return pa.concat_tables(done)

    return staged.select("batch_id", "kind", "body").groupBy("batch_id").cogroup(replies.groupBy("batch_id")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
