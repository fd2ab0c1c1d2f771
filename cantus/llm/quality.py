"""Quality classifier by positive-unlabelled learning.

A linear model on features of the text's form, fitted to the non-negative unbiased risk: trusted
positives (label 1) against all documents as unlabelled text, with an estimated class prior.  The
unlabelled part of risk, gradient and curvature is summed by Spark over the features of all
documents in every round; only sums of fixed size reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_class, hash_sample, id_and_text, slices, written

_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?'\"-()", b"!", b"|", b"#$%&*+/<=>@[\\]^_`{}~")
_TABLE = np.full(256, len(_CLASSES), np.uint8)
for _i, _own in enumerate(_CLASSES):
    _TABLE[np.frombuffer(_own, np.uint8)] = _i
_LONG_LINE = 20
N_FEATURES = 3 * len(_CLASSES) + 8


def _rates(count, size):
    return count / max(size, 1)


def features(text: bytes) -> np.ndarray:
    """Shares of character classes (whole text, worst line) and of repeats, each between 0 and 1.

    Bounded, so that no odd text can outweigh others; no words as such, and nothing of the length.
    """
    out = np.zeros(N_FEATURES, np.float32)
    out[0] = 1
    words = text.split()
    if not words:
        return out
    codes = _TABLE[np.frombuffer(text, np.uint8)]
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
    starts = np.concatenate([[0], ends + 1])
    starts = starts[starts < len(text)]
    sizes = np.diff(np.append(starts, len(text)))
    long = sizes >= min(_LONG_LINE, int(sizes.max()))
    k = len(_CLASSES)
    for c in range(k):
        per_line = np.add.reduceat((codes == c).astype(np.int32), starts)
        share = _rates(per_line.sum(), len(text))
        worst = (per_line[long] / sizes[long]).max()
        out[1 + c] = min(1, 4 * share)
        out[1 + k + c] = worst
        out[1 + 2 * k + c] = min(1, 8 * worst)
    at = 1 + 3 * k
    again = sum(map(eq, words, words[1:]))
    lower = text.lower().split()
    lines = text.split(b"\n")
    run = best = 0
    if again:
        for same in map(eq, words, words[1:]):
            run = run + 1 if same else 0
            best = max(best, run)
    out[at : at + 7] = (
        _rates(again, len(words)), min(1, 4 * again / len(words)), best >= 2, best >= 3, best >= 4,
        len(set(lower)) / len(lower), 1 - len(set(lines)) / len(lines),
    )
    return out


@dataclass
class Model:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    prior: float
    risks: list[float] = field(default_factory=list)  # of the fit, by round; the last is that of the weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale @ self.weights, -700, 700)
        return 1 / (1 + np.exp(-z))


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches):
        for rows in slices(batches):
            vec = np.stack([features(t) for t in rows.column(1).to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, vec.size + 1, N_FEATURES), pa.int32()), pa.array(vec.ravel()))
            yield pa.RecordBatch.from_arrays([rows.column(0), lists], ["doc_id", "features"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, features array<float>")


def _matrix(rows) -> np.ndarray:
    return pa.chunked_array([rows.column("features")] if isinstance(rows, pa.RecordBatch) else rows["features"].chunks).combine_chunks().flatten().to_numpy().reshape(-1, N_FEATURES).astype(float)


def summed(table: DataFrame, part, size: int) -> np.ndarray:
    """Sum over all rows of ``part(matrix)``, a vector of ``size`` numbers; in two steps, so the
    driver gets at most 32 vectors however many tasks there are."""

    def local(batches):
        total = np.zeros(size)
        for rows in batches:
            if rows.num_rows:
                total += part(_matrix(rows))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 32]), pa.array([total.tolist()])], ["node", "sums"])

    def add(rows: pa.Table) -> pa.Table:
        return pa.table({"sums": pa.array([np.sum(rows["sums"].to_pylist(), axis=0).tolist()])})

    parts = table.select("features").mapInArrow(local, "node long, sums array<double>")
    got = parts.groupBy("node").applyInArrow(add, "sums array<double>").collect()
    return np.sum([r.sums for r in got], axis=0) if got else np.zeros(size)


def _log_loss(z):
    return np.logaddexp(0, z)  # loss of predicting "positive" for a negative


_SOFT, _STEPS = (1.0, 0.1, 0.01, 0.001, 0.0001), tuple(0.5**i for i in range(9))


def _shares(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def fit(table: DataFrame, positives: np.ndarray, prior: float, ridge: float = 1e-3, rounds: int = 20, tolerance: float = 1e-6) -> Model:
    """Least prior * P[l(g)] + max(0, U[l(-g)] - prior * P[l(-g)]) + ridge / 2 |w|^2, with the logistic loss l.

    With that loss the risk is the larger of two convex functions: the first term alone, and the
    unbiased risk.  A round takes slope and curvature of both and tries Newton steps of their soft
    maximum, from soft to hard (at the kink neither function alone leads down), at several lengths,
    all in one pass.  The best one is taken if it lowers the risk by more than ``tolerance`` of
    itself; else the fit is done.  So the risk never rises; ``Model.risks`` has it by round.
    """
    d = N_FEATURES
    moments = summed(table, lambda x: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)]), 1 + 2 * d)
    n = max(moments[0], 1)
    mean = moments[1 : 1 + d] / n
    scale = np.sqrt(np.maximum(moments[1 + d :] / n - mean**2, 0))
    mean[0], scale[scale < 1e-6] = 0, 1
    weights, risks = np.zeros(d), []
    if len(positives) and moments[0]:
        own = (positives - mean) / scale

        def risk(w: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Per column of ``w``, from the mean unlabelled losses; and how far the unbiased risk exceeds the first term."""
            z = own @ w
            more = unlabelled - prior * _log_loss(z).mean(0)
            return prior * _log_loss(-z).mean(0) + np.maximum(0, more) + ridge / 2 * (w**2).sum(0), more

        def losses(w: np.ndarray) -> np.ndarray:
            return summed(table, lambda x: _log_loss((x - mean) / scale @ w).sum(0), w.shape[1]) / n

        found, gaps = risk(weights[:, None], np.array([np.log(2)]))
        risks, gap = [float(found[0])], float(gaps[0])
        for _ in range(rounds):

            def slopes(x, w=weights):
                x = (x - mean) / scale
                p = _shares(x @ w)
                return np.concatenate([x.T @ p, (x.T @ (x * (p * (1 - p))[:, None])).ravel()])

            sums = summed(table, slopes, d + d * d) / n
            p = _shares(own @ weights)
            first = prior * (own * (p - 1)[:, None]).mean(0) + ridge * weights
            unbiased = sums[:d] - prior * own.mean(0) + ridge * weights
            curve_first = prior * own.T @ (own * (p * (1 - p))[:, None]) / len(own)
            curve = sums[d:].reshape(d, d)
            tried = []
            for soft in _SOFT:
                mix = float(_shares(-gap / soft))  # the first function's part in the soft maximum
                bend = mix * (1 - mix) / soft * np.outer(first - unbiased, first - unbiased)
                step = np.linalg.solve(mix * curve_first + (1 - mix) * curve + bend + (ridge + 1e-6) * np.eye(d), mix * first + (1 - mix) * unbiased)
                step *= min(1.0, 8.0 / max(np.abs(step).max(), 1e-12))
                tried += [weights - t * step for t in _STEPS]
            tried = np.array(tried).T
            found, gaps = risk(tried, losses(tried))
            best = int(found.argmin())
            if not found[best] < risks[-1] * (1 - tolerance):
                break
            weights = tried[:, best]
            risks.append(float(found[best]))
            gap = float(gaps[best])
    return Model(weights, mean, scale, prior, risks)


def train(
    table: DataFrame, labels: DataFrame, parts: int = 3, held_out: int = 1, max_positives: int = 50_000,
    id_col: str = "doc_id", label_col: str = "quality",
) -> Model:
    """A model from the labels of rows whose crc32 class is not ``held_out``.

    ``max_positives`` bounds the trusted positives used (a hash sample of labelled rows); the
    unlabelled side is every document.  The prior is the share of ones among the labels it may learn
    from (0.5 without any).  Ids with differing labels or a null one are not trusted.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & (crc_class("doc_id", parts) != held_out))
    known = known.groupBy("doc_id").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low = high")
    ones, n = known.agg(F.coalesce(F.sum(F.col("high")), F.lit(0)), F.count("*")).first()
    prior = float(np.clip(ones / n, 0.01, 0.99)) if n else 0.5
    trusted = table.join(known.where("high = 1").select("doc_id"), "doc_id", "left_semi")
    rows = hash_sample(trusted, "doc_id", ones, max_positives).toArrow()
    positives = _matrix(rows) if rows.num_rows else np.empty((0, N_FEATURES))
    return fit(table, positives, prior)


def quality_scores(docs: DataFrame, labels: DataFrame, parts: int = 3, held_out: int = 1, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, held_out, score, predicted``: one row per row of ``docs``.

    Null and empty texts share one score.  Labels are only used for the fit, and only those outside
    the held-out class; a null id counts as the empty text there.  Repeated rows get equal scores;
    extra columns are ignored; an empty table gives no rows, and without labels every score is 0.5.
    """
    table = written(feature_table(docs, id_col, text_col), "features")
    model = train(table, labels, parts, held_out, **options)

    def run(batches):
        for rows in batches:
            if rows.num_rows:
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(model.score(_matrix(rows)))], ["doc_id", "score"])

    scored = table.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (crc_class("doc_id", parts) == held_out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``; all columns as they are."""
    model = train(written(feature_table(docs, id_col, text_col), "features"), labels, **options)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([float(s) for t in texts for s in model.score(features(bytes(t))[None].astype(float))])

    return docs.where(score(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")) >= threshold)
