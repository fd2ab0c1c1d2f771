"""Evaluation metrics as aggregates over a prediction table; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import parse as P
from . import ranking as K


def confusion_long(df: DataFrame, real: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(real).alias("real"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, real: str, predicted: str, labels: list) -> DataFrame:
    """One row per real label, one column per predicted label, in the given order."""
    c = confusion_long(df, real, predicted)
    cells = [F.coalesce(F.sum(F.when(F.col("predicted") == F.lit(x), F.col("n"))), F.lit(0)).alias(f"pred_{x}") for x in labels]
    return c.filter(F.col("real").isin(list(labels))).groupBy("real").agg(*cells)


def class_report(df: DataFrame, real: str, predicted: str, labels: list) -> DataFrame:
    """Precision, recall, F1 and support per label; a zero division is 0."""
    c = confusion_long(df, real, predicted)
    per_label = F.explode(F.array(*[F.lit(x) for x in labels])).alias("label")
    t = c.select("*", per_label)
    is_real, is_pred = F.col("real") == F.col("label"), F.col("predicted") == F.col("label")
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    s = t.groupBy("label").agg(count(is_real & is_pred).alias("tp"), count(is_pred).alias("pp"), count(is_real).alias("support"))
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("pp") + F.col("support")), F.lit(0.0))
    return s.select("label", ratio("tp", "pp").alias("precision"), ratio("tp", "support").alias("recall"), f1.alias("f1"), "support", "tp")


def summary_report(df: DataFrame, real: str, predicted: str, labels: list) -> DataFrame:
    """Accuracy plus macro and weighted averages; one row."""
    r = class_report(df, real, predicted, labels)
    weighted = lambda m: F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support"))
    metrics = ("precision", "recall", "f1")
    return r.agg(
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in metrics],
        *[weighted(m).alias(f"weighted_{m}") for m in metrics],
    )


def regression_report(df: DataFrame, real: str, predicted: str, clip_to: tuple[float, float] | None = None) -> DataFrame:
    """MAE, MSE, RMSE and R2; one pass."""
    y = F.col(real).cast("double")
    p = F.col(predicted).cast("double")
    p = N.clip(p, *clip_to) if clip_to else p
    row = df.select(y.alias("y"), (y - p).alias("e")).agg(
        F.avg(F.abs("e")).alias("mae"), F.avg(F.col("e") * F.col("e")).alias("mse"), F.var_pop("y").alias("_v")
    )
    return row.select("mae", "mse", F.sqrt("mse").alias("rmse"), (1 - F.try_divide(F.col("mse"), F.col("_v"))).alias("r2"))


def class_auc(df: DataFrame, real: str, scores: dict) -> DataFrame:
    """One-vs-rest ROC-AUC per label by rank sum with average ranks.

    Equal scores are counted together before ranking, and ranks come from range-wise running
    totals, so no task sorts the whole table.
    """
    cells = F.array(
        *[F.struct(F.lit(x).alias("label"), F.col(c).cast("double").alias("s"), (F.col(real) == F.lit(x)).cast("int").alias("hit")) for x, c in scores.items()]
    )
    counts = df.select(F.inline(cells)).groupBy("label", "s").agg(F.count("*").alias("n"), F.sum("hit").alias("pos"))
    ranked = K.running_total(counts, ["label"], "s", F.col("n"), to="upto")
    mean_rank = F.col("upto") - F.col("n") + (F.col("n") + 1) / 2.0
    t = ranked.groupBy("label").agg(
        F.sum(F.col("pos") * mean_rank).alias("rank_sum"), F.sum("pos").cast("double").alias("p"), F.sum(F.col("n") - F.col("pos")).cast("double").alias("q")
    )
    auc = F.try_divide(F.col("rank_sum") - F.col("p") * (F.col("p") + 1) / 2.0, F.col("p") * F.col("q"))
    return t.select("label", auc.alias("auc"))


def macro_auc(df: DataFrame, real: str, scores: dict) -> DataFrame:
    """Mean over labels; NULL when a label has no positive or no negative row."""
    defined = F.count("auc") == len(scores)
    return class_auc(df, real, scores).agg(F.when(defined, F.avg("auc")).alias("roc_auc"))


def prediction_table(scored: DataFrame, model: str, real: str, predicted: str, probabilities: dict[str, str], id_column: str | None = None) -> DataFrame:
    """Per-row results: labels, names, correctness, probabilities and confidence."""
    ids = [id_column] if id_column else []
    return scored.select(
        *ids,
        F.lit(model).alias("model"),
        F.col(real).alias("real_label"),
        P.mood_name(F.col(real)).alias("real_mood"),
        F.col(predicted).alias("predicted_label"),
        P.mood_name(F.col(predicted)).alias("predicted_mood"),
        (F.col(real) == F.col(predicted)).alias("is_correct"),
        *[F.col(c).alias(f"proba_{m}") for m, c in probabilities.items()],
        F.greatest(*[F.col(c) for c in probabilities.values()]).alias("prediction_confidence"),
    )


def residuals(frames: dict[str, DataFrame], real: str, predicted: str, ids: list[str]) -> DataFrame:
    out = None
    for model, df in frames.items():
        one = df.select(*ids, F.lit(model).alias("model"), F.col(real).alias("y_true"), F.col(predicted).alias("y_pred"),
                        (F.col(real) - F.col(predicted)).alias("residual"))
        out = one if out is None else out.unionByName(one)
    return out


def best_model(metrics: DataFrame) -> DataFrame:
    """Lowest rmse, then mae, then highest r2."""
    return metrics.orderBy(F.col("rmse").asc(), F.col("mae").asc(), F.col("r2").desc(), F.col("model").asc()).limit(1)


def argmax_model(metrics: DataFrame, metric: str) -> DataFrame:
    return metrics.agg(F.max_by("model", F.struct(F.col(metric), F.col("model"))).alias("best_model"), F.max(metric).alias(metric))
