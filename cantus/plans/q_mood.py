"""Mood distribution, calibration and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import MOODS
from ..functions.rules import CALM_LYRICS_WEIGHT, CALM_TERMS, calm_signal
from ..operators import evaluate as E
from ..operators import mood as M
from . import standins as S
from .registry import load, query, rnd, rounded

PROBA = [f"proba_{m}" for m in MOODS]


def sig(e: str) -> str:
    return f"(1 / (1 + exp(-least(greatest({e}, -20), 20))))"


def calm_sql(lyrics: str | None = None) -> str:
    terms = [f"{w} * {sig(f'{slope} * ({sign} * {c} - {shift})')}" for c, (sign, shift, slope, w) in CALM_TERMS.items()]
    if lyrics:
        terms.append(f"{CALM_LYRICS_WEIGHT} * least(greatest(coalesce({lyrics}, 0), 0), 1)")
    return f"least(greatest({' + '.join(terms)}, 0), 1)"


def argmax_sql(cols: dict[str, str]) -> str:
    names = list(cols)
    whens = []
    for i, n in enumerate(names[:-1]):
        cond = " AND ".join(f"{cols[n]} >= {cols[x]}" for x in names[i + 1 :])
        whens.append(f"WHEN {cond} THEN '{n}'")
    return f"CASE {' '.join(whens)} ELSE '{names[-1]}' END"


# lyrics rates of a track: a fixed function of its part number
RATES = {"lyrics_sad_lexicon_rate": "part_id % 7 / 50.0", "lyrics_happy_lexicon_rate": "part_id % 5 / 40.0",
         "lyrics_energetic_lexicon_rate": "part_id % 3 / 60.0", "lyrics_calm_lexicon_rate": "part_id % 11 / 70.0"}


def with_rates(spark, sf):
    t = S.modelled(spark, sf)
    return t.selectExpr("*", *[f"CAST({e.split('/')[0]} AS DOUBLE) / {e.split('/')[1].strip()}D AS {c}" for c, e in RATES.items()])


def mood_cte() -> str:
    """CTEs ending in ``mood``: the whole classification chain."""
    raw = {m: f"({RATES[f'lyrics_{m}_lexicon_rate']} + 0.001)" for m in MOODS}
    total = " + ".join(raw.values())
    audio = argmax_sql({m: f"m_{m}" for m in MOODS})
    lyr = argmax_sql({m: f"lyrics_proba_{m}" for m in MOODS})
    mixed = {m: f"(0.65 * m_{m} + 0.35 * lyrics_proba_{m})" for m in MOODS}
    mix_total = " + ".join(mixed.values())
    lifted = {m: (f"greatest(f_{m}, calm_signal)" if m == "calm" else f"f_{m}") for m in MOODS}
    lift_total = " + ".join(lifted.values())
    final = argmax_sql({m: f"proba_{m}" for m in MOODS})
    return f"""tracks AS ({S.TRACKS_SQL}), modelled AS ({S.modelled_sql()}),
      lyr AS (SELECT *, {', '.join(f"CAST({e} / ({total}) AS DOUBLE) AS lyrics_proba_{m}" for m, e in raw.items())} FROM modelled),
      fused AS (SELECT *, {audio} AS audio_predicted_mood, {lyr} AS lyrics_predicted_mood, {', '.join(f"{e} / ({mix_total}) AS f_{m}" for m, e in mixed.items())} FROM lyr),
      sig AS (SELECT *, {calm_sql('lyrics_proba_calm')} AS calm_signal FROM fused),
      cal AS (SELECT *, f_calm AS model_proba_calm, {', '.join(f"{e} / ({lift_total}) AS proba_{m}" for m, e in lifted.items())} FROM sig),
      mood AS (SELECT *, {final} AS predicted_mood, greatest({', '.join(PROBA)}) AS mood_confidence, audio_predicted_mood <> lyrics_predicted_mood AS mood_contrast FROM cal)"""


_NUMS = [*PROBA, "calm_signal", "model_proba_calm", "mood_confidence"]


def classified(spark, sf):
    return M.classify(with_rates(spark, sf), S.MODEL_COLUMNS)


@query(
    "mood_classification",
    f"WITH {mood_cte()} SELECT track_id, audio_predicted_mood, lyrics_predicted_mood, mood_contrast, predicted_mood, "
    f"CASE predicted_mood WHEN 'sad' THEN 0 WHEN 'happy' THEN 1 WHEN 'energetic' THEN 2 ELSE 3 END AS predicted_mood_label, {', '.join(rnd(c, c) for c in _NUMS)} FROM mood",
)
def mood_classification(spark, sf):
    out = classified(spark, sf).select("track_id", "audio_predicted_mood", "lyrics_predicted_mood", "mood_contrast", "predicted_mood", "predicted_mood_label", *_NUMS)
    return rounded(out, _NUMS)


@query("calm_signal", f"WITH tracks AS ({S.TRACKS_SQL}), modelled AS ({S.modelled_sql()}) SELECT track_id, round({calm_sql()}, 6) AS calm FROM modelled")
def calm_signal_query(spark, sf):
    t = S.modelled(spark, sf)
    return rounded(t.select("track_id", calm_signal(t.columns).alias("calm")), ["calm"])


# --- evaluation over a made-up prediction column: one row per line item ---------------------------------
PRED = {
    "row_id": "l_orderkey * 10000000 + l_partkey",
    "real": "CAST(l_suppkey % 4 AS INT)",
    "pred": "CAST(CASE WHEN l_linenumber < 5 THEN l_suppkey % 4 ELSE l_partkey % 4 END AS INT)",
    "s0": "CASE WHEN l_suppkey % 4 = 0 THEN l_discount * 6 ELSE l_tax * 5 END",
    "s1": "CASE WHEN l_suppkey % 4 = 1 THEN l_quantity / 50 ELSE l_discount * 4 END",
    "s2": "l_tax * 10",
    "s3": "l_extendedprice / 110000",
    "y": "l_extendedprice / 1000",
    "yhat": "l_quantity * 2",
}
PRED_SQL = S.view_sql(PRED, "lineitem")
LABELS = [0, 1, 2, 3]


def predictions(spark, sf):
    return S.view(spark, sf, PRED, "lineitem")


@query(
    "confusion_matrix",
    f"SELECT real, {', '.join(f'count(*) FILTER (pred = {x}) AS pred_{x}' for x in LABELS)} FROM ({PRED_SQL}) p GROUP BY real",
)
def confusion_matrix(spark, sf):
    return E.confusion_matrix(predictions(spark, sf), "real", "pred", LABELS)


_REPORT = " UNION ALL ".join(
    f"""SELECT {x} AS label, coalesce(count(*) FILTER (real = {x} AND pred = {x}) / CAST(nullif(count(*) FILTER (pred = {x}), 0) AS DOUBLE), 0) AS precision,
      coalesce(count(*) FILTER (real = {x} AND pred = {x}) / CAST(nullif(count(*) FILTER (real = {x}), 0) AS DOUBLE), 0) AS recall,
      coalesce(2.0 * count(*) FILTER (real = {x} AND pred = {x}) / nullif(count(*) FILTER (real = {x}) + count(*) FILTER (pred = {x}), 0), 0) AS f1,
      count(*) FILTER (real = {x}) AS support, count(*) FILTER (real = {x} AND pred = {x}) AS tp FROM ({PRED_SQL}) p"""
    for x in LABELS
)


@query("class_report", f"SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support, tp FROM ({_REPORT}) r")
def class_report(spark, sf):
    out = rounded(E.class_report(predictions(spark, sf), "real", "pred", LABELS), ["precision", "recall", "f1"])
    return out.withColumns({"support": F.col("support").cast("bigint"), "tp": F.col("tp").cast("bigint")})


@query(
    "summary_report",
    f"""SELECT round(sum(tp) / CAST(sum(support) AS DOUBLE), 6) AS accuracy, round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
      {', '.join(f"round(sum({m} * support) / sum(support), 6) AS weighted_{m}" for m in ("precision", "recall", "f1"))} FROM ({_REPORT}) r""",
)
def summary_report(spark, sf):
    out = E.summary_report(predictions(spark, sf), "real", "pred", LABELS)
    return rounded(out, out.columns)


def _regression_sql(real: str, pred: str) -> str:
    return (
        f"SELECT round(avg(abs({real} - {pred})), 6) AS mae, round(avg(({real} - {pred}) ** 2), 6) AS mse, round(sqrt(avg(({real} - {pred}) ** 2)), 6) AS rmse, "
        f"round(1 - avg(({real} - {pred}) ** 2) / var_pop({real}), 6) AS r2 FROM ({PRED_SQL}) p"
    )


@query("label_code_errors", _regression_sql("real", "pred"))
def label_code_errors(spark, sf):
    out = E.regression_report(predictions(spark, sf), "real", "pred")
    return rounded(out, out.columns)


@query("regression_report", _regression_sql("y", "least(greatest(yhat, 10), 80)"))
def regression_report(spark, sf):
    out = E.regression_report(predictions(spark, sf), "y", "yhat", (10, 80))
    return rounded(out, out.columns)


_AUC = " UNION ALL ".join(
    f"""SELECT {x} AS label, (sum(CASE WHEN real = {x} THEN rk END) - count(*) FILTER (real = {x}) * (count(*) FILTER (real = {x}) + 1) / 2.0)
      / (CAST(count(*) FILTER (real = {x}) AS DOUBLE) * count(*) FILTER (real <> {x})) AS auc FROM
      (SELECT real, rank() OVER (ORDER BY s{x}) + (count(*) OVER (PARTITION BY s{x}) - 1) / 2.0 AS rk FROM ({PRED_SQL}) p) t"""
    for x in LABELS
)
SCORES = {x: f"s{x}" for x in LABELS}


@query("class_auc", f"SELECT label, round(auc, 6) AS auc FROM ({_AUC}) a")
def class_auc(spark, sf):
    return rounded(E.class_auc(predictions(spark, sf), "real", SCORES), ["auc"])


@query("macro_auc", f"SELECT round(avg(auc), 6) AS roc_auc FROM ({_AUC}) a")
def macro_auc(spark, sf):
    return rounded(E.macro_auc(predictions(spark, sf), "real", SCORES), ["roc_auc"])


_NAME = "CASE {c} WHEN 0 THEN 'sad' WHEN 1 THEN 'happy' WHEN 2 THEN 'energetic' WHEN 3 THEN 'calm' END"


@query(
    "prediction_table",
    f"""SELECT row_id, 'm' AS model, real AS real_label, {_NAME.format(c='real')} AS real_mood, pred AS predicted_label, {_NAME.format(c='pred')} AS predicted_mood, real = pred AS is_correct,
      {', '.join(f'round(s{i}, 6) AS proba_{m}' for i, m in enumerate(MOODS))}, round(greatest(s0, s1, s2, s3), 6) AS prediction_confidence FROM ({PRED_SQL}) p""",
)
def prediction_table(spark, sf):
    out = E.prediction_table(predictions(spark, sf), "m", "real", "pred", {m: f"s{i}" for i, m in enumerate(MOODS)}, "row_id")
    return rounded(out, [*PROBA, "prediction_confidence"])


@query(
    "residuals",
    f"SELECT row_id, 'a' AS model, round(y, 6) AS y_true, round(yhat, 6) AS y_pred, round(y - yhat, 6) AS residual FROM ({PRED_SQL}) p "
    f"UNION ALL SELECT row_id, 'b', round(y, 6), round(yhat + 1, 6), round(y - yhat - 1, 6) FROM ({PRED_SQL}) p",
)
def residuals(spark, sf):
    p = predictions(spark, sf)
    out = E.residuals({"a": p, "b": p.withColumn("yhat", F.col("yhat") + 1)}, "y", "yhat", ["row_id"])
    return rounded(out, ["y_true", "y_pred", "residual"])


@query(
    "best_model",
    f"""SELECT model, round(rmse, 6) AS rmse FROM (SELECT 'a' AS model, sqrt(avg((y - yhat) ** 2)) AS rmse FROM ({PRED_SQL}) p
      UNION ALL SELECT 'b', sqrt(avg((y - yhat - 1) ** 2)) FROM ({PRED_SQL}) p) m ORDER BY rmse LIMIT 1""",
)
def best_model(spark, sf):
    p = predictions(spark, sf)
    a = E.regression_report(p, "y", "yhat").withColumn("model", F.lit("a"))
    b = E.regression_report(p.withColumn("yhat", F.col("yhat") + 1), "y", "yhat").withColumn("model", F.lit("b"))
    return rounded(E.best_model(a.unionByName(b)).select("model", "rmse"), ["rmse"])


@query(
    "argmax_group",
    "SELECT max_by(l_returnflag, v) AS best_model, round(max(v), 6) AS macro_f1 FROM (SELECT l_returnflag, avg(l_discount) AS v FROM lineitem GROUP BY 1) t",
)
def argmax_group(spark, sf):
    m = load(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("model")).agg(F.avg("l_discount").alias("macro_f1"))
    return rounded(E.argmax_model(m, "macro_f1"), ["macro_f1"])
