"""Profiling, quality and drift queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ..operators import profile as A
from ..operators import prepare as R
from ..operators import quantiles as QT
from . import standins as S
from .registry import load, query, rnd, rounded

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CAT = ["l_returnflag", "l_linestatus"]
FEATS = ["danceability", "energy", "valence", "acousticness", "loudness", "tempo"]


def each(names, body, key="feature"):
    """UNION ALL of one SELECT per name; ``{c}`` is the name."""
    return " UNION ALL ".join(body.replace("{c}", c) for c in names)


@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def row_count(spark, sf):
    return A.row_count(load(spark, sf, "lineitem"))


# a table with gaps: some values are missing by rule
GAPS = {
    "o_orderkey": "o_orderkey",
    "status": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END",
    "price": "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_totalprice END",
    "priority": "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderpriority END",
}
GAPS_SQL = S.view_sql(GAPS, "orders")


def gaps(spark, sf):
    return S.view(spark, sf, GAPS, "orders")


_NULLS = each(GAPS, f"SELECT '{{c}}' AS column_name, round(avg(CASE WHEN {{c}} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_ratio FROM ({GAPS_SQL}) g")


@query("null_ratios", _NULLS)
def null_ratios(spark, sf):
    return rounded(A.null_ratios(gaps(spark, sf)), ["null_ratio"])


@query("high_null_columns", f"SELECT * FROM ({_NULLS}) n WHERE null_ratio >= 0.05")
def high_null_columns(spark, sf):
    return rounded(A.high_null_columns(gaps(spark, sf)), ["null_ratio"])


@query("duplicate_count", "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) d) AS BIGINT) AS duplicate_rows FROM lineitem")
def duplicate_count(spark, sf):
    return A.duplicate_count(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "integration_report",
    """SELECT 'lines' AS dataset, count(*) AS rows, 2 AS shared_features,
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_discount FROM lineitem) d) AS duplicate_rows, CAST(NULL AS BIGINT) AS duplicate_ids FROM lineitem
       UNION ALL SELECT 'orders', count(*), 1, count(*) - (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders) d),
         count(*) - (SELECT count(DISTINCT o_custkey) FROM orders) FROM orders""",
)
def integration_report(spark, sf):
    return A.integration_report(
        {
            "lines": (load(spark, sf, "lineitem"), ["l_returnflag", "l_discount"], None),
            "orders": (load(spark, sf, "orders"), ["o_orderstatus"], "o_custkey"),
        }
    )


_CLASS = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"


@query("class_counts", f"SELECT event_type, n, round(CAST(n AS DOUBLE) / (SELECT count(*) FROM events), 6) AS ratio FROM ({_CLASS}) c")
def class_counts(spark, sf):
    return rounded(A.class_counts(load(spark, sf, "events"), "event_type"), ["ratio"])


@query(
    "class_balance",
    f"""WITH r AS (SELECT event_type, CAST(n AS DOUBLE) / (SELECT count(*) FROM events) AS r FROM ({_CLASS}) c),
    s AS (SELECT (SELECT event_type FROM r ORDER BY r DESC, event_type LIMIT 1) AS majority_class,
      (SELECT event_type FROM r ORDER BY r, event_type LIMIT 1) AS minority_class, max(r) AS max_ratio, min(r) AS min_ratio,
      max(r) / greatest(min(r), 1e-12) AS imbalance_ratio, -sum(r * log2(r + 1e-12)) AS entropy, log2(count(*)) AS max_entropy, 1 - sum(r * r) AS gini FROM r)
    SELECT majority_class, minority_class, round(max_ratio, 6) AS max_ratio, round(min_ratio, 6) AS min_ratio, round(imbalance_ratio, 6) AS imbalance_ratio,
      round(entropy, 6) AS entropy, round(max_entropy, 6) AS max_entropy, round(gini, 6) AS gini,
      CASE WHEN imbalance_ratio >= 3 THEN 'high' WHEN imbalance_ratio >= 1.5 THEN 'moderate' ELSE 'balanced' END AS severity FROM s""",
)
def class_balance(spark, sf):
    return rounded(A.class_balance(load(spark, sf, "events"), "event_type"), ["max_ratio", "min_ratio", "entropy", "max_entropy", "gini", "imbalance_ratio"])


@query("label_conflicts", "SELECT count(*) AS conflicts FROM (SELECT l_discount, l_tax, l_quantity FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_returnflag) > 1) c")
def label_conflicts(spark, sf):
    return R.label_conflicts(load(spark, sf, "lineitem"), ["l_discount", "l_tax", "l_quantity"], "l_returnflag").agg(F.count("*").alias("conflicts"))


@query(
    "majority_label",
    """SELECT l_partkey, l_returnflag FROM (SELECT l_partkey, l_returnflag, row_number() OVER (PARTITION BY l_partkey ORDER BY count(*) DESC, l_returnflag) AS rn
       FROM lineitem GROUP BY l_partkey, l_returnflag) t WHERE rn = 1""",
)
def majority_label(spark, sf):
    return R.majority_label(load(spark, sf, "lineitem"), ["l_partkey"], "l_returnflag")


# --- descriptive statistics -------------------------------------------------------------------------
_PCT = {"p01": 0.01, "p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


@query(
    "describe_numeric",
    each(
        NUM,
        "SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min, max({c}) AS max, "
        "(SELECT {c} FROM lineitem GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode, "
        + ", ".join(f"round(quantile_cont({{c}}, {p}), 6) AS {n}" for n, p in _PCT.items())
        + ", round(median({c}), 6) AS median FROM lineitem",
    ),
)
def describe_numeric(spark, sf):
    return rounded(A.describe_numeric(load(spark, sf, "lineitem"), NUM), ["mean", "std", "median", *_PCT])


@query(
    "describe_categorical",
    each(
        ["o_orderstatus", "o_orderpriority"],
        "SELECT '{c}' AS column_name, count({c}) AS count, count(DISTINCT {c}) AS \"unique\", "
        "(SELECT {c} FROM orders GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
        "(SELECT count(*) FROM orders GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq FROM orders",
    ),
)
def describe_categorical(spark, sf):
    out = A.describe_categorical(load(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])
    return out.withColumn("count", F.col("count").cast("bigint"))


@query(
    "dataset_overview",
    each(
        GAPS,
        f"SELECT '{{c}}' AS column_name, '%{{c}}%' AS dtype, count(*) - count({{c}}) AS nulls, round((count(*) - count({{c}})) * 100.0 / count(*), 6) AS null_pct, "
        f"(SELECT CAST({{c}} AS VARCHAR) FROM ({GAPS_SQL}) g ORDER BY o_orderkey LIMIT 1) AS sample, '?{{c}}?' AS description FROM ({GAPS_SQL}) g",
    )
    .replace("%o_orderkey%", "bigint").replace("%status%", "string").replace("%price%", "double").replace("%priority%", "string")
    .replace("?o_orderkey?", "order id").replace("?status?", "(sin descripcion)").replace("?price?", "total").replace("?priority?", "(sin descripcion)"),
)
def dataset_overview(spark, sf):
    return rounded(A.overview(gaps(spark, sf), "o_orderkey", {"o_orderkey": "order id", "price": "total"}), ["null_pct"])


@query(
    "cardinalities",
    "SELECT * FROM (" + each(["c_name", "c_mktsegment", "c_nationkey"], "SELECT '{c}' AS column_name, count(DISTINCT {c}) AS unique_values FROM customer")
    + ") c ORDER BY unique_values DESC, column_name LIMIT 2",
)
def cardinalities(spark, sf):
    return A.cardinalities(load(spark, sf, "customer"), ["c_name", "c_mktsegment", "c_nationkey"], top=2)


SHIFTED = {"a": "l_discount * 12 - 0.1", "b": "l_tax * 10", "c": "l_quantity / 49"}
_SHIFT_SQL = S.view_sql(SHIFTED, "lineitem")


@query(
    "unit_range_report",
    "SELECT * FROM (" + each(
        SHIFTED,
        f"SELECT '{{c}}' AS feature, count(*) FILTER ({{c}} < 0) AS below_0, count(*) FILTER ({{c}} > 1) AS above_1, "
        f"round(count(*) FILTER ({{c}} < 0) * 100.0 / count({{c}}), 6) AS pct_below_0, round(count(*) FILTER ({{c}} > 1) * 100.0 / count({{c}}), 6) AS pct_above_1 FROM ({_SHIFT_SQL}) s",
    ) + ") r WHERE below_0 > 0 OR above_1 > 0",
)
def unit_range_report(spark, sf):
    return rounded(A.unit_range_report(S.view(spark, sf, SHIFTED, "lineitem"), list(SHIFTED)), ["pct_below_0", "pct_above_1"])


@query(
    "skew_outliers",
    each(
        FEATS,
        f"SELECT '{{c}}' AS feature, round(skewness({{c}}), 6) AS skew, round(avg(CASE WHEN {{c}} < q1 - 1.5 * (q3 - q1) OR {{c}} > q3 + 1.5 * (q3 - q1) THEN 1.0 ELSE 0.0 END) * 100, 6) AS outlier_pct, "
        f"round(any_value(q3 - q1), 6) AS iqr FROM ({S.FEATURES_SQL}) f, (SELECT quantile_cont({{c}}, 0.25) AS q1, quantile_cont({{c}}, 0.75) AS q3 FROM ({S.FEATURES_SQL}) g) q",
    ),
)
def skew_outliers(spark, sf):
    return rounded(A.skew_outliers(S.features(spark, sf), FEATS), ["skew", "outlier_pct", "iqr"])


@query(
    "exact_quantiles",
    each(
        ["value", "user_id"],
        " UNION ALL ".join(f"SELECT '{{c}}' AS feature, CAST({p} AS DOUBLE) AS prob, round(quantile_cont({{c}}, {p}), 6) AS q FROM events" for p in (0.0, 0.1, 0.333, 0.9, 1.0)),
    ),
)
def exact_quantiles(spark, sf):
    return rounded(QT.exact(load(spark, sf, "events"), ["value", "user_id"], [0.0, 0.1, 0.333, 0.9, 1.0]), ["q"])


@query("approx_quartiles")
def approx_quartiles(spark, sf):
    return QT.approximate(load(spark, sf, "events"), ["value", "user_id"], [0.25, 0.75])


@query(
    "approx_quantile_ranks",
    each(["value", "user_id"], " UNION ALL ".join(f"SELECT '{{c}}' AS feature, CAST({p} AS DOUBLE) AS prob, count({{c}}) AS n, TRUE AS is_value, TRUE AS within FROM events" for p in (0.05, 0.25, 0.5, 0.75, 0.95))),
)
def approx_quantile_ranks(spark, sf):
    """Every approximate quantile is a value of the column, and its ranks meet the promised 0.1 % around the wanted one."""
    e, probs = load(spark, sf, "events"), [0.05, 0.25, 0.5, 0.75, 0.95]
    return QT.rank_bounds(e, QT.approximate(e, ["value", "user_id"], probs), ["value", "user_id"], probs, 0.001)


@query(
    "eta_squared",
    each(
        FEATS,
        f"""SELECT '{{c}}' AS feature, round((SELECT sum(n * (m - (SELECT avg({{c}}) FROM ({S.FEATURES_SQL}) a)) ** 2) FROM (SELECT label, count(*) AS n, avg({{c}}) AS m FROM ({S.FEATURES_SQL}) f GROUP BY label) g)
        / (SELECT var_pop({{c}}) * count(*) FROM ({S.FEATURES_SQL}) t), 6) AS eta_squared""",
    ),
)
def eta_squared(spark, sf):
    return rounded(A.eta_squared(S.features(spark, sf), FEATS, "label"), ["eta_squared"])


_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS corr FROM ({S.FEATURES_SQL}) f" for a, b in combinations(FEATS, 2)
)


@query("correlations", f"SELECT feature_1, feature_2, round(corr, 6) AS corr FROM ({_PAIRS}) c")
def correlations(spark, sf):
    return rounded(A.correlations(S.features(spark, sf), FEATS), ["corr"])


@query("strong_pairs", f"SELECT feature_1, feature_2, round(abs(corr), 6) AS corr FROM ({_PAIRS}) c WHERE abs(corr) >= 0.6 ORDER BY abs(corr) DESC, feature_1, feature_2 LIMIT 15")
def strong_pairs(spark, sf):
    return rounded(A.strong_pairs(S.features(spark, sf), FEATS), ["corr"])


@query("target_correlations", each(FEATS, f"SELECT '{{c}}' AS feature, round(abs(corr({{c}}, label)), 6) AS abs_corr FROM ({S.FEATURES_SQL}) f"))
def target_correlations(spark, sf):
    return rounded(A.target_correlations(S.features(spark, sf), FEATS, "label"), ["abs_corr"])


_HALF = lambda flag: f"(SELECT * FROM ({S.FEATURES_SQL}) f WHERE {flag})"
_DRIFT = {"base_vs_label1": "label = 1", "base_vs_short": "duration_ms < 100000"}


@query(
    "cohen_d",
    " UNION ALL ".join(
        each(
            FEATS,
            f"""SELECT '{{c}}' AS feature, '{name}' AS comparison, round((a.m - b.m) / nullif(sqrt((a.v + b.v) / 2), 0), 6) AS cohen_d, round(a.m, 6) AS mean_base, round(b.m, 6) AS mean_other
            FROM (SELECT avg({{c}}) AS m, var_samp({{c}}) AS v FROM {_HALF("label = 0")} h) a, (SELECT avg({{c}}) AS m, var_samp({{c}}) AS v FROM {_HALF(cond)} h) b""",
        )
        for name, cond in _DRIFT.items()
    ),
)
def cohen_d(spark, sf):
    f = S.features(spark, sf)
    return rounded(A.cohen_d(f.filter("label = 0"), {n: f.filter(c) for n, c in _DRIFT.items()}, FEATS), ["cohen_d", "mean_base", "mean_other"])


@query(
    "histogram",
    each(
        ["l_quantity", "l_extendedprice"],
        "SELECT '{c}' AS feature, CAST(least(floor(({c} - lo) / (hi - lo) * 20), 19) AS BIGINT) AS bin, count(*) AS n FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) b GROUP BY 1, 2",
    ),
)
def histogram(spark, sf):
    return A.histogram(load(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], 20)


@query(
    "box_summary",
    each(
        ["o_totalprice"],
        "SELECT '{c}' AS feature, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q1, round(median({c}), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3, max({c}) AS max FROM orders",
    ),
)
def box_summary(spark, sf):
    return rounded(A.box_summary(load(spark, sf, "orders"), ["o_totalprice"]), ["q1", "median", "q3"])


@query("any_true", "SELECT bool_or(l_quantity > 49 AND l_discount = 0) AS any_hit FROM lineitem")
def any_true(spark, sf):
    return A.any_true(load(spark, sf, "lineitem"), (F.col("l_quantity") > 49) & (F.col("l_discount") == 0), "any_hit")


@query(
    "melt_metrics",
    each(["mean_price", "mean_discount"], "SELECT l_returnflag, '{c}' AS metric, round({c}, 6) AS score FROM (SELECT l_returnflag, avg(l_extendedprice) AS mean_price, avg(l_discount) AS mean_discount FROM lineitem GROUP BY l_returnflag) m"),
)
def melt_metrics(spark, sf):
    m = load(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.avg("l_extendedprice").alias("mean_price"), F.avg("l_discount").alias("mean_discount"))
    return rounded(A.melt(m, ["l_returnflag"], ["mean_price", "mean_discount"]), ["score"])


