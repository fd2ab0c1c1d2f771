"""Join, merge and metadata queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import metadata as D
from ..operators import neighbours as NB
from ..session import shared_dir
from ..sources import footers as FT
from . import standins as S
from .registry import load, query, rounded


@query(
    "catalog_left_join",
    """SELECT o_orderkey, o_custkey, c_name, c_mktsegment, o_totalprice, c.o_totalprice_meta FROM orders
      LEFT JOIN (SELECT c_custkey, c_name, c_mktsegment, c_acctbal AS o_totalprice_meta FROM customer WHERE c_custkey % 3 > 0) c ON c_custkey = o_custkey""",
)
def catalog_left_join(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = load(spark, sf, "customer").filter("c_custkey % 3 > 0").selectExpr("c_custkey AS o_custkey", "c_name", "c_mktsegment", "c_acctbal AS o_totalprice")
    return J.left_with_suffix(o, J.one_per_key(c, "o_custkey", c.columns), "o_custkey")


_META = "SELECT l_partkey AS part_id, min(l_returnflag) AS track_genre, CAST(max(l_linenumber) AS INTEGER) AS popularity FROM lineitem WHERE l_partkey % 5 > 0 GROUP BY l_partkey"


@query(
    "assemble_catalog",
    f"""WITH t AS (SELECT concat('P', CAST(p_partkey AS VARCHAR)) AS track_id, CAST(p_size AS DOUBLE) AS energy FROM part WHERE p_partkey % 2 = 0),
      m AS (SELECT concat('P', CAST(part_id AS VARCHAR)) AS track_id, track_genre, popularity FROM ({_META}) x),
      l AS (SELECT concat('P', CAST(p_partkey AS VARCHAR)) AS track_id, p_retailprice AS energy, CASE WHEN p_type = 'ECONOMY' THEN 'lyrics_dataset' WHEN p_type = 'PROMO' THEN NULL ELSE p_type END AS track_genre, p_name AS lyric FROM part WHERE p_partkey % 2 = 1 OR p_partkey % 3 = 0)
    SELECT t.track_id, energy, track_genre, popularity, CAST(NULL AS BOOLEAN) AS explicit, CAST(NULL AS VARCHAR) AS lyric FROM t LEFT JOIN m USING (track_id)
    UNION ALL SELECT track_id, energy, CASE WHEN track_genre = 'lyrics_dataset' OR track_genre IS NULL THEN 'spotify_unknown' ELSE track_genre END, 0, false, lyric FROM l WHERE track_id NOT IN (SELECT track_id FROM t)""",
)
def assemble_catalog(spark, sf):
    p = load(spark, sf, "part")
    tid = "concat('P', CAST({} AS STRING)) AS track_id"
    t = p.filter("p_partkey % 2 = 0").selectExpr(tid.format("p_partkey"), "CAST(p_size AS DOUBLE) AS energy")
    m = load(spark, sf, "lineitem").filter("l_partkey % 5 > 0").groupBy("l_partkey").agg(F.min("l_returnflag").alias("track_genre"), F.max("l_linenumber").alias("popularity"))
    m = m.selectExpr(tid.format("l_partkey"), "track_genre", "popularity")
    lyr = p.filter("p_partkey % 2 = 1 OR p_partkey % 3 = 0").selectExpr(
        tid.format("p_partkey"), "p_retailprice AS energy",
        "CASE WHEN p_type = 'ECONOMY' THEN 'lyrics_dataset' WHEN p_type = 'PROMO' THEN NULL ELSE p_type END AS track_genre", "p_name AS lyric",
    )
    return J.assemble_catalog(t, m, lyr).select("track_id", "energy", "track_genre", "popularity", "explicit", "lyric")


@query(
    "hot_catalog",
    """SELECT track_id, mood, version FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY src DESC, version DESC) AS rn FROM (
      SELECT p_partkey AS track_id, p_type AS mood, CAST(0 AS BIGINT) AS version, 0 AS src FROM part
      UNION ALL SELECT l_partkey, l_returnflag, l_orderkey * 10 + l_linenumber, CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END FROM lineitem) u) t WHERE rn = 1""",
)
def hot_catalog(spark, sf):
    """Parts and small line items play the catalog, large line items the delta that wins."""
    parts = load(spark, sf, "part").selectExpr("p_partkey AS track_id", "p_type AS mood", "CAST(0 AS BIGINT) AS version")
    items = load(spark, sf, "lineitem")
    rows = ["l_partkey AS track_id", "l_returnflag AS mood", "l_orderkey * 10 + l_linenumber AS version"]
    base = parts.unionByName(items.filter("l_quantity <= 45").selectExpr(*rows))
    delta = items.filter("l_quantity > 45").selectExpr(*rows)
    return J.hot_catalog(base, delta, [F.col("version").desc()]).select("track_id", "mood", "version")


@query(
    "metadata_conflicts",
    """SELECT count(*) FILTER (a.status <> b.status) AS status, count(*) FILTER (a.prio <> b.prio) AS prio FROM
      (SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS prio FROM orders) a JOIN
      (SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS status, CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE upper(o_orderpriority) END AS prio FROM orders) b USING (o_orderkey)""",
)
def metadata_conflicts(spark, sf):
    o = load(spark, sf, "orders")
    a = o.selectExpr("o_orderkey", "o_orderstatus AS status", "o_orderpriority AS prio")
    b = o.selectExpr(
        "o_orderkey", "CASE WHEN o_custkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS status", "CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE upper(o_orderpriority) END AS prio"
    )
    return J.metadata_conflicts(a, b, "o_orderkey", ["status", "prio"])


SPLIT = {
    "l_orderkey": "l_orderkey",
    "x": "l_discount",
    "y": "CASE WHEN l_quantity > 40 THEN NULL ELSE l_tax END",
    "z": "l_linenumber",
    "w": "l_quantity",
    "label": "l_returnflag",
}
_SPLIT = S.view_sql(SPLIT, "lineitem")


@query(
    "split_report",
    f"""WITH s AS ({_SPLIT}), tr AS (SELECT * FROM s WHERE l_orderkey % 5 > 0), te AS (SELECT *, row_number() OVER () AS rid FROM s WHERE l_orderkey % 5 = 0),
      ov AS (SELECT te.rid, te.label = tr.label AS same FROM te JOIN tr ON te.x = tr.x AND te.y IS NOT DISTINCT FROM tr.y AND te.z = tr.z AND te.w = tr.w)
    SELECT (SELECT count(DISTINCT rid) FROM ov) AS test_rows_with_feature_overlap, (SELECT round(avg(CASE WHEN same THEN 1.0 ELSE 0.0 END), 6) FROM ov) AS feature_overlap_label_agreement,
      (SELECT count(*) FROM tr) AS train_rows, (SELECT count(*) FROM te) AS test_rows,
      (SELECT count(*) FROM tr) - (SELECT count(*) FROM (SELECT DISTINCT x, y, z, w FROM tr) d) AS train_duplicate_feature_rows,
      (SELECT count(*) FROM te) - (SELECT count(*) FROM (SELECT DISTINCT x, y, z, w FROM te) d) AS test_duplicate_feature_rows""",
)
def split_report(spark, sf):
    s = S.view(spark, sf, SPLIT, "lineitem")
    out = J.split_report(s.filter("l_orderkey % 5 > 0"), s.filter("l_orderkey % 5 = 0"), ["x", "y", "z", "w"], "label")
    return rounded(out, ["feature_overlap_label_agreement"])


@query("unseen_rows", "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING max(l_quantity) > 49)")
def unseen_rows(spark, sf):
    """Parts never ordered in a lot above 49."""
    largest = load(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_quantity").alias("most"))
    seen = largest.filter("most > 49").select("p_partkey")
    return J.unseen(load(spark, sf, "part"), seen, ["p_partkey"]).select("p_partkey", "p_name")


# --- run metadata: orders play the runs -----------------------------------------------------------------
@query(
    "upsert_runs",
    """SELECT run_id, status, total FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY src DESC, total DESC) AS rn FROM (
      SELECT o_custkey AS run_id, o_orderstatus AS status, o_totalprice AS total, 0 AS src FROM orders WHERE o_orderkey % 10 <> 1
      UNION ALL SELECT o_custkey, 'NEW', o_totalprice, 1 FROM orders WHERE o_orderkey % 10 = 1) u) t WHERE rn = 1""",
)
def upsert_runs(spark, sf):
    o = load(spark, sf, "orders")
    old = o.filter("o_orderkey % 10 <> 1").selectExpr("o_custkey AS run_id", "o_orderstatus AS status", "o_totalprice AS total")
    new = o.filter("o_orderkey % 10 = 1").selectExpr("o_custkey AS run_id", "'NEW' AS status", "o_totalprice AS total")
    return J.upsert(old, new, ["run_id"], [F.col("total").desc()])


@query(
    "replace_by_key",
    """SELECT run_id, column_name, null_count FROM (SELECT l_orderkey AS run_id, l_returnflag AS column_name, l_linenumber AS null_count FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey % 10 = 3)
      UNION ALL SELECT o_orderkey, o_orderstatus, 0 FROM orders WHERE o_custkey % 10 = 3) t""",
)
def replace_by_key(spark, sf):
    old = load(spark, sf, "lineitem").selectExpr("l_orderkey AS run_id", "l_returnflag AS column_name", "l_linenumber AS null_count")
    new = load(spark, sf, "orders").filter("o_custkey % 10 = 3").selectExpr("o_orderkey AS run_id", "o_orderstatus AS column_name", "0 AS null_count")
    return J.replace_by_key(old, new, ["run_id"])


_COLS = {"o_orderkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double"}


@query(
    "column_stats",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) - count({c}) AS null_count, CAST(0 AS DOUBLE) AS null_ratio, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM orders"
        for c, t in _COLS.items()
    ),
)
def column_stats(spark, sf):
    return D.column_stats(load(spark, sf, "orders").select(*_COLS))


@query("file_stats", "SELECT 'lineitem.parquet' AS file_name, count(*) AS row_count, true AS has_bytes, true AS has_blocks FROM lineitem")
def file_stats(spark, sf):
    """Sizes and blocks depend on the writer; SQL can only say that there are some."""
    found = D.file_stats(load(spark, sf, "lineitem"))
    return found.select("file_name", "row_count", (F.col("size_bytes") > F.col("row_count")).alias("has_bytes"), (F.col("blocks") >= 1).alias("has_blocks"))


LINE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
    "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
_SCHEMA_OF_LINES = ", ".join(f'{{"name": "{c}", "type": "{t}"}}' for c, t in LINE_TYPES.items())


@query(
    "dataset_summary",
    f"""SELECT count(*) AS row_count, CAST(1 AS BIGINT) AS file_count, true AS has_bytes, 'lineitem.parquet' AS first_file, 11 AS column_count,
      md5('[{_SCHEMA_OF_LINES}]') AS schema_hash FROM lineitem""",
)
def dataset_summary(spark, sf):
    """Bytes depend on the writer; SQL can only say that there are some."""
    found = D.dataset_summary(load(spark, sf, "lineitem"))
    return found.select("row_count", "file_count", (F.col("size_bytes") > F.col("row_count")).alias("has_bytes"), "first_file", "column_count", "schema_hash")


_FOOTER_TABLES = ("orders", "lineitem", "documents")


def footers(spark, sf) -> DataFrame:
    """Footers of the tables as given and, in several files of several row groups, of a copy of orders with nulls."""
    copy = shared_dir(spark, "row-groups")
    gapped = load(spark, sf, "orders").withColumn("gap", F.expr("IF(o_orderkey % 3 = 0, NULL, o_totalprice)"))
    gapped.repartition(4, "o_orderkey").write.option("parquet.block.size", 64 * 1024).parquet(copy)
    found = FT.column_chunks(spark, copy).withColumn("dataset", F.lit("copy"))
    for name in _FOOTER_TABLES:
        found = found.unionByName(FT.column_chunks(spark, f"{sf}/{name}.parquet").withColumn("dataset", F.lit(name)))
    return found


def _nulls_sql(dataset: str, table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{dataset}' AS dataset, '{c}' AS column_name, count(*) AS row_count, count(*) - count({x}) AS null_count FROM {table}" for c, x in columns.items())


_ORDER_COLUMNS = {c: c for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")}
_FOOTER_SQL = " UNION ALL ".join(
    [
        _nulls_sql("copy", "orders", {**_ORDER_COLUMNS, "gap": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END"}),
        _nulls_sql("orders", "orders", _ORDER_COLUMNS),
        _nulls_sql("lineitem", "lineitem", {c: c for c in LINE_TYPES}),
        _nulls_sql("documents", "documents", {c: c for c in ("doc_id", "text", "lang", "source", "n_chars")}),
    ]
)


@query("footer_columns", _FOOTER_SQL)
def footer_columns(spark, sf):
    """Rows and nulls per column, summed over the row groups' footers."""
    chunks = footers(spark, sf)
    out = None
    for name in ("copy", *_FOOTER_TABLES):
        one = FT.column_totals(chunks.filter(F.col("dataset") == name)).select(F.lit(name).alias("dataset"), "column_name", "row_count", "null_count")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "footer_row_groups",
    """SELECT 'copy' AS dataset, count(*) AS row_count, true AS agree, true AS has_bytes FROM orders UNION ALL SELECT 'orders', count(*), true, true FROM orders
      UNION ALL SELECT 'lineitem', count(*), true, true FROM lineitem UNION ALL SELECT 'documents', count(*), true, true FROM documents""",
)
def footer_row_groups(spark, sf):
    """Rows of all row groups; the records of files agree with those of their row groups, and their sizes hold the groups' bytes."""
    chunks = footers(spark, sf)
    out = None
    for name in ("copy", *_FOOTER_TABLES):
        own = chunks.filter(F.col("dataset") == name)
        groups = FT.row_groups(own).groupBy("file_path").agg(F.count("*").alias("n"), F.sum("row_count").alias("rows"), F.max("row_count").alias("most"), F.sum("compressed_bytes").alias("bytes"))
        both = FT.file_groups(own).join(groups, "file_path", "left")
        same = (F.col("n") == F.col("row_groups")) & (F.col("rows") == F.col("row_count")) & (F.col("most") == F.col("largest_group")) & F.col("error").isNull()
        one = both.agg(F.sum("rows").alias("row_count"), F.every(F.coalesce(same, F.lit(False))).alias("agree"), F.every(F.col("bytes").between(1, F.col("size_bytes"))).alias("has_bytes"))
        one = one.select(F.lit(name).alias("dataset"), "row_count", "agree", "has_bytes")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "run_totals",
    "SELECT o_custkey AS run_id, count(*) AS datasets, CAST(sum(o_orderkey) AS BIGINT) AS total_rows, CAST(sum(o_orderkey * 2) AS BIGINT) AS total_bytes FROM orders GROUP BY o_custkey",
)
def run_totals(spark, sf):
    return D.run_totals(load(spark, sf, "orders").selectExpr("o_custkey AS run_id", "o_orderkey AS row_count", "o_orderkey * 2 AS size_bytes"))


@query(
    "event_counts",
    """SELECT dataset, expected, coalesce(seen, 0) AS seen, coalesce(seen, 0) >= expected AS complete FROM
      (SELECT o_orderstatus AS dataset, count(*) AS expected FROM orders GROUP BY 1 UNION ALL SELECT 'never', 1) e LEFT JOIN
      (SELECT o_orderstatus AS dataset, count(*) AS seen FROM orders WHERE o_orderstatus <> 'P' OR o_orderkey % 2 = 0 GROUP BY 1) s USING (dataset)""",
)
def event_counts(spark, sf):
    o = load(spark, sf, "orders")
    expected = o.groupBy(F.col("o_orderstatus").alias("dataset")).agg(F.count("*").alias("expected"))
    expected = expected.unionByName(spark.range(1).select(F.lit("never").alias("dataset"), F.lit(1).cast("bigint").alias("expected")))
    return D.event_counts(o.filter("o_orderstatus <> 'P' OR o_orderkey % 2 = 0"), "o_orderstatus", expected)


# --- nearest neighbours ---------------------------------------------------------------------------------
_DIST = "round(sqrt(list_sum(list_transform(list_zip(p.embedding, t.embedding), lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) ** 2))), 9)"
KNN_SQL = f"""SELECT vec_id, near_id, d, label, rn FROM (SELECT p.vec_id, t.vec_id AS near_id, t.label, {_DIST} AS d,
  row_number() OVER (PARTITION BY p.vec_id ORDER BY {_DIST}, t.vec_id) AS rn FROM embeddings p JOIN embeddings t ON p.vec_id <> t.vec_id) q WHERE rn <= 5"""


@query("knn_join", f"SELECT vec_id, near_id AS near_vec_id, round(d, 6) AS distance, CAST(rn AS INTEGER) AS rank FROM ({KNN_SQL}) k")
def knn_join(spark, sf):
    e = load(spark, sf, "embeddings")
    near = NB.knn_join(e, e, "vec_id", "vec_id", "embedding", 5, exclude_self=True)
    return rounded(near, ["distance"])


@query(
    "knn_vote",
    f"""SELECT vec_id, predicted, votes FROM (SELECT vec_id, label AS predicted, count(*) AS votes, row_number() OVER (PARTITION BY vec_id ORDER BY count(*) DESC, label) AS rk
      FROM ({KNN_SQL}) k GROUP BY vec_id, label) v WHERE rk = 1""",
)
def knn_vote(spark, sf):
    e = load(spark, sf, "embeddings")
    return NB.majority_vote(NB.knn_join(e, e, "vec_id", "vec_id", "embedding", 5, ["label"], exclude_self=True), "vec_id", "label")
