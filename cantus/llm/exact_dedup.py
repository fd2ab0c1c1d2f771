"""Exact dedup by a hash aggregation; its slots lie in shared files as an extendible-hash index.

Every text, white-space runs made one space, gets a 64-bit hash.  Rows are pre-aggregated per hash
before they are shuffled, so a hash held by a third of all rows is one row per task.  The index has
one slot per distinct hash.  Its directory is doubled from one bucket until no bucket holds more
than ``bucket_slots`` slots: a bucket's local depth is the fewest leading bits for which that holds.
Slots are written to shared files by ranges of buckets, each range by its owner task.  Slots of more
than one row are chains: only their rows are read again, and compared byte by byte, so texts that
merely share a hash stay apart.  Chains are found by the aggregation alone: buckets and depths order
the files and are not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantus.session import shared_dir

from .common import BLANKS, written


def normalised(text_col: str):
    return F.regexp_replace(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), BLANKS, " ")


def directory(slots: DataFrame, bucket_slots: int, max_depth: int) -> DataFrame:
    """``cell`` (the first ``max_depth`` bits), ``bucket`` and ``depth``; at most 2^max_depth rows.

    Beyond ``max_depth`` bits a bucket is not split further; its range of files is just longer.
    """
    cells = slots.groupBy(F.shiftrightunsigned("h", 64 - max_depth).alias("cell")).agg(F.count("*").alias("n"))
    sizes = cells.select(
        "cell", "n", F.explode(F.transform(F.sequence(F.lit(0), F.lit(max_depth)), lambda d: F.struct(d.alias("depth")))).alias("at")
    ).select("cell", "n", F.col("at.depth").alias("depth"))
    prefix = F.expr(f"shiftright(cell, {max_depth} - depth)")
    full = sizes.groupBy("depth", prefix.alias("prefix")).agg(F.sum("n").alias("n"))
    fits = sizes.select("cell", "depth", prefix.alias("prefix")).join(full, ["depth", "prefix"])
    fits = fits.where((F.col("n") <= bucket_slots) | (F.col("depth") == max_depth))
    own = fits.groupBy("cell").agg(F.min("depth").alias("depth"))
    return own.select("cell", "depth", F.expr(f"shiftleft(shiftright(cell, {max_depth} - depth), {max_depth} - depth)").alias("bucket"))


def build_index(rows: DataFrame, bucket_slots: int, max_depth: int) -> DataFrame:
    """Slots ``h, n`` with their ``bucket`` and ``depth``, in shared files by ranges of buckets."""
    slots = written(rows.groupBy("h").agg(F.count("*").alias("n")), "slots")
    cells = written(directory(slots, bucket_slots, max_depth), "directory")
    placed = slots.join(cells, F.shiftrightunsigned("h", 64 - max_depth) == F.col("cell")).drop("cell")
    path = shared_dir(rows.sparkSession, "hash-index")
    placed.repartitionByRange("bucket", "h").sortWithinPartitions("bucket", "h").write.parquet(path)
    return rows.sparkSession.read.schema(placed.schema).parquet(path)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_slots: int = 1_000_000, max_depth: int = 12) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row per row of ``docs``.

    Null counts as empty; white space is made single spaces, not trimmed.  Of equal texts the
    smallest id stays (null ids never, unless all are null: then ``keep_id`` is null).  Rows that
    repeat the id that stays are all marked kept.  Extra columns are ignored; an empty table gives no
    rows.
    """
    text = normalised(text_col)
    ids = F.col(f"`{id_col}`").cast("long").alias("doc_id")
    read = docs.select(ids, text.alias("norm")).select("doc_id", F.xxhash64("norm").alias("h"), "norm")
    rows = written(read.select("doc_id", "h", F.unhex(F.sha2("norm", 256)).alias("sha")), "hashed")
    index = build_index(rows, bucket_slots, max_depth)
    chains = index.where("n > 1").select("h")
    # one way at every size: the slots of chains grow with the corpus, so they are not broadcast
    members = written(read.join(chains.hint("shuffle_merge"), "h", "left_semi"), "chain-members")
    groups = members.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    several = members.join(groups, ["h", "norm"]).select("doc_id", "keep_id", "group_size", F.sha2("norm", 256).alias("text_sha256"))
    single = rows.join(chains, "h", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lower(F.hex("sha")).alias("text_sha256")
    )
    out = several.unionByName(single)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, one per text; ids should be unique (a repeated one stays repeated)."""
    stays = exact_groups(docs, id_col, text_col, **options).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(stays, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__id")), "left_semi")
