"""Helpers shared by the corpus operators."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantus.session import shared_dir

#: ASCII white space; ``bytes.split()`` splits on just these six.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and outlives executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns for Python tasks: the id, and the text as UTF-8 bytes (null: empty)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.cast("binary").alias("text"))


def slices(batches, column: str = "text", size: int = 2 << 20):
    """Cut Arrow batches into runs of rows of about ``size`` bytes of text; a longer row is alone.

    Bounds what a Python task holds at once, however long the texts are.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        lens = pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(lens):
            if total and total + n > size:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


def hash_sample(df: DataFrame, id_col: str, total: int, most: int) -> DataFrame:
    """At most ``most`` of ``total`` rows, by the hash of their id.

    A share of the hashes is taken first, so that tasks together send little more than ``most`` rows.
    """
    parts = 1_000_000
    share = min(parts, -(-12 * parts * most // (10 * max(total, 1))))
    picked = df.where(F.pmod(F.xxhash64(id_col, F.lit(9)), F.lit(parts)) < share)
    return picked.orderBy(F.xxhash64(id_col), id_col).limit(most)


def crc_class(id_col: str, parts: int):
    """``crc32`` of the decimal id, modulo ``parts``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(parts))
