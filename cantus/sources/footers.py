"""Row groups and column chunks of Parquet files, read from their footers inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNKS = (
    "file_path string, size_bytes bigint, row_group int, row_count bigint, column_name string, leaf string, "
    "compressed_bytes bigint, uncompressed_bytes bigint, null_count bigint, error string"
)
NAMES = [part.split()[0] for part in CHUNKS.split(", ")]


def _open(path: str):
    """A file of any store that Arrow knows; only the ranges asked for are read."""
    from pyarrow import fs

    scheme, rest = urlsplit(path).scheme, path.split(":", 1)[-1]
    if scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    store, inner = fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")
    return store.open_input_file(inner)


def _chunks_of(path: str, size: int) -> list[tuple]:
    import pyarrow as pa
    import pyarrow.parquet as pq

    with _open(path) as source:
        try:
            footer = pq.ParquetFile(source).metadata
        except (pa.ArrowInvalid, OSError) as exc:  # no Parquet file, or a broken one: kept as one row with the reason
            return [(path, size, None, None, None, None, None, None, None, f"{type(exc).__name__}: {exc}"[:300])]
    rows = []
    for g in range(footer.num_row_groups):
        group = footer.row_group(g)
        for c in range(group.num_columns):
            chunk = group.column(c)
            stats = chunk.statistics
            nulls = stats.null_count if stats is not None and stats.has_null_count else None
            leaf = chunk.path_in_schema
            rows.append((path, size, g, group.num_rows, leaf.split(".")[0], leaf, chunk.total_compressed_size, chunk.total_uncompressed_size, nulls, None))
    return rows or [(path, size, None, 0, None, None, None, None, None, None)]


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, size in zip(batch["path"], batch["length"]):
            yield pd.DataFrame(_chunks_of(path, int(size)), columns=NAMES, dtype=object)  # one file at a time


def column_chunks(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per file, row group and leaf column: rows, bytes and nulls (NULL where the writer kept no count).

    Files are listed by Spark; their contents are not read, each task opens the footers of its files.
    A file without row groups gives one row with 0 rows and no row group, one whose footer cannot be read a
    row with the reason in ``error``; files of zero bytes are left out, as by any Spark reader.  A store that the tasks' Arrow library does not know fails the job.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length").mapInPandas(_read, CHUNKS)


def row_groups(chunks: DataFrame) -> DataFrame:
    """One row per row group: rows, bytes on disk and unpacked, columns; unreadable and empty files have none."""
    return chunks.filter("row_group IS NOT NULL").groupBy("file_path", "row_group").agg(
        F.first("row_count").alias("row_count"), F.count("*").alias("leaves"),
        F.sum("compressed_bytes").alias("compressed_bytes"), F.sum("uncompressed_bytes").alias("uncompressed_bytes"),
    )


def column_totals(chunks: DataFrame) -> DataFrame:
    """Rows and nulls of every leaf column over all row groups; nulls are NULL if a row group keeps no count."""
    unknown = F.count_if(F.col("null_count").isNull())
    return chunks.filter("row_group IS NOT NULL").groupBy("column_name", "leaf").agg(
        F.sum("row_count").alias("row_count"), F.when(unknown == 0, F.sum("null_count")).alias("null_count"),
        F.count("*").alias("row_groups"), F.sum("compressed_bytes").alias("compressed_bytes"),
    )


def file_groups(chunks: DataFrame) -> DataFrame:
    """One row per file, unreadable ones too: size, row groups, rows, largest row group, error."""
    group = F.struct("row_group", "row_count")
    once = chunks.groupBy("file_path", "size_bytes", "error").agg(F.collect_set(F.when(F.col("row_group").isNotNull(), group)).alias("g"))
    rows = F.aggregate("g", F.lit(0).cast("bigint"), lambda total, x: total + x["row_count"])
    return once.select(
        "file_path", "size_bytes", F.size("g").alias("row_groups"), F.when(F.col("error").isNull(), rows).alias("row_count"),
        F.array_max(F.transform("g", lambda x: x["row_count"])).alias("largest_group"), "error",
    )
