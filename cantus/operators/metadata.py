"""Run, dataset, column and file metadata."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import catalog_type
from .joins import replace_by_key, upsert

RUN_KEY = ["run_id"]
DATASET_KEY = ["run_id", "dataset_name", "layer_name"]


def column_stats(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Type, null count and ratio, minimum and maximum (as text) of every column; one scan."""
    names = names or df.columns
    types = {f.name: catalog_type(f.dataType) for f in df.schema}
    row = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls|{c}") for c in names],
        *[F.min(c).cast("string").alias(f"min|{c}") for c in names],
        *[F.max(c).cast("string").alias(f"max|{c}") for c in names],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"), F.col(f"`nulls|{c}`").alias("null_count"),
            F.try_divide(F.col(f"`nulls|{c}`"), F.col("rows")).alias("null_ratio"),
            F.col(f"`min|{c}`").alias("min_value"), F.col(f"`max|{c}`").alias("max_value"),
        )
        for c in names
    ]
    return row.select(F.inline(F.array(*cells)))


def file_stats(df: DataFrame) -> DataFrame:
    """One row per data file: name, path, size, rows and the number of scan blocks seen.

    ``df`` must be read straight from files; only the hidden metadata column is scanned.
    """
    m = F.col("_metadata")
    return (
        df.groupBy(m["file_name"].alias("file_name"), m["file_path"].alias("file_path"), m["file_size"].alias("size_bytes"))
        .agg(F.count("*").alias("row_count"), F.count_distinct(m["file_block_start"]).alias("blocks"))
    )


def dataset_summary(df: DataFrame) -> DataFrame:
    """Rows, files, bytes and columns of a file-backed dataset; one row."""
    return file_stats(df).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.count("*").alias("file_count"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes"),
        F.min("file_name").alias("first_file"),
    ).withColumns({"column_count": F.lit(len(df.columns)), "schema_hash": F.lit(schema_hash(df))})


def sample_files(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n file names (a preview)."""
    return file_stats(df).select("file_name").orderBy("file_name").limit(n)


def schema_hash(df: DataFrame) -> str:
    """Fingerprint of the column list."""
    columns = [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema if not f.name.startswith("__")]
    return hashlib.md5(json.dumps(columns, sort_keys=True).encode()).hexdigest()


def run_totals(dataset_runs: DataFrame) -> DataFrame:
    """Per run: datasets, rows and bytes."""
    return dataset_runs.groupBy("run_id").agg(
        F.count("*").alias("datasets"), F.sum("row_count").alias("total_rows"), F.sum("size_bytes").alias("total_bytes")
    )


def event_counts(df: DataFrame, dataset: str, expected: DataFrame) -> DataFrame:
    """Per dataset: rows seen, rows expected, and whether the expectation is met."""
    seen = df.groupBy(F.col(dataset).alias("dataset")).agg(F.count("*").alias("seen"))
    out = expected.join(seen, "dataset", "left")  # a handful of datasets
    n = F.coalesce(F.col("seen"), F.lit(0))
    return out.select("dataset", "expected", n.alias("seen"), (n >= F.col("expected")).alias("complete"))


def register_run(runs: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(runs, new, RUN_KEY)


def register_dataset_run(dataset_runs: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(dataset_runs, new, DATASET_KEY)


def register_column_stats(stats: DataFrame, new: DataFrame) -> DataFrame:
    return replace_by_key(stats, new, DATASET_KEY)

