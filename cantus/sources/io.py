"""Scans and sinks of the lake."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import columns as C
from ..schemas import Dataset

CORRUPT = "_corrupt_record"
LINES_PER_FILE = 250_000


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when a path or glob matches anything on its own file system (local, s3a, hdfs ...)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def require(spark: SparkSession, path: str) -> str:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no input at {path}")
    return path


def first_existing(spark: SparkSession, candidates: list[str]) -> str:
    """Remote location first, then local copies; read in place, nothing is downloaded."""
    for path in candidates:
        try:
            if path_exists(spark, path):
                return path
        except Exception:  # an unreachable or unknown file system counts as absent
            continue
    raise FileNotFoundError("no input at any of: " + ", ".join(candidates))


def read_csv(spark: SparkSession, path: str, dataset: Dataset, max_rows: int | None = None) -> DataFrame:
    """A raw source with a header, every column as text; ``max_rows`` is the demo cap of a dataset."""
    df = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"').option("multiLine", True).schema(dataset.raw_schema).csv(require(spark, path))
    return df if max_rows is None else df.limit(max_rows)


def envelope(df: DataFrame, dataset: str, key: str) -> DataFrame:
    """``(key, value)`` events: key = id as text ("" when missing), value = JSON of dataset and row."""
    clean = C.nan_to_null(df)
    return clean.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"),
        F.to_json(F.struct(F.lit(dataset).alias("dataset"), F.struct(*[F.col(f"`{c}`") for c in clean.columns]).alias("payload"))).alias("value"),
    )


def open_envelope(events: DataFrame, payload: T.StructType, dataset: str | None = None, value: Column | None = None) -> DataFrame:
    """The payload columns of events (of one dataset); events that do not parse are dropped.

    The generate step keeps the optimiser from working out the parsed struct again in every filter.
    """
    schema = T.StructType([T.StructField("dataset", T.StringType()), T.StructField("payload", payload)])
    parsed = F.from_json((value if value is not None else F.col("value")).cast("string"), schema)
    parsed = events.select(F.explode_outer(F.array(parsed)).alias("e"))
    kept = parsed.filter(F.col("e.payload").isNotNull())
    if dataset:
        kept = kept.filter(F.col("e.dataset") == dataset)
    return kept.select("e.payload.*")


def unopened_events(events: DataFrame, payload: T.StructType, value: Column | None = None) -> DataFrame:
    """What ``open_envelope`` leaves out because it does not parse or has no payload: the events' raw text."""
    raw = (value if value is not None else F.col("value")).cast("string")
    schema = T.StructType([T.StructField("dataset", T.StringType()), T.StructField("payload", payload)])
    parsed = events.select(raw.alias("raw"), F.explode_outer(F.array(F.from_json(raw, schema))).alias("e"))
    return parsed.filter(F.col("e.payload").isNull()).select("raw")


def append_json_lines(df: DataFrame, path: str, clean: bool = False) -> None:
    """Add to the dataset's historical Bronze; ``clean`` replaces it by this run.

    Lines repeat every name, so files are compressed; readers cannot split those, so none is long.
    """
    writer = df.write.mode("overwrite" if clean else "append").option("compression", "gzip")
    writer.option("maxRecordsPerFile", LINES_PER_FILE).json(path)


def read_bronze(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All JSON Lines files of a dataset; a line that does not parse lands in ``_corrupt_record``."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(require(spark, path))


def good_lines(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_lines(bronze: DataFrame) -> DataFrame:
    """The lines that ``good_lines`` leaves out, as they are in the file."""
    # the JSON reader refuses to read nothing but the corrupt column, so one of the data is asked for too
    data = next(c for c in bronze.columns if c != CORRUPT)
    return bronze.filter(F.col(CORRUPT).isNotNull()).select(F.coalesce(F.col(CORRUPT), F.col(f"`{data}`").cast("string")).alias("raw"))


def read_layer(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A Parquet layer; naming the columns keeps long text out of the scan."""
    df = spark.read.parquet(require(spark, path))
    return C.keep_existing(df, columns) if columns else df


def write_layer(df: DataFrame, path: str, max_records_per_file: int | None = None, observe: str | None = None) -> int | None:
    """Overwrite a Parquet layer.  With ``observe`` the row count comes from the write itself."""
    from pyspark.sql import Observation

    watch = Observation(observe) if observe else None
    if watch:
        df = df.observe(watch, F.count(F.lit(1)).alias("rows"))
    writer = df.write.mode("overwrite")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
    return watch.get["rows"] if watch else None


def read_upload(spark: SparkSession, path: str) -> DataFrame:
    """An uploaded table by suffix: CSV (as text columns) or Parquet."""
    name = path.lower().rstrip("/")
    if name.endswith(".csv"):
        return spark.read.option("header", True).option("escape", '"').csv(require(spark, path))
    if name.endswith((".parquet", ".pq")):
        return spark.read.parquet(require(spark, path))
    raise ValueError("unsupported format: use CSV or Parquet")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def append_aligned(df: DataFrame, path: str) -> None:
    """Append to an existing Parquet table with exactly its columns; a type clash fails the job."""
    spark = df.sparkSession
    target = spark.read.parquet(path).schema if path_exists(spark, path) else df.schema
    C.align_to(df, target).write.mode("append").parquet(path)


def append_history(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_classified(classified: DataFrame, catalog: str, history: str) -> None:
    """Rows to the catalog, by its columns, and whole to the history; computed once for both."""
    kept = classified.persist()
    try:
        append_aligned(kept, catalog)
        append_history(kept, history)
    finally:
        kept.unpersist()


def load_scaler_stats(spark: SparkSession, candidates: list[str]) -> DataFrame | None:
    """The first candidate that has the columns feature, mean and std."""
    for path in candidates:
        if not path_exists(spark, path):
            continue
        if path.lower().endswith(".csv"):
            df = spark.read.option("header", True).schema("feature string, mean double, std double").csv(path)
        else:
            df = spark.read.parquet(path)
        if {"feature", "mean", "std"} <= set(df.columns):
            return df
    return None


def register_table(spark: SparkSession, name: str, path: str) -> str:
    """Create or replace an external table over a Parquet location."""
    table = C.safe_name(name)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=path, source="parquet")
    return table


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Relational sink; needs the database's driver on the class path."""
    df.write.mode("append").jdbc(url, table, properties=properties)
