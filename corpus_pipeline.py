"""A training-data pipeline over ``documents``: filter, dedup in three ways, pack.

Every stage gets all that its predecessor kept, and is written as Parquet before the next begins.
SQL cannot express the stages, so ``ORACLE_SQL`` is None; tests compare them with brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantus.llm import line_dedup, packing, quality, simhash, substring_dedup
from cantus.llm.common import table, written


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text where the table has it."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def _with_own_columns(docs: DataFrame, operate) -> DataFrame:
    """``operate`` on id and text, the other columns out of its way under names that no operator uses."""
    own = {c: f"__own{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    out = operate(docs.withColumnsRenamed(own))
    return _sized(out.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns]))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; the others stay as they are."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of two or more lines that occur earlier are cut from the texts; documents stay."""
    return _with_own_columns(docs, line_dedup.line_run_dedup)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays (a null id always stays)."""
    groups = simhash.simhash_groups(docs, width=3, bits=3)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by an earlier window of 20 words are cut from the texts; documents stay."""
    return _with_own_columns(docs, lambda d: substring_dedup.substring_dedup(d, window=20))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, placed in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), seq_len=2048, end_id=0)


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_copies),
    ("substring dedup", drop_repeated_substrings),
    ("best-fit packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
