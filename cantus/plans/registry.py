"""Query registry: a name, a Spark callable and (where SQL can say it) an ANSI SQL twin."""

from __future__ import annotations

from functools import wraps
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = wraps(fn)(lambda spark, sf: fn(settle(spark), sf))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def rounded(df: DataFrame, names: list[str], digits: int = 6) -> DataFrame:
    """Only for comparing engines: sums of doubles depend on the order of addition."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in names})


def rnd(expr: str, alias: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) AS {alias}"
