"""Constant tables as one SQL literal each.

A table of rules built from single column calls costs a driver round trip per cell; as one
expression text it costs one, and Spark folds it into a literal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql(value) -> str:
    """A Python constant as a SQL literal (floats as DOUBLE)."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, (list, tuple)):
        return "array(" + ", ".join(sql(v) for v in value) + ")"
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def struct_sql(row: dict) -> str:
    return "named_struct(" + ", ".join(f"{sql(k)}, {sql(v)}" for k, v in row.items()) + ")"


def table(rows: list[dict]) -> Column:
    """An array of structs."""
    return F.expr("array(" + ", ".join(struct_sql(r) for r in rows) + ")")


def array(values) -> Column:
    return F.expr(sql(list(values)))


def mapping(values: dict) -> Column:
    """A map; looking up a missing key gives NULL."""
    return F.expr("map(" + ", ".join(f"{sql(k)}, {sql(v)}" for k, v in values.items()) + ")")
