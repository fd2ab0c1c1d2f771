"""Column-level shaping: drop, rename, project, cast, fill, align."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import METADATA_DEFAULTS, TEXT_FILL, UPLOAD_ALIASES
from ..functions import numeric as N
from ..functions import text as X


def keep_existing(df: DataFrame, names: list[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[f"`{c}`" for c in names if c in df.columns])


def shared_columns(*column_lists: list[str]) -> list[str]:
    first, *rest = column_lists
    return [c for c in first if all(c in other for other in rest)]


def extra_columns(columns: list[str], known: list[str]) -> list[str]:
    return sorted(set(columns) - set(known))


def numeric_columns(df: DataFrame, ignore: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in ignore]


def _no_nan(c: Column) -> Column:
    """``safe_double`` of a column that is double already: not written out as text and read again."""
    return F.nanvl(c, F.lit(None).cast("double"))


def cast_safely(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast text columns that exist; values that do not parse become NULL."""
    makers = {"double": N.safe_double, "boolean": N.safe_bool}
    casts = {}
    for name, to in types.items():
        if name in df.columns:
            col = F.col(f"`{name}`")
            if to == "double" and df.schema[name].dataType == T.DoubleType():
                casts[name] = _no_nan(col)
            else:
                casts[name] = makers[to](col) if to in makers else N.safe_int(col, to)
    return df.withColumns(casts)


def squash_text(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({c: X.squash(F.col(c).cast("string")) for c in names if c in df.columns})


def fill_by_type(df: DataFrame, text: list[str] = (), numeric: list[str] = ()) -> DataFrame:
    """Text becomes "unknown", numbers 0."""
    fills = {c: TEXT_FILL for c in text if c in df.columns}
    fills.update({c: 0 for c in numeric if c in df.columns})
    return df.fillna(fills) if fills else df


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: N.nan_to_null(F.col(f"`{c}`")) for c in floats}) if floats else df


def ensure_numeric(df: DataFrame, names: list[str], default: float = 0.0) -> DataFrame:
    """Columns that are absent or do not parse become the default."""
    schema = df.schema
    number = lambda c: _no_nan(F.col(c)) if schema[c].dataType == T.DoubleType() else N.safe_double(F.col(c))
    value = lambda c: F.coalesce(number(c), F.lit(default)) if c in schema.names else F.lit(default)
    return df.withColumns({c: value(c) for c in names})


def with_defaults(df: DataFrame, defaults: dict = METADATA_DEFAULTS) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(d)) if c in df.columns else F.lit(d) for c, d in defaults.items()}
    )


def fill_missing_text(df: DataFrame, defaults: dict[str, str], replace: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Default fill plus exact value replacement, per column."""
    out = {}
    for name, default in defaults.items():
        col = F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)
        for old, new in (replace or {}).get(name, {}).items():
            col = F.when(col == old, new).otherwise(col)
        out[name] = col
    return df.withColumns(out)


def normalise_upload_names(df: DataFrame, aliases: dict[str, str] = UPLOAD_ALIASES) -> DataFrame:
    """Trimmed lower-case names with underscores, then known aliases."""
    plain = [str(c).strip().lower().replace(" ", "_") for c in df.columns]
    names = [c if aliases.get(c) in plain else aliases.get(c, c) for c in plain]
    return df.toDF(*names)


def safe_name(name: str) -> str:
    """Lower-case identifier; a leading digit gets a prefix."""
    plain = re.sub(r"[^0-9a-zA-Z]+", "_", name).strip("_").lower()
    return f"col_{plain}" if plain[:1].isdigit() else plain


def safe_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[safe_name(c) for c in df.columns])


def catalog_type(dt: T.DataType) -> str:
    """The small type set of the table catalog: every integer is bigint, every float double."""
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, T.IntegralType):
        return "bigint"
    if isinstance(dt, (T.FractionalType,)):
        return "double"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(dt, T.DateType):
        return "date"
    return "string"


def align_to(df: DataFrame, target: T.StructType) -> DataFrame:
    """Exactly the target's columns in its order: absent ones NULL, extra ones dropped."""
    def column(f: T.StructField) -> Column:
        return (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in target])


def rounded(df: DataFrame, names: list[str], decimals: int = 4) -> DataFrame:
    return df.withColumns({c: F.bround(F.col(c), decimals) for c in names if c in df.columns})


def display_names(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def attach(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """A one-row table as one struct column (a scalar subquery, planned once, no join).

    Refer to its fields as ``name.field``: using the subquery expression itself several times
    would plan it several times.
    """
    return df.withColumn(name, one_row.select(F.struct("*")).scalar())


def unpivot_row(row: DataFrame, names: list[str], fields: dict[str, str], key: str = "feature") -> DataFrame:
    """A one-row aggregate with columns ``<field>|<name>`` as one row per name."""
    structs = [
        F.struct(F.lit(n).alias(key), *[F.col(f"`{src}|{n}`").alias(out) for src, out in fields.items()])
        for n in names
    ]
    return row.select(F.inline(F.array(*structs)))
