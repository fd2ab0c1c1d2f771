"""Numeric expressions: casts that never raise, clipping, scores, row-wise choice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import BUCKET_EDGES, BUCKETS, TRUE_WORDS


def safe_double(c: Column) -> Column:
    """Bad text and NaN become NULL."""
    return F.nanvl(c.cast("string").try_cast("double"), F.lit(None).cast("double"))  # the text is read once


def safe_int(c: Column, to: str = "bigint") -> Column:
    """Truncating integer; bad text, NaN and overflow become NULL."""
    return safe_double(c).try_cast(to)


def safe_bool(c: Column, default: bool = False) -> Column:
    return F.coalesce(c.cast("string").try_cast("boolean"), F.lit(default))


def truthy(c: Column) -> Column:
    """Spoken booleans of uploaded rows; anything unknown is false."""
    return F.coalesce(F.lower(c.cast("string")).isin(*TRUE_WORDS), F.lit(False))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def clip(c: Column, lo: float, hi: float) -> Column:
    """NULL stays NULL (``greatest``/``least`` alone would skip it)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi))))


def sigmoid(c: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-clip(c, -20.0, 20.0)))


def closeness(c: Column, target) -> Column:
    return clip(1.0 - F.abs(c - target) / 4.0, 0.0, 1.0)


def popularity_unit(c: Column) -> Column:
    return clip(F.coalesce(c.cast("double"), F.lit(0.0)), 0.0, 100.0) / 100.0


def zero_if_null(c: Column) -> Column:
    return F.coalesce(safe_double(c), F.lit(0.0))


def normalise(cols: list[Column]) -> list[Column]:
    """Divide by the row sum; a zero sum counts as 1."""
    total = sum(cols[1:], cols[0])
    total = F.when(total == 0.0, 1.0).otherwise(total)
    return [c / total for c in cols]


def argmax_name(cols: list[Column], names: list[str]) -> Column:
    """Name of the largest value, the first one on ties; NULLs never win."""
    values = F.array(*cols)
    return F.element_at(
        F.array(*[F.lit(n) for n in names]),
        F.array_position(values, F.array_max(values)).cast("int"),
    )


def bucket3(c: Column) -> Column:
    low, mid = BUCKET_EDGES
    return F.when(c < low, BUCKETS[0]).when(c < mid, BUCKETS[1]).otherwise(BUCKETS[2])


def one_hot_buckets(c: Column, prefix: str) -> dict[str, Column]:
    return {f"{prefix}_bucket_{b}": (bucket3(c) == b).cast("double") for b in BUCKETS}


def zscore(c: Column, mean, std) -> Column:
    return (c - mean) / std


def unscale(c: Column, mean, std) -> Column:
    return c * std + mean


def spec_rate(speechiness: Column, duration_ms: Column) -> Column:
    return speechiness / F.greatest(duration_ms.cast("double"), F.lit(1.0))
