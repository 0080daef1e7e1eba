"""Range checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazelake import constants as K


def _bounds(key: Column, ranges: dict) -> tuple[Column, Column]:
    lo = hi = None
    for p, (a, b) in ranges.items():
        lo = F.when(key == p, F.lit(float(a))) if lo is None else lo.when(key == p, F.lit(float(a)))
        hi = F.when(key == p, F.lit(float(b))) if hi is None else hi.when(key == p, F.lit(float(b)))
    return lo, hi


def in_range(parameter="parameter", value="value", ranges=K.PIPELINE_RANGES) -> Column:
    """Not NULL, and inside the inclusive range when the lower-cased parameter is listed."""
    v = F.col(value)
    lo, hi = _bounds(F.lower(F.col(parameter)), ranges)
    return v.isNotNull() & (lo.isNull() | ((v >= lo) & (v <= hi)))


def validate_ranges(df: DataFrame, parameter="parameter", value="value") -> DataFrame:
    """Drop NULL values and listed parameters outside their range; unknown parameters pass."""
    return df.where(in_range(parameter, value))


def validate_nonzero(df: DataFrame, parameter="parameter", value="value") -> DataFrame:
    """As C8 and also drop zeros."""
    return df.where(in_range(parameter, value) & (F.col(value) != 0))


def range_key(parameter) -> Column:
    p = F.col(parameter) if isinstance(parameter, str) else parameter
    return F.regexp_replace(F.lower(p), r"[.\-]", "")


def is_value_valid(parameter="parameter", value="value") -> Column:
    """Rules table, key without '.'/'-', unknown -> [0, inf); NULL value -> false."""
    v = F.col(value) if isinstance(value, str) else value
    lo, hi = _bounds(range_key(parameter), K.RULE_RANGES)
    lo = F.coalesce(lo, F.lit(0.0))
    return F.coalesce(v.isNotNull() & (v >= lo) & (hi.isNull() | (v <= hi)), F.lit(False))
