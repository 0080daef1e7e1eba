"""Ordered de-duplication.

"Keep first/last" is an aggregate (`min_by`/`max_by` over the scan order), so a key
with millions of copies collapses map-side before the shuffle; "drop all copies"
is a per-key count, also combined map-side. No group is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AUTO_KEYS = ["location_id", "datetime", "parameter", "timestamp"]
PIPELINE_KEYS = ["location_id", "datetime", "parameter"]
ORDER_COLS = ["_file", "_ord"]


def pipeline_keys(df: DataFrame) -> list[str]:
    """Pipeline rule: (location_id, datetime, parameter) when present, else the first three columns."""
    if all(c in df.columns for c in PIPELINE_KEYS):
        return list(PIPELINE_KEYS)
    return [c for c in df.columns if c not in ORDER_COLS][:3]


def auto_keys(df: DataFrame) -> list[str]:
    """Helper rule: whichever of location_id, datetime, parameter, timestamp exist."""
    ks = [c for c in AUTO_KEYS if c in df.columns]
    return ks or [c for c in df.columns if c not in ORDER_COLS][:3]


def _with_order(df: DataFrame, order: list[str]) -> tuple[DataFrame, list[str]]:
    if all(c in df.columns for c in order):
        return df, order
    # scan order stand-in for inputs without lineage columns
    return df.withColumn("_ord", F.monotonically_increasing_id()), ["_ord"]


def dedupe(df: DataFrame, keys: list[str] | None = None, keep="first",
           order: list[str] | None = None) -> DataFrame:
    """keep = 'first' | 'last' | False. NULL keys compare equal (as in pandas)."""
    cols = df.columns
    keys = list(keys) if keys else pipeline_keys(df)
    df, order = _with_order(df, list(order or ORDER_COLS))
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest)
    by = F.struct(*order)
    if keep == "first":
        agg = df.groupBy(*keys).agg(F.min_by(row, by).alias("_row"))
    elif keep == "last":
        agg = df.groupBy(*keys).agg(F.max_by(row, by).alias("_row"))
    elif keep is False or keep == "none":
        agg = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min_by(row, by).alias("_row"))
                 .where(F.col("_n") == 1))
    else:
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    return agg.select(*keys, "_row.*").select(*cols)
