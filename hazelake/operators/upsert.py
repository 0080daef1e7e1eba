"""Keyed upserts (K9) and key constraints.

`upsert` = keep the last update per key (aggregate, map-side combined), then one
full outer join on NULL-safe keys; listed columns take the update (even NULL),
the others keep the target's value; keys only in the updates are inserted whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in updates.columns if c not in keys]
    return (updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_u"))
                   .select(*keys, "_u.*"))


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], update_cols: list[str],
           order: list[str] | None = None) -> DataFrame:
    cols = target.columns
    if order:
        updates = last_per_key(updates, keys, order).select(*cols, *[o for o in order if o not in cols])
    u = updates.select(*cols).withColumn("_in_u", F.lit(True)).alias("u")
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    cond = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"u.{k}")) for k in keys])
    j = t.join(u, cond, "full_outer")
    hit_u = F.col("u._in_u").isNotNull()
    hit_t = F.col("t._in_t").isNotNull()
    out = []
    for c in cols:
        if c in keys:
            out.append(F.when(hit_t, F.col(f"t.{c}")).otherwise(F.col(f"u.{c}")).alias(c))
        elif c in update_cols:
            out.append(F.when(hit_u, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(hit_t, F.col(f"t.{c}")).otherwise(F.col(f"u.{c}")).alias(c))
    return j.select(*out)


HOURLY_KEYS = ["date", "hour", "parameter", "location_id"]
DAILY_KEYS = ["date", "parameter", "location_id"]
FACT_UPDATE = ["value_min", "value_max", "value_avg", "value_median", "value_count", "value_std"]
LOCATION_UPDATE = ["location_name", "city", "country"]
PARAMETER_UPDATE = ["parameter_name", "unit"]
TIME_UPDATE = ["day_of_week", "is_weekend"]


def key_check(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Rows, duplicate keys and rows with a NULL key, as one row per table."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"), F.max(any_null.cast("int")).alias("_nk"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.sum("_c").alias("rows"),
        F.sum(F.when(F.col("_c") > 1, 1).otherwise(0)).cast("long").alias("duplicate_keys"),
        F.sum(F.when(F.col("_nk") == 1, F.col("_c")).otherwise(0)).cast("long").alias("null_keys"))
