"""Outlier filters (C11, C12, C13). Statistics per group, joined back to every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake import constants as K
from hazelake.operators.quantiles import group_quantiles

RUN_KEYS = ["location_id", "run_date"]


def iqr_bounds(df: DataFrame, keys: list[str], value="value", multiplier=K.IQR_MULTIPLIER) -> DataFrame:
    q = group_quantiles(df, keys, value, {"_q1": 0.25, "_q3": 0.75})
    iqr = F.col("_q3") - F.col("_q1")
    return q.select(*keys, "_n",
                    (F.col("_q1") - F.lit(multiplier) * iqr).alias("_lower"),
                    (F.col("_q3") + F.lit(multiplier) * iqr).alias("_upper"))


def remove_outliers_iqr(df: DataFrame, keys=RUN_KEYS, value="value",
                        min_rows=K.IQR_MIN_ROWS, multiplier=K.IQR_MULTIPLIER) -> DataFrame:
    """C11: per run (location, run date), only when the run has more than `min_rows` rows,
    keep Q1 - m*IQR <= value <= Q3 + m*IQR (quartiles over all parameters of the run).
    The row guard counts non-NULL values; in the pipeline this step follows the range check,
    which has already removed NULL values."""
    b = iqr_bounds(df, list(keys), value, multiplier)
    v = F.col(value)
    j = df.join(b, list(keys), "left")
    keep = (F.coalesce(F.col("_n"), F.lit(0)) <= min_rows) | ((v >= F.col("_lower")) & (v <= F.col("_upper")))
    return j.where(keep).select(*df.columns)


def _keyed(df: DataFrame, keys) -> tuple[DataFrame, list[str]]:
    """Whole-frame statistics use a constant key, so the join stays an equi-join."""
    keys = list(keys)
    if keys:
        return df, keys
    return df.withColumn("_all", F.lit(0)), ["_all"]


def remove_outliers_iqr_param(df: DataFrame, keys=("parameter",), value="value",
                              multiplier=K.IQR_MULTIPLIER) -> DataFrame:
    """No row guard, multiplier as a parameter, any grouping (default per parameter)."""
    cols = df.columns
    df, keys = _keyed(df, keys)
    b = iqr_bounds(df, keys, value, multiplier)
    v = F.col(value)
    j = df.join(b, keys, "left")
    return j.where((v >= F.col("_lower")) & (v <= F.col("_upper"))).select(*cols)


def remove_outliers_zscore(df: DataFrame, keys=("parameter",), value="value",
                           threshold=K.ZSCORE_THRESHOLD) -> DataFrame:
    """Keep |(x - mean) / sample std| < threshold; std = 0 keeps the group unchanged;
    a one-row group has NULL std and is dropped (NaN in the source)."""
    cols = df.columns
    df, keys = _keyed(df, keys)
    stats = df.groupBy(*keys).agg(F.avg(value).alias("_mu"), F.stddev_samp(value).alias("_sd"))
    j = df.join(stats, keys, "left")
    z = F.abs((F.col(value) - F.col("_mu")) / F.col("_sd"))
    keep = F.when(F.col("_sd") == 0, F.lit(True)).otherwise(z < F.lit(threshold))
    return j.where(keep).select(*cols)
