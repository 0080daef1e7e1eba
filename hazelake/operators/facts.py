"""Gold facts and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake import constants as K
from hazelake.functions.aqi import view_level
from hazelake.functions.timeparse import dim_time_parts
from hazelake.operators.quantiles import group_quantiles, hot_groups, interpolated, known, value_list

HOURLY_KEYS = ["location_id", "date", "hour", "parameter"]
DAILY_KEYS = ["location_id", "date", "parameter"]
STAT_COLS = ["value_min", "value_max", "value_avg", "value_median", "value_count", "value_std"]


def exact_sum(v):
    """Order-independent sum: DECIMAL addition is exact, so every partitioning, retry or
    engine gives the same total (a double sum depends on the order of additions). NULL where a
    value does not fit 20 digits before and 18 after the point."""
    fits = F.sum(F.when(v.isNotNull() & v.try_cast("decimal(38,18)").isNull(), 1).otherwise(0)) == 0
    return F.when(fits, F.try_sum(v.try_cast("decimal(38,18)")))


def full_mean(sum_col: str, count_col: str, mean_col: str):
    """Mean at full double precision: of the exact sum, or the plain mean where there is none."""
    exact = F.when(F.col(count_col) > 0, F.col(sum_col).cast("double") / F.col(count_col))
    return F.coalesce(exact, F.col(mean_col))


def _stats(silver: DataFrame, keys: list[str], value="value", median=True) -> DataFrame:
    """One aggregate over the rows, the median included, unless a group is too large for one task: then the
    medians come from `group_quantiles`. Nothing is stored either way but the hot groups' bounds."""
    base = known(silver, keys)  # pandas groupby drops NULL keys
    v = F.col(value)
    hot = hot_groups(base, keys, value) if median else None
    aggs = [F.min(v).alias("value_min"), F.max(v).alias("value_max"), exact_sum(v).alias("_sum"), F.avg(v).alias("_avg"),
            F.count(v).alias("value_count"), F.stddev_samp(v).alias("value_std")]
    if median and hot is None:
        aggs.append(value_list(value).alias("_values"))
    out = base.groupBy(*keys).agg(*aggs).withColumn("value_avg", full_mean("_sum", "value_count", "_avg")).drop("_sum", "_avg")
    if not median:
        return out
    if hot is None:
        return out.withColumn("value_median", interpolated(F.col("_values"), 0.5)).select(*keys, *STAT_COLS)
    med = group_quantiles(base, keys, value, {"value_median": 0.5}, with_count=False)
    return out.join(med, keys, "left").select(*keys, *STAT_COLS)


def hourly_fact(silver: DataFrame, keys=HOURLY_KEYS, value="value") -> DataFrame:
    """A1: min, max, mean, median, non-NULL count, sample std per (location, date, hour, parameter).
    Groups span all files of a station, so a day-edge hour coming from two runs merges correctly."""
    return _stats(silver, list(keys), value)


def daily_fact(silver: DataFrame, keys=DAILY_KEYS, value="value") -> DataFrame:
    """A2: as A1 per (location, date, parameter), computed from rows (median/std do not compose)."""
    return _stats(silver, list(keys), value)


def local_hour_parts(df: DataFrame, text="datetime_text") -> DataFrame:
    """A3 helper: date and hour as written (offset-local), read from the ISO text."""
    t = F.col(text)
    return (df.withColumn("date", F.to_date(F.substring(t, 1, 10)))
              .withColumn("hour", F.substring(t, 12, 2).try_cast("int")))


def hourly_all(df: DataFrame, value="value") -> DataFrame:
    """A3: v1 hourly fact over all parameters (no std), local hour as written."""
    keys = ["location_id", "date", "hour"]
    st = _stats(df, keys, value)
    return st.select(*keys, "value_min", "value_max", "value_avg", "value_median", "value_count")


def daily_all(df: DataFrame, value="value") -> DataFrame:
    keys = ["location_id", "date"]
    st = _stats(df, keys, value)
    return st.select(*keys, "value_min", "value_max", "value_avg", "value_median", "value_count")


def group_size(df: DataFrame, keys=("location_id", "date", "parameter")) -> DataFrame:
    """A4: without a value column the fact is a row count per group."""
    base = df
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    return base.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


# ----------------------------------------------------------------- dimensions
def dim_location(silver: DataFrame) -> DataFrame:
    """One row per station with its constants."""
    return (silver.select("location_id").where(F.col("location_id").isNotNull()).distinct()
            .select("location_id",
                    F.concat(F.lit("Location "), F.col("location_id")).alias("location_name"),
                    F.lit(K.DIM_CITY).alias("city"), F.lit(K.DIM_COUNTRY).alias("country"),
                    F.lit(None).cast("double").alias("latitude"),
                    F.lit(None).cast("double").alias("longitude")))


def dim_parameter(silver: DataFrame) -> DataFrame:
    """Distinct parameters, upper-cased name, target unit."""
    return (silver.select("parameter").where(F.col("parameter").isNotNull()).distinct()
            .select("parameter", F.upper("parameter").alias("parameter_name"),
                    F.lit(K.TARGET_UNIT).alias("unit"),
                    F.lit(None).cast("string").alias("description")))


def dim_time(silver: DataFrame, date_col="run_date") -> DataFrame:
    """D3: one row per run date with calendar parts."""
    d = (silver.select(F.col(date_col).alias("date")).where(F.col("date").isNotNull()).distinct())
    return d.select("date", *dim_time_parts("date"))


# ----------------------------------------------------------------- star view
def gold_aqi_summary(daily: DataFrame, dim_loc: DataFrame, dim_t: DataFrame) -> DataFrame:
    """Daily fact LEFT JOIN dim_location LEFT JOIN dim_time, with the PM2.5 level label.
    Dimension sides are left to AQE, which broadcasts them only when their measured size fits."""
    d = daily.alias("d")
    l = dim_loc.select("location_id", "location_name", "city").alias("l")
    t = dim_t.select("date", "day_of_week", "is_weekend").alias("t")
    j = d.join(l, F.col("d.location_id") == F.col("l.location_id"), "left") \
         .join(t, F.col("d.date") == F.col("t.date"), "left")
    return j.select(
        F.col("d.date").alias("date"), F.col("d.parameter").alias("parameter"),
        F.col("d.value_avg").alias("daily_avg"), F.col("d.value_max").alias("daily_max"),
        F.col("d.value_min").alias("daily_min"), F.col("d.value_count").alias("measurement_count"),
        F.col("l.location_name").alias("location_name"), F.col("l.city").alias("city"),
        F.col("t.day_of_week").alias("day_of_week"), F.col("t.is_weekend").alias("is_weekend"),
        view_level(F.col("d.parameter"), F.col("d.value_avg")).alias("aqi_level")).orderBy(F.col("date").desc())
