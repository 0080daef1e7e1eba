"""Dashboard and serving queries.

"Now" is an explicit as-of instant: by default the newest measurement, taken as a
scalar subquery so the plan stays one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazelake.functions.aqi import band, threshold_flags

SERIES_PARAMETERS = ["pm25", "pm10", "co", "no2", "o3", "so2"]


def as_of(df: DataFrame, ts="measurement_time") -> Column:
    return df.select(F.max(ts)).scalar()


def within(df: DataFrame, ts: str, hours: int, now: Column | None = None) -> DataFrame:
    """Rows of the last `hours` before `now` (default: the newest instant, a scalar subquery over
    the time column alone). Nothing is written: on a stored table the bound reaches its scan."""
    if now is None:
        now = as_of(df, ts)
    return df.where(F.col(ts) > now - F.make_interval(hours=F.lit(hours)))


def series(df: DataFrame, parameter: str, ts="measurement_time", value="value",
           hours: int = 6, now: Column | None = None) -> DataFrame:
    """O1: one parameter over the dashboard window, ordered by time."""
    w = within(df, ts, hours, now).where(F.col("parameter") == parameter)
    return w.select(F.col(ts).alias("time"), F.col(value).alias("value")).orderBy("time")


def series_wide(df: DataFrame, ts="measurement_time", value="value", hours: int = 6,
                now: Column | None = None) -> DataFrame:
    """The six series side by side (max per instant when stations share a timestamp)."""
    w = within(df, ts, hours, now).where(F.col("parameter").isin(SERIES_PARAMETERS))
    return (w.groupBy(F.col(ts).alias("time")).pivot("parameter", SERIES_PARAMETERS).agg(F.max(value)))


def latest_readings(readings: DataFrame, limit: int = 100, hours: int = 24, now: Column | None = None) -> DataFrame:
    """O2: last 24 h, newest first, top 100 (TakeOrderedAndProject), unique tie-break."""
    w = within(readings, "measurement_time", hours, now)
    return (w.orderBy(F.col("measurement_time").desc(), F.col("location_id"), F.col("event_id"))
             .limit(limit)
             .select("location_name", "parameter", "value", "unit", "measurement_time",
                     F.when(F.col("alerted"), F.lit("Có")).otherwise(F.lit("Không")).alias("alerted_label"),
                     "event_id"))


def readings_24h(readings: DataFrame, hours: int = 24, now: Column | None = None) -> DataFrame:
    """Readings in the last 24 h."""
    return within(readings, "measurement_time", hours, now).agg(F.count(F.lit(1)).alias("count"))


def alerts_24h(readings: DataFrame, hours: int = 24, now: Column | None = None) -> DataFrame:
    """Alerted readings in the last 24 h."""
    w = within(readings, "measurement_time", hours, now).where(F.col("alerted"))
    return w.agg(F.count(F.lit(1)).alias("count")).withColumn("band", band("count", "alerts"))


def distinct_parameters(readings: DataFrame) -> DataFrame:
    """A15."""
    return readings.agg(F.count_distinct("parameter").alias("count"))


def latest_daily(daily: DataFrame, limit: int = 5) -> DataFrame:
    """O3: newest daily rows, with a unique tie-break."""
    return (daily.orderBy(F.col("date").desc(), "parameter", "location_id").limit(limit)
                 .select("date", "parameter", "value_avg", "value_max", "location_id"))


def union_files(frames: list[DataFrame]) -> DataFrame:
    """Concatenate per-file frames whose columns differ."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def guideline_exceedance(daily: DataFrame) -> DataFrame:
    """Q11: share of days over the WHO and national daily limits, per station and pollutant."""
    p = F.col("parameter")
    d = daily.where(p.isin("pm25", "pm10")).select("*", *threshold_flags("parameter", "value_avg"))
    who, nat = F.col("over_who"), F.col("over_national")
    return d.groupBy("location_id", "parameter").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum(who.cast("int")).cast("long").alias("days_over_who"),
        F.sum(nat.cast("int")).cast("long").alias("days_over_national"),
        F.round(F.sum(who.cast("int")) / F.count(F.lit(1)) * 100, 2).alias("share_over_who"))


def aqi_exceedance(rows: DataFrame) -> DataFrame:
    """Q11: per station, readings with an AQI, how many pass each alert threshold, and the days with any above the first."""
    flags = ("aqi_unhealthy", "aqi_very_unhealthy", "aqi_hazardous")
    d = rows.where(F.col("aqi").isNotNull()).select("location_id", "date", *threshold_flags("parameter", "value", "aqi")[2:])
    return d.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("readings"), *[F.count_if(F.col(f)).alias(f) for f in flags],
        F.count_distinct(F.when(F.col("aqi_unhealthy"), F.col("date"))).alias("days_unhealthy"))


def band_classify(daily: DataFrame) -> DataFrame:
    """Q12: dashboard colour of each daily PM2.5 / PM10 mean."""
    p = F.col("parameter")
    d = daily.where(p.isin("pm25", "pm10"))
    return d.select("location_id", "date", "parameter", "value_avg",
                    F.when(p == "pm25", band("value_avg", "pm25"))
                     .otherwise(band("value_avg", "pm10")).alias("band"))
