"""Time parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazelake import constants as K

DATETIME_ALIASES = ["datetime", "date_utc", "timestamp", "time"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_utc(text) -> Column:
    """ISO text with 'Z', an offset, or naive (= UTC) to a UTC instant; invalid -> NULL.

    Relies on the session time zone being UTC (set by the session helper)."""
    t = _c(text)
    return F.try_to_timestamp(F.nullif(F.trim(t), F.lit("")))


def parse_utc_chain(*texts, fallback=None) -> Column:
    """First parsable text wins, then a fallback instant (ingest time, never now())."""
    parts = [parse_utc(t) for t in texts]
    if fallback is not None:
        parts.append(_c(fallback))
    return F.coalesce(*parts)


def parse_api_ts(text) -> Column:
    """ISO text or Unix seconds."""
    t = _c(text)
    return F.coalesce(parse_utc(t), F.timestamp_seconds(t.try_cast("bigint")))


def add_date_parts(df: DataFrame, ts="datetime", with_names=False) -> DataFrame:
    """C6 parts (date, hour, day_of_week Mon=0); C7 adds day_name and is_weekend."""
    t = F.col(ts)
    parts = {"date": F.to_date(t), "hour": F.hour(t).cast("int"), "day_of_week": F.weekday(t).cast("int")}
    if with_names:
        parts.update({"day_name": F.date_format(t, "EEEE"), "is_weekend": F.weekday(t) >= 5})
    return df.withColumns(parts)


def parse_datetime(df: DataFrame, strict: bool = False) -> DataFrame:
    """Parse every present datetime alias to UTC and add date parts from `datetime`."""
    out = df.withColumns({c: parse_utc(c) for c in DATETIME_ALIASES if c in df.columns})
    if "datetime" in out.columns:
        out = add_date_parts(out, "datetime")
    if strict:
        out = out.withColumn("datetime", F.when(F.col("datetime").isNotNull(), F.col("datetime"))
                             .otherwise(F.raise_error(F.lit("unparsable datetime"))))
    return out


def parse_datetime_helper(df: DataFrame, column="datetime") -> DataFrame:
    """Helper variant with day_name and is_weekend."""
    if column not in df.columns:
        return df
    return add_date_parts(df.withColumn(column, parse_utc(column)), column, with_names=True)


def dim_time_parts(date_col) -> list[Column]:
    """Day, month, year, weekday name, weekend flag, quarter for a date."""
    d = _c(date_col)
    return [F.dayofmonth(d).alias("day"), F.month(d).alias("month"), F.year(d).alias("year"),
            F.date_format(d, "EEEE").alias("day_of_week"),
            (F.weekday(d) >= 5).alias("is_weekend"),
            (F.floor((F.month(d) - 1) / 3) + 1).cast("int").alias("quarter")]


def partition_keys(ts, ingest=None) -> list[Column]:
    """P20: zero-padded year/month/day/hour path parts; unparsable -> ingest time."""
    t = _c(ts) if ingest is None else F.coalesce(_c(ts), _c(ingest))
    return [F.date_format(t, "yyyy").alias("year"), F.date_format(t, "MM").alias("month"),
            F.date_format(t, "dd").alias("day"), F.date_format(t, "HH").alias("hour")]
