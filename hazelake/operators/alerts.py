"""Alert decisions and roll-ups on readings (T4 batch form, A17, P10).

Slots are one local hour (UTC+7) starting at each configured hour; the first reading
above the threshold in a slot, by arrival order, raises the alert — at most one per
(station, parameter, local date, slot). The first candidate per slot is an aggregate
(min over the arrival order), so a busy slot is combined map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake import constants as K
from hazelake.functions.aqi import level_ladder
from hazelake.functions.text import alert_body, alert_subject, location_info, summary_subject

SLOT_KEYS = ["location_id", "parameter", "slot_date", "slot_hour"]


def with_slot(readings: DataFrame, arrival="created_at") -> DataFrame:
    local = F.col(arrival) + F.make_interval(hours=F.lit(K.LOCAL_OFFSET_HOURS))
    h = F.hour(local)
    return (readings.withColumn("slot_date", F.to_date(local))
                    .withColumn("slot_hour", F.when(h.isin(K.ALERT_SLOT_HOURS), h)))


def candidates(readings: DataFrame, threshold=K.STREAM_AQI_THRESHOLD, arrival="created_at") -> DataFrame:
    s = with_slot(readings, arrival)
    return s.where(F.col("slot_hour").isNotNull() & F.col("value").isNotNull()
                   & (F.col("value") > F.lit(float(threshold))))


def first_in_slot(readings: DataFrame, threshold=K.STREAM_AQI_THRESHOLD, arrival="created_at",
                  order=("created_at", "event_id")) -> DataFrame:
    """Alert rows: one per slot, the earliest candidate by arrival order."""
    c = candidates(readings, threshold, arrival)
    rest = [x for x in c.columns if x not in SLOT_KEYS]
    return (c.groupBy(*SLOT_KEYS).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_a"))
              .select(*SLOT_KEYS, "_a.*"))


def position_columns(readings: DataFrame) -> list[str]:
    return [c for c in ("kafka_partition", "sensor_position") if c in readings.columns]


def alert_keys(readings: DataFrame) -> list[str]:
    """What names one reading: offsets repeat across topic partitions, and a message may hold
    several sensors, so the event id alone does not."""
    return ["location_id", "parameter", "created_at", "event_id", *position_columns(readings)]


def flag_readings(readings: DataFrame, threshold=K.STREAM_AQI_THRESHOLD) -> DataFrame:
    """Every reading kept, `alerted` set on the first candidate of each slot (K8 rows)."""
    return mark(readings, first_in_slot(readings, threshold, order=arrival_order(readings)))


def arrival_order(readings: DataFrame) -> tuple[str, ...]:
    return ("created_at", "event_id", *position_columns(readings))


def mark(readings: DataFrame, alerts: DataFrame) -> DataFrame:
    """`alerted` and `alert_sent_at` of every reading, given the readings that raise alerts. The columns
    that name a reading may be NULL (a file source has no topic partition)."""
    keys = alert_keys(readings)
    hits = alerts.select(*[F.col(k).alias(f"_hit_{k}") for k in keys], F.lit(True).alias("_hit"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hit_{k}")) for k in keys])
    return (readings.join(hits, same, "left")
                    .withColumn("alerted", F.coalesce(F.col("_hit"), F.lit(False)))
                    .withColumn("alert_sent_at", F.when(F.col("alerted"), F.col("created_at")))
                    .select(*readings.columns, "alerted", "alert_sent_at"))


def alert_rollup(alerts: DataFrame) -> DataFrame:
    """Per station: alerts, highest AQI, level of the first highest row, first pollutant."""
    lvl = level_ladder(F.col("value"), K.LEVELS_VI)
    first_key = F.struct(F.col("value"), -F.unix_micros(F.col("created_at")), -F.col("event_id"))
    order = F.struct("created_at", "event_id")
    return alerts.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("num_exceeded"), F.max("value").alias("max_aqi"),
        F.max_by(lvl, first_key).alias("max_aqi_level"),
        F.min_by(F.col("main_pollutant"), order).alias("main_pollutant"))


def alert_text(alerts: DataFrame) -> DataFrame:
    """P10: subject and location line of each alert."""
    return alerts.select("event_id", alert_subject("location_name", "value", "main_pollutant").alias("subject"),
                         location_info("location_name", "locality", "country").alias("location_info"),
                         level_ladder(F.col("value"), K.LEVELS_VI).alias("aqi_level"))


def alert_bodies(alerts: DataFrame, threshold=K.STREAM_AQI_THRESHOLD) -> DataFrame:
    """P10: plain text of each alert."""
    place = location_info("location_name", "locality", "country")
    level = level_ladder(F.col("value"), K.LEVELS_VI)
    return alerts.select("event_id", alert_body(place, "value", level, F.upper("parameter"), "value", "unit", F.lit(float(threshold)),
                                                "measurement_time").alias("body"))


def alert_summaries(alerts: DataFrame) -> DataFrame:
    """P10: one subject for all alerts of a station."""
    order = F.struct("created_at", "event_id")
    names = alerts.groupBy("location_id").agg(F.min_by("location_name", order).alias("location_name"))
    return alert_rollup(alerts).join(names, "location_id").select(
        "location_id", "num_exceeded", "max_aqi", summary_subject("num_exceeded", "location_name", "max_aqi", "main_pollutant").alias("subject"))
