"""Derived inputs built by Spark from the driver tables (FIXTURES.md §3–§4).

All of them are projections of `events`, so their size grows with it:
  R  readings with defects (duplicates, NULL/negative/zero/scaled values, three
     datetime spellings, mixed units), carrying run_date, _file and _ord
  M  stream messages (one per event; nested sensors array)
  P  raw API payloads (nested JSON text)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazelake import constants as K
from hazelake.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # driver ts is timestamp_ntz; the session is UTC, so the instant is the same wall clock
    return table(spark, sf_dir, "events")


def _mod(c: str, n: int) -> Column:
    return F.col(c) % n


def bronze_base(ev: DataFrame) -> DataFrame:
    """View B: one bronze row per event."""
    eid, ts = F.col("event_id"), F.col("ts")
    plus7 = ts + F.expr("INTERVAL 7 HOURS")
    parameter = (F.when(_mod("event_id", 50) == 0, "so2")
                 .when(F.col("event_type") == "click", "pm25")
                 .when(F.col("event_type") == "view", "pm10")
                 .when(F.col("event_type") == "purchase", "no2")
                 .when(F.col("event_type") == "signup", "co")
                 .otherwise("o3"))
    dt = (F.when(eid % 3 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
          .when(eid % 3 == 1, F.concat(F.date_format(plus7, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00")))
          .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")))
    unit = (F.when(eid % 10 == 0, "ppb").when(eid % 10 == 1, "ppm")
            .when(eid % 10 == 2, "mg/m³").otherwise("µg/m³"))
    v = F.col("value")
    value = (F.when(eid % 17 == 0, F.lit(None).cast("double"))
             .when(eid % 23 == 0, -v)
             .when(eid % 29 == 0, F.lit(0) * v)
             .when(eid % 41 == 0, v * 20)
             .otherwise(v))
    run_date = F.when(eid % 3 == 1, plus7).otherwise(ts).cast("date")
    return ev.select(
        (F.col("user_id") % 5).cast("string").alias("location_id"),
        parameter.alias("parameter"), dt.alias("datetime"), unit.alias("unit"),
        value.alias("value"), run_date.alias("run_date"),
        F.lit("a").alias("_file"), eid.alias("_ord"))


def readings_with_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View R: B plus a second copy ('b', value + 1) of every 13th row."""
    b = bronze_base(events(spark, sf_dir))
    dup = (b.where(F.col("_ord") % 13 == 0)
            .withColumn("value", F.col("value") + 1)
            .withColumn("_file", F.lit("b")))
    return b.unionByName(dup)


# ---------------------------------------------------------------------------
# M: stream messages
# ---------------------------------------------------------------------------
MAIN_CODES = {"click": "p2", "view": "p1", "purchase": "n2", "signup": "co", "error": "o3"}


def _main_code(event_type: Column) -> Column:
    expr = None
    for k, v in MAIN_CODES.items():
        expr = F.when(event_type == k, v) if expr is None else expr.when(event_type == k, v)
    return expr.otherwise("s2")


def messages(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    """Fixture M with the MESSAGE schema plus `ingest_ts` (Kafka timestamp stand-in) and `event_id`;
    `spread_out`: built by all cores, for landing."""
    from hazelake.functions.text import pollutant_code, pollutant_display
    ev = events(spark, sf_dir)
    if spread_out:
        ev = spread(ev.select("event_id", "user_id", "event_type", "value", "ts"))
    eid, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    loc = (F.col("user_id") % 5)
    code = _main_code(F.col("event_type"))
    sensor = F.struct(
        F.lit("iqair_aqi").alias("id"), F.lit("AQI (Air Quality Index)").alias("name"),
        F.lit("aqi").alias("parameter"), F.lit("AQI").alias("parameter_display"),
        F.when(eid % 7 == 0, F.lit("µg/m³")).otherwise(F.lit("AQI")).alias("unit"),
        (F.col("value") * 4).alias("latest_value"),
        F.when(eid % 19 == 0, F.lit("not-a-time"))
         .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("latest_datetime"),
        F.concat(F.date_format(ts + F.expr("INTERVAL 7 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"),
                 F.lit("+07:00")).alias("latest_datetime_local"),
        pollutant_code(code).alias("main_pollutant"),
        pollutant_display(code).alias("main_pollutant_display"))
    empty = F.array().cast("array<" + _SENSOR_DDL + ">")
    return ev.select(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        loc.cast("string").alias("location_id"),
        F.concat(F.lit("Station "), loc.cast("string")).alias("location_name"),
        F.lit(K.DIM_CITY).alias("locality"), F.lit(K.DIM_COUNTRY).alias("country"),
        F.lit("VN").alias("country_code"),
        F.struct((F.lit(21.0) + loc * F.lit(0.01)).alias("latitude"),
                 (F.lit(105.8) + loc * F.lit(0.01)).alias("longitude")).alias("coordinates"),
        F.lit(False).alias("is_mobile"), F.lit(True).alias("is_monitor"),
        F.when(eid % 31 == 0, empty).otherwise(F.array(sensor)).alias("sensors"),
        ts.alias("ingest_ts"), eid.alias("event_id"))


_SENSOR_DDL = ("struct<id:string,name:string,parameter:string,parameter_display:string,"
               "unit:string,latest_value:double,latest_datetime:string,"
               "latest_datetime_local:string,main_pollutant:string,main_pollutant_display:string>")


# ---------------------------------------------------------------------------
# P: raw API payload text
# ---------------------------------------------------------------------------
def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture P: one nested JSON payload per event; `ts` is Unix seconds when event_id % 5 = 0."""
    ev = events(spark, sf_dir)
    eid, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    ts_text = F.when(eid % 5 == 0, F.unix_timestamp(ts).cast("string")) \
               .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    city = F.concat(F.lit("City "), (F.col("user_id") % 5).cast("string"))
    body = F.struct(
        F.lit("success").alias("status"),
        F.struct(city.alias("city"), F.lit("Ha Noi").alias("state"),
                 F.when(F.col("user_id") % 2 == 0, F.lit("Vietnam")).otherwise(F.lit("Laos")).alias("country"),
                 F.struct(F.array(F.lit(105.8) + (F.col("user_id") % 5) * F.lit(0.01),
                                  F.lit(21.0) + (F.col("user_id") % 5) * F.lit(0.01))
                          .alias("coordinates")).alias("location"),
                 F.struct(F.struct(ts_text.alias("ts"), (F.col("value") * 4).alias("aqius"),
                                   _main_code(F.col("event_type")).alias("mainus")).alias("pollution"))
                 .alias("current")).alias("data"))
    return ev.select(eid.alias("event_id"), F.to_json(body).alias("payload"), ts.alias("ingest_ts"))
