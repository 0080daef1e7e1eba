"""Raw API payloads -> MESSAGE rows (S11), on a bounded DataFrame or on a stream over a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hazelake import schemas
from hazelake.functions import text as X
from hazelake.functions.timeparse import parse_api_ts

#: One landed call of the API: the answer's text, when it arrived, and its number.
LANDED_PAYLOAD = "event_id bigint, payload string, ingest_ts timestamp"
_CHECKED = StructType([*schemas.PAYLOAD.fields, StructField("_corrupt_record", StringType())])


def _parsed(payloads: DataFrame, payload: str) -> DataFrame:
    """The payload as a struct `_j`, and `_ok`: JSON that reports success and holds data."""
    j = F.from_json(payload, _CHECKED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    ok = F.col("_j._corrupt_record").isNull() & (F.col("_j.status") == "success") & F.col("_j.data").isNotNull()
    return payloads.withColumn("_j", j).withColumn("_ok", F.coalesce(ok, F.lit(False)))


def payload_to_message(payloads: DataFrame, payload: str = "payload", arrival: str = "ingest_ts") -> DataFrame:
    """The MESSAGE of every payload that reports success, next to the other columns of the input. A message has one
    AQI sensor; its time is the payload's (ISO text or Unix seconds), or the arrival where that cannot be read."""
    p = _parsed(payloads, payload).where("_ok")
    data = F.col("_j.data")
    place, pollution = data["location"]["coordinates"], data["current"]["pollution"]
    measured = F.coalesce(parse_api_ts(pollution["ts"]), F.col(arrival))
    sensor = F.struct(
        F.lit("iqair_aqi").alias("id"), F.lit("AQI (Air Quality Index)").alias("name"), F.lit("aqi").alias("parameter"),
        F.lit("AQI").alias("parameter_display"), F.lit("AQI").alias("unit"), pollution["aqius"].alias("latest_value"),
        F.date_format(measured, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("latest_datetime"),
        F.date_format(measured, "yyyy-MM-dd'T'HH:mm:ssxxx").alias("latest_datetime_local"),
        X.pollutant_code(pollution["mainus"]).alias("main_pollutant"), X.pollutant_display(pollution["mainus"]).alias("main_pollutant_display"))
    kept = [c for c in payloads.columns if c != payload]
    return p.select(
        F.date_format(arrival, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), X.location_slug(data["city"], data["state"]).alias("location_id"),
        X.location_display(data["city"], data["state"]).alias("location_name"), data["city"].alias("locality"), data["country"].alias("country"),
        X.country_code(data["country"]).alias("country_code"),
        F.struct(F.get(place, 1).alias("latitude"), F.get(place, 0).alias("longitude")).alias("coordinates"),
        F.lit(False).alias("is_mobile"), F.lit(True).alias("is_monitor"), F.array(sensor).alias("sensors"), *kept)


def payload_errors(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """The payloads that give no message, as they came: malformed text, or an answer without success."""
    return _parsed(payloads, payload).where("not _ok").withColumn(
        "reason", F.when(F.col("_j._corrupt_record").isNotNull() | F.col("_j.status").isNull(), "malformed").otherwise(F.col("_j.status"))).drop("_j", "_ok")


def read_payload_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A landing folder of API answers, one JSON line for each call."""
    reader = spark.readStream.schema(LANDED_PAYLOAD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)
