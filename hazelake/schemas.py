"""Explicit schemas of every layer (no inference on the hot path)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, LongType, StringType,
                               StructField, StructType, TimestampType)

BRONZE = StructType([
    StructField("location_id", StringType()), StructField("datetime", StringType()),
    StructField("parameter", StringType()), StructField("unit", StringType()),
    StructField("value", DoubleType()),
])

SENSOR = StructType([
    StructField("id", StringType()), StructField("name", StringType()),
    StructField("parameter", StringType()), StructField("parameter_display", StringType()),
    StructField("unit", StringType()), StructField("latest_value", DoubleType()),
    StructField("latest_datetime", StringType()), StructField("latest_datetime_local", StringType()),
    StructField("main_pollutant", StringType()), StructField("main_pollutant_display", StringType()),
])

MESSAGE = StructType([
    StructField("timestamp", StringType()), StructField("location_id", StringType()),
    StructField("location_name", StringType()), StructField("locality", StringType()),
    StructField("country", StringType()), StructField("country_code", StringType()),
    StructField("coordinates", StructType([StructField("latitude", DoubleType()),
                                           StructField("longitude", DoubleType())])),
    StructField("is_mobile", BooleanType()), StructField("is_monitor", BooleanType()),
    StructField("sensors", ArrayType(SENSOR)),
])

# landed message: body plus transport metadata (Kafka timestamp / offset stand-ins)
LANDED_MESSAGE = StructType(MESSAGE.fields + [StructField("ingest_ts", TimestampType()),
                                              StructField("event_id", LongType())])

PAYLOAD = StructType([
    StructField("status", StringType()),
    StructField("data", StructType([
        StructField("city", StringType()), StructField("state", StringType()),
        StructField("country", StringType()),
        StructField("location", StructType([StructField("coordinates", ArrayType(DoubleType()))])),
        StructField("current", StructType([StructField("pollution", StructType([
            StructField("ts", StringType()), StructField("aqius", DoubleType()),
            StructField("mainus", StringType())]))])),
    ])),
])
