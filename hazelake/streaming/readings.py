"""Message stream -> readings (T1, T2, T5, T7, K6, K8) and a tumbling-window hourly twin.

The transforms are plain DataFrame functions, so the same code runs on a bounded
DataFrame (tests, backfills) and on `readStream` (Kafka in production; a JSON file
source with the same schema here, since no Kafka connector is bundled).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hazelake import constants as K
from hazelake import schemas
from hazelake.functions.text import falsy_coalesce
from hazelake.functions.timeparse import parse_utc_chain, partition_keys
from hazelake.operators.facts import exact_sum, full_mean


def message_to_readings(msgs: DataFrame) -> DataFrame:
    """Explode sensors (empty/NULL arrays give no rows), keep AQI-unit sensors,
    base columns, parameter 'aqi', main pollutant fallback, time fallback chain (P3). A reading is named by
    topic partition (NULL from a file source), offset (`event_id`) and its sensor's position in the message."""
    if "_partition" not in msgs.columns:
        msgs = msgs.withColumn("_partition", F.lit(None).cast("int"))
    s = msgs.select("*", F.posexplode("sensors").alias("sensor_position", "s"))
    s = s.where(F.upper(F.col("s.unit")) == "AQI")
    return s.select(
        "location_id", "location_name", "locality", "country", "country_code",
        F.col("coordinates.latitude").alias("latitude"), F.col("coordinates.longitude").alias("longitude"),
        F.lit(K.PROVIDER).alias("provider"), F.lit("aqi").alias("parameter"),
        F.col("s.unit").alias("unit"), F.col("s.latest_value").alias("value"),
        parse_utc_chain(F.col("s.latest_datetime"), F.col("timestamp"),
                        fallback=F.col("ingest_ts")).alias("measurement_time"),
        falsy_coalesce(F.col("s.main_pollutant_display"), F.col("s.main_pollutant")).alias("main_pollutant"),
        F.col("ingest_ts").alias("created_at"), "event_id", F.col("_partition").alias("kafka_partition"), "sensor_position")


def kafka_metadata(msgs: DataFrame, partition="_partition", offset="_offset",
                   timestamp="ingest_ts", key="location_id") -> DataFrame:
    """Transport metadata as one struct column next to the message body."""
    meta = F.struct(F.col(partition).cast("int").alias("partition"), F.col(offset).cast("long").alias("offset"),
                    F.unix_millis(F.col(timestamp)).alias("timestamp"), F.col(key).cast("string").alias("key"))
    return msgs.withColumn("_kafka_metadata", meta)


TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"   # keep microseconds through JSON


def land_messages(msgs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Land fixture messages as JSON lines (the stand-in for a topic); `append` adds new files."""
    msgs.write.mode(mode).option("timestampFormat", TS_FORMAT).json(path)


def read_message_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schemas.LANDED_MESSAGE).option("timestampFormat", TS_FORMAT)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


def run_available_now(df: DataFrame, out: str, checkpoint: str, fmt="parquet",
                      partition_by: list[str] | None = None, options: dict | None = None,
                      output_mode="append") -> None:
    """Drain everything available, then stop (same code path as a continuous trigger)."""
    w = (df.writeStream.format(fmt).outputMode(output_mode)
           .option("checkpointLocation", checkpoint).option("path", out))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def archive_rows(msgs: DataFrame) -> DataFrame:
    """T5 rows: message + metadata, filed per row under year/month/day/hour of its timestamp
    (unparsable -> ingest time)."""
    ts = parse_utc_chain(F.col("timestamp"), fallback=F.col("ingest_ts"))
    for c, kind in (("_partition", "int"), ("_offset", "long")):   # a file source has neither
        if c not in msgs.columns:
            msgs = msgs.withColumn(c, F.lit(None).cast(kind))
    with_meta = kafka_metadata(msgs)
    return with_meta.drop("_partition", "_offset").select("*", *partition_keys(ts))


def split_corrupt(spark: SparkSession, path: str, stream: bool = False, max_files: int | None = None) -> DataFrame:
    """PERMISSIVE JSON read; malformed lines land in `_corrupt_record` instead of failing."""
    schema = StructType([*schemas.LANDED_MESSAGE.fields, StructField("_corrupt_record", StringType())])
    r = (spark.readStream if stream else spark.read).schema(schema).option("timestampFormat", TS_FORMAT) \
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


def split_bad(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages, errors) of one micro-batch: a record that is no message is kept with its topic, partition
    and offset, as it came."""
    bad = F.col("_corrupt_record").isNotNull() | F.coalesce(F.col("_empty"), F.lit(False)) if "_empty" in batch.columns else F.col("_corrupt_record").isNotNull()

    def column(name, kind):
        return (F.col(name) if name in batch.columns else F.lit(None)).cast(kind)
    errors = batch.where(bad).select(column("_topic", "string").alias("topic"), column("_partition", "int").alias("partition"),
                                     F.col("event_id").alias("offset"), "ingest_ts", F.col("_corrupt_record").alias("raw"))
    return batch.where(~bad).drop("_corrupt_record", "_empty", "_topic"), errors


def hourly_window(readings: DataFrame, watermark="2 hours") -> DataFrame:
    """Streaming twin of the hourly fact: 1-hour tumbling windows per station (algebraic stats)."""
    return (readings.withWatermark("measurement_time", watermark)
                    .groupBy("location_id", "parameter", F.window("measurement_time", "1 hour").alias("w"))
                    .agg(F.min("value").alias("value_min"), F.max("value").alias("value_max"),
                         exact_sum(F.col("value")).alias("_sum"), F.avg("value").alias("_avg"),
                         F.count("value").alias("value_count"))
                    .select("location_id", "parameter", F.col("w.start").alias("window_start"),
                            "value_min", "value_max", full_mean("_sum", "value_count", "_avg").alias("value_avg"),
                            "value_count"))


def to_kafka_records(msgs: DataFrame, key="location_id") -> DataFrame:
    """K7: (key, value) records — key = station id, value = the message as JSON text."""
    body = [c for c in msgs.columns]
    return msgs.select(F.col(key).cast("string").alias("key"),
                       F.to_json(F.struct(*body), {"timestampFormat": TS_FORMAT}).alias("value"))


def hourly_window_update(readings: DataFrame, out: str, checkpoint: str, watermark="2 hours") -> None:
    """Run the tumbling-window twin in update mode; every micro-batch appends the windows it
    changed, tagged with the batch id, so the newest version of each window is the answer."""
    agg = hourly_window(readings, watermark)

    def write(batch: DataFrame, batch_id: int) -> None:
        # one folder per batch id, overwritten on replay: a retried micro-batch cannot duplicate
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")

    q = (agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


WINDOW_KEYS = ["location_id", "parameter", "window_start"]


def window_partials(readings: DataFrame) -> DataFrame:
    """What merges of every hour that the readings touch: counts, extremes, exact sum (NULL where it does not fit), mean."""
    v = F.col("value")
    return readings.groupBy("location_id", "parameter", F.date_trunc("hour", "measurement_time").alias("window_start")).agg(
        F.min(v).alias("value_min"), F.max(v).alias("value_max"), exact_sum(v).alias("_sum"), F.avg(v).alias("_avg"), F.count(v).alias("value_count"))


def hourly_partials_update(readings: DataFrame, out: str, checkpoint: str) -> None:
    """The hourly twin without a watermark: every micro-batch files partial aggregates of the hours it touches, late
    ones included, in the folder of its batch id (a replayed batch replaces its own). No state is held and no reading
    is dropped, so the hours equal the batch fact whatever the order of arrival."""
    def write(batch: DataFrame, batch_id: int) -> None:
        part = window_partials(batch).withColumn("window_date", F.to_date("window_start"))
        part.write.mode("overwrite").partitionBy("window_date").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")

    q = readings.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def merged_windows(spark: SparkSession, out: str) -> DataFrame:
    """The hours merged from the partials of all micro-batches."""
    lost = F.sum(((F.col("value_count") > 0) & F.col("_sum").isNull()).cast("int")) > 0
    weighted = F.sum(F.col("_avg") * F.col("value_count")) / F.nullif(F.sum("value_count"), F.lit(0))
    got = spark.read.parquet(out).groupBy(*WINDOW_KEYS).agg(
        F.min("value_min").alias("value_min"), F.max("value_max").alias("value_max"), F.when(~lost, F.try_sum("_sum")).alias("_sum"),
        weighted.alias("_avg"), F.sum("value_count").alias("value_count"))
    return got.select(*WINDOW_KEYS, "value_min", "value_max", full_mean("_sum", "value_count", "_avg").alias("value_avg"), "value_count")


def latest_windows(spark: SparkSession, out: str) -> DataFrame:
    """Newest version of each window written by `hourly_window_update`."""
    df = spark.read.parquet(out)
    keys = ["location_id", "parameter", "window_start"]
    rest = [c for c in df.columns if c not in keys + ["batch_id"]]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch_id")).alias("_w"))
              .select(*keys, "_w.*"))
