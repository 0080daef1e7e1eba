"""Long-running streaming applications.

    python -m hazelake.streaming.jobs readings --source json --path <landing> --out <dir> --checkpoint <dir>
    python -m hazelake.streaming.jobs archive  --source kafka --bootstrap host:9092 --topic air --out <dir> ...

`readings`: messages -> readings (T1) -> once-per-slot alerts (T4) -> append with flags (K8).
`archive`:  messages + transport metadata (T2) -> gzip JSON filed per hour (T5/K6), flushed by
            size (`max_per_trigger` messages) or age (`trigger` interval) (T3).
Offsets and state live in the checkpoint folder (T6), so a restarted query resumes without
re-alerting. The Kafka source needs the Kafka connector on the classpath; the JSON file
source has the same schema and is what the tests use.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hazelake import schemas
from hazelake.streaming import alert_state
from hazelake.streaming import readings as RS


def message_source(spark: SparkSession, kind: str, path: str | None = None, bootstrap: str | None = None,
                   topic: str | None = None, max_per_trigger: int | None = None) -> DataFrame:
    """A stream of landed messages: MESSAGE columns + ingest_ts + event_id (+ Kafka metadata)."""
    if kind == "kafka":
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
                  .option("subscribe", topic).option("startingOffsets", "earliest"))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        return decode_kafka(r.load())
    return RS.split_corrupt(spark, path, stream=True, max_files=max_per_trigger)


def decode_kafka(raw: DataFrame) -> DataFrame:
    """Kafka records (key, value bytes, partition, offset, timestamp) -> landed messages:
    MESSAGE columns + ingest_ts (broker timestamp) + event_id (offset) + transport metadata. A value that is no message
    is kept as it came in `_corrupt_record`; `_empty` marks a record without a value."""
    schema = StructType([*schemas.MESSAGE.fields, StructField("_corrupt_record", StringType())])
    body = F.from_json(F.col("value").cast("string"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    topic = F.col("topic") if "topic" in raw.columns else F.lit(None).cast("string")
    return raw.select(body.alias("m"), F.col("value").isNull().alias("_empty"), F.col("timestamp").alias("ingest_ts"),
                      F.col("offset").alias("event_id"), F.col("partition").alias("_partition"), topic.alias("_topic"),
                      F.col("key").cast("string").alias("_key")).select("m.*", "ingest_ts", "event_id",
                                                                        "_partition", "_key", "_topic", "_empty")


def _each_batch(source: DataFrame, checkpoint: str, trigger: str | None, out: str, write):
    """One stream written to two tables. What is no message goes to `<out>_errors`, the rest to `write`; both
    under the batch id, in overwrite mode, so a batch that is run again replaces its own output."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if "_corrupt_record" in batch.columns:
                batch, errors = RS.split_bad(batch)
                errors.write.mode("overwrite").parquet(f"{out.rstrip('/')}_errors/batch_id={batch_id}")
            write(batch, batch_id)
        finally:
            batch.unpersist()

    w = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    return (w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)).start()


def start_readings(spark: SparkSession, source: DataFrame, out: str, checkpoint: str, trigger: str | None = None, handler=None):
    """T1 -> T4 -> K8: every reading stored with its alert flag; malformed records go to `<out>_errors`."""
    def write(batch, batch_id):
        alert_state.store_batch(RS.message_to_readings(batch), batch_id, out, handler=handler)
    return _each_batch(source, checkpoint, trigger, out, write)


def start_archive(spark: SparkSession, source: DataFrame, out: str, checkpoint: str, trigger: str | None = None):
    """T2 -> T5/K6: archive every message as gzip JSON under year/month/day/hour (and its batch id)."""
    parts = ["year", "month", "day", "hour", "batch_id"]

    def write(batch, batch_id):
        rows = kafka_archive_rows(batch) if "_partition" in batch.columns else RS.archive_rows(batch)
        # each hour's rows meet before the write: a file per hour, not one per hour and task
        (rows.withColumn("batch_id", F.lit(batch_id)).hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "gzip").option("timestampFormat", RS.TS_FORMAT).partitionBy(*parts).json(out))
    return _each_batch(source, checkpoint, trigger, out, write)


def kafka_archive_rows(src: DataFrame) -> DataFrame:
    """T2 + T5 rows for a Kafka-fed stream: the real partition, offset, timestamp and key as
    `_kafka_metadata`, filed under the message's own year/month/day/hour."""
    from hazelake.functions.timeparse import parse_utc_chain, partition_keys
    meta = RS.kafka_metadata(src.withColumn("_offset", F.col("event_id")), key="_key")
    ts = parse_utc_chain(F.col("timestamp"), fallback=F.col("ingest_ts"))
    return meta.drop("_partition", "_offset", "_key").select("*", *partition_keys(ts))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("job", choices=["readings", "archive"])
    ap.add_argument("--source", choices=["json", "kafka"], default="json")
    ap.add_argument("--path")
    ap.add_argument("--bootstrap")
    ap.add_argument("--topic")
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint", required=True)
    ap.add_argument("--trigger", default="300 seconds", help="processing-time interval; 'once' drains and stops")
    ap.add_argument("--max-per-trigger", type=int, default=100, help="messages (kafka) or files (json) a batch")
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    from hazelake.session import build_session
    spark = build_session(a.master)
    src = message_source(spark, a.source, a.path, a.bootstrap, a.topic, a.max_per_trigger)
    trig = None if a.trigger == "once" else a.trigger
    q = (start_readings if a.job == "readings" else start_archive)(spark, src, a.out, a.checkpoint, trig)
    q.awaitTermination()


if __name__ == "__main__":
    main()
