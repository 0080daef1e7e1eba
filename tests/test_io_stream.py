import datetime as dt

from pyspark.sql import functions as F

from hazelake.functions.sqlfuncs import register_sql_functions
from hazelake.session import scratch_path
from hazelake.sources import listing
from hazelake.streaming import readings as RS


def test_sql_functions(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT hz_aqi_pm25(12.0D) AS a, hz_aqi_pm25(12.05D) AS b, hz_aqi_level_pm25(600D) AS l, "
                  "hz_aqi_category(160) AS c, hz_aqi_pm10(-1D) AS n").first()
    assert (r.a, r.b, r.l, r.c, r.n) == (50, None, "Hazardous", "Unhealthy", None)


def test_layouts_and_probe(spark):
    keys = spark.createDataFrame([
        ("b/year=2025/locationid=1/month=07/day=03/location-1-20250703.csv.gz",),
        ("b/year=2025/month=07/day=04/locationid=2/location-2-20250704.csv.gz",),
        ("b/year=2025/locationid=1/month=07/location-1-20250705.csv.gz",),
        ("b/year=2025/locationid=1/month=07/readme.txt",)], "key string")
    got = {r.key.split("/")[-1]: (r.location_id, str(r.run_date), r.layout)
           for r in listing.resolve_layout(keys).collect()}
    assert got["location-1-20250703.csv.gz"] == ("1", "2025-07-03", 1)
    assert got["location-2-20250704.csv.gz"] == ("2", "2025-07-04", 2)
    assert got["location-1-20250705.csv.gz"] == ("1", "2025-07-05", 3)
    assert got["readme.txt"][1] == "None"
    inv = listing.partition_inventory(keys).collect()
    assert len(inv) == 3
    r = listing.resolve_layout(keys)
    assert listing.has_data(r, "2", dt.date(2025, 7, 4)) and not listing.has_data(r, "2", dt.date(2025, 7, 5))


def test_kafka_records_round_trip(spark):
    from hazelake import schemas
    row = ("2025-01-01T00:00:00", "1", "n", "l", "c", "VN", (1.0, 2.0), False, True, [],
           dt.datetime(2025, 1, 1, 0, 0, 0, 123456), 7)
    m = spark.createDataFrame([row], schemas.LANDED_MESSAGE)
    rec = RS.to_kafka_records(m)
    back = rec.select("key", F.from_json("value", schemas.LANDED_MESSAGE,
                                         {"timestampFormat": RS.TS_FORMAT}).alias("m")).first()
    assert back.key == "1" and back.m.event_id == 7 and back.m.ingest_ts.microsecond == 123456


def test_hourly_window_stream(spark):
    src, out, ck = scratch_path(spark, "hw-src"), scratch_path(spark, "hw-out"), scratch_path(spark, "hw-ck")
    rows = [("1", "aqi", 10.0, dt.datetime(2025, 1, 1, 0, 10)), ("1", "aqi", 30.0, dt.datetime(2025, 1, 1, 0, 50)),
            ("1", "aqi", 50.0, dt.datetime(2025, 1, 1, 1, 5))]
    schema = "location_id string, parameter string, value double, measurement_time timestamp"
    spark.createDataFrame(rows, schema).write.parquet(src)
    RS.hourly_window_update(spark.readStream.schema(schema).parquet(src), out, ck)
    got = {r.window_start.hour: (r.value_min, r.value_max, r.value_count) for r in RS.latest_windows(spark, out).collect()}
    assert got == {0: (10.0, 30.0, 2), 1: (50.0, 50.0, 1)}


def test_streaming_jobs_resume_without_realerting(spark):
    from hazelake.sources.fixtures import messages
    from hazelake.streaming import jobs
    from conftest import SF_SMALL
    m = messages(spark, SF_SMALL)
    src, out, ck = scratch_path(spark, "job-src"), scratch_path(spark, "job-out"), scratch_path(spark, "job-ck")
    cut = m.agg(F.expr("percentile_approx(ingest_ts, 0.5)")).first()[0]
    RS.land_messages(m.where(F.col("ingest_ts") <= cut), src)
    jobs.start_readings(spark, jobs.message_source(spark, "json", src), out, ck).awaitTermination()
    RS.land_messages(m.where(F.col("ingest_ts") > cut), src, mode="append")
    jobs.start_readings(spark, jobs.message_source(spark, "json", src), out, ck).awaitTermination()
    res = spark.read.parquet(out)
    total = RS.message_to_readings(m).count()
    assert res.count() == total                                   # every reading stored once
    per_slot = res.where("alerted").groupBy("location_id", "slot_date", "slot_hour").count()
    assert per_slot.where("count > 1").count() == 0               # never twice in a slot
    from hazelake.operators.alerts import first_in_slot
    assert res.where("alerted").count() == first_in_slot(RS.message_to_readings(m)).count()
    arch_out, arch_ck = scratch_path(spark, "job-arch"), scratch_path(spark, "job-arch-ck")
    jobs.start_archive(spark, jobs.message_source(spark, "json", src), arch_out, arch_ck).awaitTermination()
    assert spark.read.json(arch_out).count() == m.count()


def test_scale_conf_and_text_recipients(spark):
    from hazelake.session import scale_conf
    from hazelake.sources import recipients
    conf = scale_conf(100 * 1024 ** 4)
    assert int(conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) == 409600
    path = scratch_path(spark, "rcpt-txt")
    spark.createDataFrame([("# team list",), ("a@x.vn, b@y.vn",), ("bad", ), ("a@x.vn",)], "value string") \
         .coalesce(1).write.text(path)
    got = recipients.clean_recipients(recipients.read_recipients_text(spark, path))
    assert sorted(r.email for r in got.collect()) == ["a@x.vn", "b@y.vn"]


def test_kafka_archive_rows(spark):
    from hazelake import schemas
    from hazelake.streaming.jobs import kafka_archive_rows
    row = ("2025-01-01T05:30:00Z", "7", "n", "l", "c", "VN", (1.0, 2.0), False, True, [],
           dt.datetime(2025, 1, 1, 6, 0), 42)
    m = spark.createDataFrame([row], schemas.LANDED_MESSAGE).withColumn("_partition", F.lit(2)) \
             .withColumn("_key", F.lit("7"))
    r = kafka_archive_rows(m).first()
    assert (r.year, r.month, r.day, r.hour) == ("2025", "01", "01", "05")
    meta = r._kafka_metadata
    assert (meta.partition, meta.offset, meta.key) == (2, 42, "7")
    assert "_partition" not in kafka_archive_rows(m).columns


def test_decode_kafka_records(spark):
    from hazelake.streaming.jobs import decode_kafka
    value = ('{"timestamp": "2025-01-01T05:30:00", "location_id": "7", "sensors": '
             '[{"parameter": "aqi", "unit": "AQI", "latest_value": 180.0, '
             '"latest_datetime": "2025-01-01T00:10:00Z"}]}')
    raw = spark.createDataFrame([(bytearray(b"7"), bytearray(value.encode()), 1, 99, dt.datetime(2025, 1, 1, 0, 11))],
                                "key binary, value binary, partition int, offset long, timestamp timestamp")
    m = decode_kafka(raw)
    r = m.first()
    assert (r.location_id, r.event_id, r._partition, r._key) == ("7", 99, 1, "7")
    rd = RS.message_to_readings(m.drop("_partition", "_key")).first()
    assert rd.value == 180.0 and str(rd.measurement_time) == "2025-01-01 00:10:00"


def test_hourly_window_drops_late_data(spark):
    src, out, ck = scratch_path(spark, "wm-src"), scratch_path(spark, "wm-out"), scratch_path(spark, "wm-ck")
    schema = "location_id string, parameter string, value double, measurement_time timestamp"

    def run():
        RS.hourly_window_update(spark.readStream.schema(schema).parquet(src), out, ck)

    t = lambda h, m: dt.datetime(2025, 1, 1, h, m)
    spark.createDataFrame([("1", "aqi", 1.0, t(9, 5)), ("1", "aqi", 2.0, t(12, 30))], schema) \
         .write.mode("append").parquet(src)
    run()                                               # watermark now 12:30 - 2 h = 10:30
    spark.createDataFrame([("1", "aqi", 100.0, t(9, 20)), ("1", "aqi", 5.0, t(11, 15))], schema) \
         .write.mode("append").parquet(src)
    run()
    run()                                               # lets the advanced watermark take effect
    got = {r.window_start.hour: (r.value_max, r.value_count) for r in RS.latest_windows(spark, out).collect()}
    assert got[9] == (1.0, 1)                           # the 09:20 reading arrived too late
    assert got[11] == (5.0, 1) and got[12] == (2.0, 1)


def test_apply_scale_conf_keeps_cluster_values(spark):
    from hazelake.session import apply_scale_conf
    before = spark.conf.get("spark.sql.shuffle.partitions")          # set explicitly by the test session
    applied = apply_scale_conf(spark, 10 * 1024 ** 3)
    assert "spark.sql.shuffle.partitions" not in applied
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert applied["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "40"


def test_jobs_keep_malformed_records_apart(spark):
    """Good and bad rows of one stream, both jobs; a landing file with a broken line, and Kafka records."""
    from hazelake.streaming import jobs
    good = ('{"timestamp": "2025-01-01T00:10:00", "location_id": "7", "sensors": [{"unit": "AQI", "latest_value": 180.0}], '
            '"ingest_ts": "2025-01-01T00:11:00.000000Z", "event_id": 5}')
    src = scratch_path(spark, "bad-src")
    spark.createDataFrame([(good,), (good[:40],), ("[]",)], "value string").coalesce(1).write.text(src)
    for start, count in ((jobs.start_readings, lambda o: spark.read.parquet(o).count()), (jobs.start_archive, lambda o: spark.read.json(o).count())):
        out, ck = scratch_path(spark, "bad-out"), scratch_path(spark, "bad-ck")
        start(spark, jobs.message_source(spark, "json", src), out, ck).awaitTermination()
        errors = spark.read.parquet(f"{out}_errors").collect()
        assert count(out) == 1 and good[:40] in {r.raw for r in errors}
    records = spark.createDataFrame([(b"7", good.encode(), "air", 2, 10, dt.datetime(2025, 1, 1)), (b"7", b"{oops", "air", 2, 11, dt.datetime(2025, 1, 1)),
                                     (b"7", None, "air", 0, 12, dt.datetime(2025, 1, 1))], "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    messages, errors = RS.split_bad(jobs.decode_kafka(records))
    assert [(r.event_id, r._partition) for r in messages.collect()] == [(10, 2)]
    assert sorted((r.topic, r.partition, r.offset, r.raw) for r in errors.select("topic", "partition", "offset", F.coalesce("raw", F.lit("")).alias("raw")).collect()) == \
        [("air", 0, 12, ""), ("air", 2, 11, "{oops")]
