import datetime as dt

from pyspark.sql import functions as F

from hazelake.functions import text as X
from hazelake.operators.alerts import first_in_slot, flag_readings
from hazelake.operators.upsert import key_check, upsert
from hazelake.session import scratch_path
from hazelake.streaming import alert_state


def test_normalize_param(spark):
    names = ["PM2.5", "pm25 mass", "aqi_us", "aqius", "Carbon_Monoxide"]
    df = spark.createDataFrame([(n,) for n in names], "raw string")
    got = [r.p for r in df.select(X.normalize_param("raw").alias("p")).collect()]
    assert got == ["pm25", "pm25", "aqius", "aqi_us", "co"]


def test_email_valid(spark):
    df = spark.createDataFrame([(e,) for e in ["a@b.c", "a@b", "a.b", "a@b@c.d", "a@b.c@d"]], "e string")
    assert [r.ok for r in df.select(X.email_valid("e").alias("ok")).collect()] == [True, False, False, False, True]


def _readings(spark, rows):
    # rows: (local 'HH:MM' on 2025-07-03 at UTC+7, value, event_id)
    out = []
    for hhmm, v, eid in rows:
        h, m = map(int, hhmm.split(":"))
        local = dt.datetime(2025, 7, 3, h, m)
        utc = local - dt.timedelta(hours=7)
        out.append(("1", "aqi", v, utc, utc, eid, "PM2.5", "Station 1"))
    return spark.createDataFrame(out, "location_id string, parameter string, value double, created_at timestamp, "
                                      "measurement_time timestamp, event_id long, main_pollutant string, "
                                      "location_name string")


T4 = [("07:10", 180.0, 1), ("07:40", 190.0, 2), ("10:40", 190.0, 3), ("17:05", 151.0, 4),
      ("07:00", 150.0, 5), ("08:00", 200.0, 6), ("17:30", None, 7)]


def test_alert_once_per_slot_batch(spark):
    alerts = {r.event_id for r in first_in_slot(_readings(spark, T4)).collect()}
    assert alerts == {1, 4}


def test_flags_of_one_batch(spark):
    out = alert_state.flag_batch(_readings(spark, T4), 0, scratch_path(spark, "t4slots"))
    got = {r.event_id: r.alerted for r in out.collect()}
    assert got == {1: True, 2: False, 3: False, 4: True, 5: False, 6: False, 7: False}
    assert {r.event_id for r in alert_state.alert_once_per_slot(_readings(spark, T4)).where("alerted").collect()} == {1, 4}


def test_alert_state_across_micro_batches(spark):
    """Second run over new files with the same checkpoint must not alert the same slot again."""
    src, out, ck = scratch_path(spark, "t4src"), scratch_path(spark, "t4out"), scratch_path(spark, "t4ck")
    schema = "location_id string, parameter string, value double, created_at timestamp, " \
             "measurement_time timestamp, event_id long, main_pollutant string, location_name string"

    def run():
        return alert_state.run_flagged(spark.readStream.schema(schema).parquet(src), out, ck)

    _readings(spark, [("07:10", 180.0, 1)]).write.mode("append").parquet(src)
    run()
    _readings(spark, [("07:20", 200.0, 2), ("17:01", 300.0, 3)]).write.mode("append").parquet(src)
    got = {r.event_id: (r.alerted, r.alert_sent_at is not None) for r in run().collect()}
    assert got == {1: (True, True), 2: (False, False), 3: (True, True)}


def test_replayed_and_late_batches_alert_once(spark):
    """A batch that runs again gives the same flags; an earlier reading that arrives later raises no second alert;
    the plan has no Python step."""
    out = scratch_path(spark, "t4replay")
    alert_state.store_batch(_readings(spark, [("07:30", 180.0, 1), ("17:10", 100.0, 2)]), 0, out)
    late = _readings(spark, [("07:10", 190.0, 3), ("17:20", 160.0, 4)])
    told = []
    for _ in range(2):   # the second time as after a failure between the slots and the readings
        alert_state.store_batch(late, 1, out, handler=lambda a, i: told.append((i, sorted(r.event_id for r in a.collect()))))
    got = {r.event_id: r.alerted for r in spark.read.parquet(out).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True} and told == [(1, [4])] * 2
    assert spark.read.parquet(f"{out}_slots").count() == 2
    plan = alert_state.flag_batch(late, 2, f"{out}_slots")._jdf.queryExecution().toString()
    assert "Pandas" not in plan and "Python" not in plan and "PartitionFilters: [isnotnull(slot_date" in plan


def test_two_sensors_of_one_message(spark):
    """The sensor below the threshold is not flagged with its neighbour, with and without a topic partition."""
    rows = _readings(spark, [("07:10", 180.0, 1)])
    for part in (F.lit(3), F.lit(None)):
        two = (rows.withColumn("sensor_position", F.lit(0)).unionByName(rows.withColumn("sensor_position", F.lit(1)).withColumn("value", F.lit(20.0)))
               .withColumn("kafka_partition", part.cast("int")))
        got = {r.sensor_position: r.alerted for r in flag_readings(two).collect()}
        assert got == {0: True, 1: False}
        again = two.withColumn("kafka_partition", F.lit(9)).withColumn("value", F.lit(170.0))
        assert flag_readings(two.unionByName(again)).where("alerted").count() == 1


def test_upsert_rules(spark):
    target = spark.createDataFrame([("a", "old", 1.0), ("b", "keep", 2.0)], "k string, name string, lat double")
    updates = spark.createDataFrame([("a", "new1", None, 1), ("a", "new2", None, 2), ("c", "ins", 9.0, 1)],
                                    "k string, name string, lat double, seq int")
    out = {r.k: (r.name, r.lat) for r in upsert(target, updates, ["k"], ["name"], order=["seq"]).collect()}
    assert out == {"a": ("new2", 1.0), "b": ("keep", 2.0), "c": ("ins", 9.0)}
    chk = key_check(spark.createDataFrame([("a",), ("a",), (None,)], "k string"), ["k"], "t").first()
    assert (chk.rows, chk.duplicate_keys, chk.null_keys) == (3, 1, 1)


def test_sensor_text(spark):
    from hazelake import schemas
    row = ("t", "1", "n", "l", "c", "VN", (1.0, 2.0), False, True,
           [("i", "n", "aqi", "AQI", "AQI", 42.5, "2025-01-01T00:00:00Z", None, "pm25", "PM2.5")])
    df = spark.createDataFrame([row, row[:9] + ([],)], schemas.MESSAGE)
    got = [r.t for r in df.select(X.sensor_text("sensors").alias("t")).collect()]
    assert got[0] == "    • AQI: 42.5 AQI (Cập nhật: 2025-01-01T00:00:00Z)"
    assert got[1] == "    Không có dữ liệu sensors"
