"""Payload messages, hours in any order of arrival, daily summaries, stored files and alert texts."""

import datetime as dt

from pyspark.sql import functions as F

from hazelake import schemas
from hazelake.operators import alerts, profile, summary
from hazelake.session import scratch_path
from hazelake.sources import payloads
from hazelake.streaming import readings as RS

UTC = dt.timezone.utc
ARRIVAL = dt.datetime(2025, 7, 1, 12, 30, 15)


def body(ts, country="Vietnam", status="success", place="[105.8, 21.0]", main="p2"):
    return (f'{{"status":"{status}","data":{{"city":"Ha Noi","state":"Old Quarter","country":"{country}","location":{{"coordinates":{place}}},'
            f'"current":{{"pollution":{{"ts":{ts},"aqius":155,"mainus":"{main}"}}}}}}}}')


def test_payloads_become_messages(spark):
    texts = [body('"2025-07-01T10:00:00.000Z"'), body("1751364000"), body('"no time"', "Laos", place="[]"), body("null"),
             body('"2025-07-01T10:00:00Z"', status="fail"), "{cut", "", None, body('"2025-07-01T10:00:00Z"')[:60]]
    df = spark.createDataFrame([(i, t, ARRIVAL) for i, t in enumerate(texts)], payloads.LANDED_PAYLOAD)
    out = payloads.payload_to_message(df)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields] == [(f.name, f.dataType.simpleString()) for f in schemas.LANDED_MESSAGE.fields[:-2]] + [
        ("event_id", "bigint"), ("ingest_ts", "timestamp")]
    got = {r.event_id: r for r in out.collect()}
    assert sorted(got) == [0, 1, 2, 3]
    assert got[0].location_id == "iqair_ha_noi_old_quarter" and got[0].country_code == "VN" and got[0].timestamp == "2025-07-01T12:30:15"
    assert got[2].country_code == "LA" and got[2].coordinates.latitude is None and got[0].coordinates == (21.0, 105.8)
    times = [got[i].sensors[0].latest_datetime for i in range(4)]
    assert times == ["2025-07-01T10:00:00Z", "2025-07-01T10:00:00Z", "2025-07-01T12:30:15Z", "2025-07-01T12:30:15Z"]
    assert got[0].sensors[0].latest_datetime_local == "2025-07-01T10:00:00+00:00" and got[0].sensors[0].main_pollutant == "pm25"
    bad = {r.event_id: r for r in payloads.payload_errors(df).collect()}
    assert {i: r.reason for i, r in bad.items()} == {4: "fail", 5: "malformed", 6: "malformed", 7: "malformed", 8: "malformed"}
    assert bad[5].payload == "{cut"


def test_hours_merge_in_any_order_and_on_replay(spark):
    src, out, ck = (scratch_path(spark, x) for x in ("src", "partials", "ck"))
    schema = "location_id string, parameter string, value double, measurement_time timestamp"
    at = lambda h, m: dt.datetime(2025, 1, 1, h, m)
    first = [("1", "aqi", 30.0, at(9, 5)), ("1", "aqi", None, at(8, 0)), ("2", "aqi", 1e30, at(9, 1))]
    late = [("1", "aqi", 10.0, at(0, 10)), ("1", "aqi", 50.0, at(9, 59)), ("2", "aqi", 3e30, at(9, 2))]
    for rows in (first, late):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        RS.hourly_partials_update(spark.readStream.schema(schema).parquet(src), out, ck)
    read = lambda: {(r.location_id, r.window_start.hour): (r.value_min, r.value_max, r.value_avg, r.value_count) for r in RS.merged_windows(spark, out).collect()}
    want = {("1", 9): (30.0, 50.0, 40.0, 2), ("1", 8): (None, None, None, 0), ("1", 0): (10.0, 10.0, 10.0, 1), ("2", 9): (1e30, 3e30, 2e30, 2)}
    assert read() == want
    again = RS.window_partials(spark.createDataFrame(late, schema)).withColumn("window_date", F.to_date("window_start"))
    again.write.mode("overwrite").partitionBy("window_date").parquet(f"{out}/batch_id=1")   # the second batch, run again
    assert read() == want


def test_summaries_of_two_runs_are_those_of_one(spark):
    rows = [(s, p, dt.date(2025, 7, day), h, 1.0 * h, 2.0 * h, 3) for s in "12" for p in ("pm25", "o3") for day in (1, 2, 3) for h in (0, 5)]
    fact = spark.createDataFrame(rows, "location_id string, parameter string, date date, hour int, value_min double, value_max double, value_count long")
    one, two = scratch_path(spark, "one"), scratch_path(spark, "two")
    summary.write_summary(summary.daily_summary(fact), one)
    summary.write_summary(summary.daily_summary(fact.where("date <= '2025-07-02'").limit(5)), two)   # a run that knew less
    for days in ("date <= '2025-07-02'", "date >= '2025-07-02'"):
        summary.write_summary(summary.daily_summary(fact.where(days)), two)
    rows = [sorted(tuple(r) for r in summary.summary_coverage(summary.read_summary(spark, p)).collect()) for p in (one, two)]
    assert rows[0] == rows[1] == [(s, 12, dt.date(2025, 7, 1), dt.date(2025, 7, 3), 2, 36, 0.0, 10.0) for s in "12"]


def test_stored_files_are_listed_without_their_content(spark):
    path = scratch_path(spark, "files")
    spark.createDataFrame([("07", 1), ("07", 2), ("8", 3)], "locationid string, x int").coalesce(1).write.partitionBy("locationid").parquet(path)
    files = profile.stored_files(spark, path)
    assert sorted(r.location_id for r in files.collect()) == ["07", "8"] and "content" not in files._jdf.queryExecution().executedPlan().toString()
    got = {r.location_id: r for r in profile.gold_object_coverage(spark, {"t": path}).collect()}
    assert got["07"].files == 1 and got["07"].bytes > 0 and got["8"].sample_keys.endswith(".parquet")


def test_alert_texts(spark):
    cols = "event_id long, location_id string, location_name string, locality string, country string, parameter string, unit string, value double, main_pollutant string, created_at timestamp, measurement_time timestamp"
    t = dt.datetime(2025, 7, 1, 1, 2, 3)
    df = spark.createDataFrame([(1, "a", "Lake", "Ha Noi", "", "aqi", "AQI", 155.0, "PM2.5", t, t), (2, "a", "Lake", None, "VN", "aqi", "AQI", 201.5, None, t, t),
                                (3, "b", "Hill", None, None, "aqi", None, 180.0, "", t, t)], cols)
    text = {r.event_id: r.body for r in alerts.alert_bodies(df, 150).collect()}
    assert text[1].startswith("CẢNH BÁO AQI tại Lake, Ha Noi: AQI=155.0, mức ") and text[1].endswith("Giá trị AQI = 155.0 AQI, vượt ngưỡng 150.0 AQI. Thời điểm đo: 2025-07-01 01:02:03 UTC")
    subject = {r.location_id: r.subject for r in alerts.alert_summaries(df).collect()}
    assert subject == {"a": "[CẢNH BÁO AQI] 2 bản ghi vượt ngưỡng tại Lake (AQI cao nhất: 201.5, Main: PM2.5)", "b": "[CẢNH BÁO AQI] Hill vượt ngưỡng (AQI=180.0)"}
