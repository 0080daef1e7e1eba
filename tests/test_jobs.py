import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from hazelake.plans.jobs import run_batch
from hazelake.session import local_path, scratch_path

HEADER = "location_id,datetime,parameter,unit,value\n"


def _write(base, rel, rows, header=HEADER):
    p = os.path.join(local_path(base), rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with gzip.open(p, "wt", encoding="utf-8") as f:
        f.write(header + "".join(",".join(r) + "\n" for r in rows))


def test_run_batch_three_layouts(spark):
    bronze, out = scratch_path(spark, "job-bronze"), scratch_path(spark, "job-out")
    rows = [("1", f"2025-07-03T{h:02d}:00:00Z", "pm25", "µg/m³", str(10.0 + h)) for h in range(12)]
    rows.append(rows[0][:4] + ("99",))   # duplicate key: the first copy wins
    _write(bronze, "year=2025/locationid=1/month=07/day=03/location-1-20250703.csv.gz", rows)
    rows2 = [("2", f"2025-07-04 {h:02d}:00:00", "pm10", "mg/m³", "0.05") for h in range(12)]
    _write(bronze, "year=2025/month=07/day=04/locationid=2/location-2-20250704.csv.gz", rows2)
    rows3 = [("1", f"2025-07-05T{h:02d}:00:00+07:00", "co", "ppm", "1.5") for h in range(12)]
    _write(bronze, "year=2025/locationid=1/month=07/location-1-20250705.csv.gz", rows3)
    _write(bronze, "year=2025/locationid=1/month=07/location-1-20250709.csv.gz", rows3)  # outside range

    run_batch(spark, bronze, out, dt.date(2025, 7, 3), dt.date(2025, 7, 5))
    silver = spark.read.parquet(f"{out}/silver")
    assert silver.count() == 36
    assert sorted(r.run_date for r in silver.select("run_date").distinct().collect()) == \
        [dt.date(2025, 7, 3), dt.date(2025, 7, 4), dt.date(2025, 7, 5)]
    daily = {(r.location_id, r.parameter): r for r in spark.read.parquet(f"{out}/gold/fact_aqi_daily").collect()}
    assert daily[("1", "pm25")].value_min == 10.0           # duplicate 99 dropped, first copy kept
    assert daily[("2", "pm10")].value_avg == 50.0           # mg/m³ -> µg/m³
    assert daily[("1", "co")].value_max == 1500.0           # ppm -> µg/m³
    man = spark.read.json(f"{out}/gold/metadata").collect()
    assert len(man) == 3 and all(m.status == "SUCCESS" for m in man)


def test_cli_batch_and_stream(spark):
    from hazelake.plans import jobs as batch_jobs
    from hazelake.sources.fixtures import messages
    from hazelake.streaming import jobs as stream_jobs
    from hazelake.streaming import readings as RS
    from conftest import SF_SMALL
    bronze, out = scratch_path(spark, "cli-bronze"), scratch_path(spark, "cli-out")
    rows = [("3", f"2025-07-0{d}T{h:02d}:00:00Z", "pm25", "µg/m³", str(20.0 + h)) for d in (3, 4) for h in range(12)]
    for d in (3, 4):
        _write(bronze, f"year=2025/locationid=3/month=07/day=0{d}/location-3-2025070{d}.csv.gz",
               [r for r in rows if r[1].startswith(f"2025-07-0{d}")])
    batch_jobs.main(["--bronze", bronze, "--out", out, "--start", "2025-07-04", "--end", "2025-07-04"])
    silver = spark.read.parquet(f"{out}/silver")
    assert silver.count() == 12
    assert {r.run_date for r in silver.select("run_date").distinct().collect()} == {dt.date(2025, 7, 4)}

    src, sout, ck = scratch_path(spark, "cli-src"), scratch_path(spark, "cli-sout"), scratch_path(spark, "cli-ck")
    m = messages(spark, SF_SMALL)
    RS.land_messages(m, src)
    stream_jobs.main(["readings", "--source", "json", "--path", src, "--out", sout, "--checkpoint", ck,
                      "--trigger", "once"])
    assert spark.read.parquet(sout).count() == RS.message_to_readings(m).count()


OTHER = "location_id,sensors_id,location,datetime,lat,lon,parameter,unit,value\n"


def test_columns_are_bound_by_header(spark):
    """Reordered and extra columns, a quoted header, and a file name without a date in a day folder."""
    from hazelake.sources.bronze import read_bronze
    base = scratch_path(spark, "headers")
    _write(base, "year=2025/month=07/day=01/locationid=1/part.csv.gz",
           [("7", "77", "Hanoi", "2025-07-01T00:00:00+07:00", "21.0", "105.8", "pm25", "ug/m3", "12.5")], OTHER)
    _write(base, "year=2025/locationid=2/month=07/location-2-20250702.csv.gz", [("3.5", "co", "2025-07-02T00:00:00Z")],
           '"value","parameter","datetime"\n')
    rows = {r.path_location_id: r for r in read_bronze(spark, base).collect()}
    a, b = rows["1"], rows["2"]
    assert (a.location_id, a.datetime, a.parameter, a.unit, a.value) == ("7", "2025-07-01T00:00:00+07:00", "pm25", "ug/m3", 12.5)
    assert (b.location_id, b.datetime, b.parameter, b.unit, b.value) == (None, "2025-07-02T00:00:00Z", "co", None, 3.5)
    assert (a.run_date, b.run_date) == (dt.date(2025, 7, 1), dt.date(2025, 7, 2))


def test_a_file_without_required_columns_fails(spark):
    from hazelake.sources.bronze import read_bronze
    base = scratch_path(spark, "noheader")
    _write(base, "year=2025/month=07/day=01/locationid=1/part.csv.gz", [("1", "pm25", "ug/m3")], "location_id,parameter,unit\n")
    with pytest.raises(Exception, match="no header"):
        read_bronze(spark, base).collect()


def test_daily_runs_add_up_to_one_run(spark):
    """Two local days in two runs share a UTC date: the tables equal those of one run."""
    bronze, one, two = (scratch_path(spark, x) for x in ("inc-bronze", "inc-one", "inc-two"))
    for d in (1, 2):
        rows = [("1", f"2025-07-0{d}T{h:02d}:00:00+07:00", "pm25", "µg/m³", str(10.0 * d + h)) for h in range(24)]
        _write(bronze, f"year=2025/month=07/day=0{d}/locationid=1/part.csv.gz", rows)
    _write(bronze, "year=2025/month=07/day=02/locationid=2/part.csv.gz", [("2", *r[1:]) for r in rows[:3]])   # too few rows: the run fails
    run_batch(spark, bronze, one, dt.date(2025, 7, 1), dt.date(2025, 7, 2))
    for d in (1, 2, 2):   # the second day twice: a repeated run changes nothing
        run_batch(spark, bronze, two, dt.date(2025, 7, d), dt.date(2025, 7, d))
    for name in ("fact_aqi_hourly", "fact_aqi_daily", "dim_location", "dim_parameter", "dim_time"):
        a, b = (spark.read.parquet(f"{x}/gold/{name}") for x in (one, two))
        assert sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(a.columns)).collect())), name
    hourly = spark.read.parquet(f"{two}/gold/fact_aqi_hourly")
    assert hourly.where("date = date'2025-07-01'").count() == 24 and hourly.count() == 48
    assert spark.read.parquet(f"{two}/gold/dim_time").count() == 2
    status = {(str(r.execution_date), str(r.locationid)): r.status for r in spark.read.json(f"{two}/gold/metadata").collect()}
    assert status == {("2025-07-01", "1"): "SUCCESS", ("2025-07-02", "1"): "SUCCESS", ("2025-07-02", "2"): "FAILED"}


def test_merge_keeps_partition_text_and_keys(spark):
    from hazelake.operators.upsert import DAILY_KEYS, FACT_UPDATE
    from hazelake.sources import sinks
    path = scratch_path(spark, "merge")
    cols = "location_id string, date date, parameter string, value_min double, value_max double, value_avg double, value_median double, value_count long, value_std double"
    row = lambda v, d="2025-07-03", loc="1": (loc, dt.date.fromisoformat(d), "pm25", v, v, v, v, 1, None)
    sinks.write_daily(spark.createDataFrame([row(1.0), row(2.0, "2025-08-04"), row(5.0, loc=None)], cols), path)
    sinks.merge_fact(spark, path, spark.createDataFrame([row(9.0), row(3.0, "2025-07-05"), row(6.0, loc=None)], cols), DAILY_KEYS, FACT_UPDATE,
                     scratch_path(spark, "merge-stage"), hourly=False)
    got = sinks.read_table(spark, path, sinks.FACT_PARTITIONS[False])
    assert sorted((str(r.location_id), str(r.date), r.value_avg, r.month) for r in got.collect()) == [
        ("1", "2025-07-03", 9.0, "07"), ("1", "2025-07-05", 3.0, "07"), ("1", "2025-08-04", 2.0, "08"), ("None", "2025-07-03", 6.0, "07")]


def test_gate_judges_unrounded_percentages(spark):
    from hazelake.operators.quality import quality_report
    n = 100_000   # two data columns: 40 002 empty cells of 200 000 are 20.001 %
    df = spark.range(n).select(F.lit("1").alias("location_id"), F.lit(dt.date(2025, 7, 1)).alias("run_date"),
                               F.when(F.col("id") >= 40_002, F.col("id")).alias("value"))
    r = quality_report(df).first()
    assert (r.null_percent, r.passed) == (20.0, False)


def test_means_keep_small_values(spark):
    from hazelake.operators import facts
    df = spark.createDataFrame([("1", dt.date(2025, 7, 1), "co", 2e-7), ("1", dt.date(2025, 7, 1), "co", 4e-7)],
                               "location_id string, date date, parameter string, value double")
    r = facts.daily_fact(df).first()
    assert r.value_min < r.value_avg < r.value_max and abs(r.value_avg - 3e-7) < 1e-20


def test_alert_flag_needs_the_same_reading(spark):
    """Two partitions hold the same offset: only the reading above the threshold is flagged."""
    from hazelake.operators.alerts import flag_readings
    t = dt.datetime(2025, 7, 1, 0, 30)   # 07:30 in UTC+7, inside a slot
    df = spark.createDataFrame([("a", "aqi", t, 5, 180.0, "x"), ("b", "aqi", t, 5, 20.0, "x")],
                               "location_id string, parameter string, created_at timestamp, event_id long, value double, main_pollutant string")
    assert {r.location_id: r.alerted for r in flag_readings(df).collect()} == {"a": True, "b": False}


def test_archive_of_text_ids_has_no_invented_offsets(spark):
    from hazelake.sources.fixtures import messages
    from hazelake.streaming import readings as RS
    from conftest import SF_SMALL
    m = messages(spark, SF_SMALL).limit(3).withColumn("location_id", F.lit("iqair_hanoi_hanoi"))
    for r in RS.archive_rows(m).collect():
        assert r._kafka_metadata.partition is None and r._kafka_metadata.offset is None and r._kafka_metadata.key == "iqair_hanoi_hanoi"


def test_range_scan_opens_only_its_files(spark):
    """A corrupt file of another date does not stop a run; headers come from the store the second time."""
    from hazelake.sources import filecatalog
    from hazelake.sources.bronze import read_bronze
    base, store = scratch_path(spark, "range"), scratch_path(spark, "range-store")
    for d in (1, 2, 3):
        _write(base, f"year=2025/month=07/day=0{d}/locationid=1/part [{d}].csv.gz", [("1", f"2025-07-0{d}T00:00:00Z", "pm25", "ug/m3", f"{d}.5")])
    with open(os.path.join(local_path(base), "year=2025/month=07/day=03/locationid=1/bad.csv.gz"), "wb") as f:
        f.write(b"not gzip at all")
    first, last = dt.date(2025, 7, 1), dt.date(2025, 7, 2)
    df = read_bronze(spark, base, start=first, end=last, store=store)
    assert sorted((r.run_date.day, r.value) for r in df.collect()) == [(1, 1.5), (2, 2.5)]
    assert all("day=03" not in p for p in df.inputFiles()) and len(df.inputFiles()) == 2
    assert spark.read.parquet(store).count() == 2
    # a changed file is read again, a known one is not
    _write(base, "year=2025/month=07/day=02/locationid=1/part [2].csv.gz", [("3.5", "co", "2025-07-02T00:00:00Z")], "value,parameter,datetime\n")
    asked = []
    real = filecatalog.read_headers
    filecatalog.read_headers = lambda s, paths: asked.extend(paths) or real(s, paths)
    try:
        again = read_bronze(spark, base, start=first, end=last, store=store)
    finally:
        filecatalog.read_headers = real
    assert sorted((r.run_date.day, r.value, r.parameter) for r in again.collect()) == [(1, 1.5, "pm25"), (2, 3.5, "co")]
    assert len(asked) == 1 and "day=02" in asked[0]
    none = read_bronze(spark, base, start=dt.date(2030, 1, 1), end=dt.date(2030, 1, 2), store=store)
    assert none.count() == 0 and none.columns == df.columns


def test_headers_come_from_the_first_bytes(spark):
    """A file damaged far behind its header still gives it; a byte order mark and files without a header are told."""
    import random
    from hazelake.sources import filecatalog
    base = scratch_path(spark, "first-bytes")
    rnd = random.Random(1)
    _write(base, "location-1-20250701.csv.gz", [("1", f"2025-07-01T{i:07d}", "pm25", "ug/m3", str(rnd.random())) for i in range(20000)])
    path = os.path.join(local_path(base), "location-1-20250701.csv.gz")
    data = bytearray(open(path, "rb").read())
    assert len(data) > 3 * filecatalog.HEAD_BYTES
    data[len(data) // 2:] = b"\0" * (len(data) - len(data) // 2)
    open(path, "wb").write(data)
    _write(base, "location-2-20250701.csv.gz", [("2", "x", "pm25", "ug/m3", "1")], "\ufeff" + HEADER)
    _write(base, "location-3-20250701.csv.gz", [], "")
    with open(os.path.join(local_path(base), "location-4-20250701.csv.gz"), "wb") as f:
        f.write(b"\x1f\x8bbroken")
    got = {r.path.split("/")[-1]: (r.location_id, r.header) for r in filecatalog.catalogue(spark, base).collect()}
    assert got == {f"location-{i}-20250701.csv.gz": (str(i), HEADER.strip() if i < 3 else None) for i in (1, 2, 3, 4)}


def test_dimension_rewrite_survives_a_failure_half_way(spark, monkeypatch):
    """K4: whatever rename fails, the next run finds a whole table and loses no row."""
    from hazelake.sources import sinks
    one = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    two = spark.createDataFrame([("2", "c"), ("3", "d")], "k string, v string")
    real = sinks._rename
    for failing in (0, 1):
        path = scratch_path(spark, "dim")
        sinks.merge_dimension(spark, path, one, ["k"])
        calls = []

        def rename(s, a, b, calls=calls, failing=failing):
            calls.append(a)
            if len(calls) == failing + 1:
                raise OSError("cut off")
            real(s, a, b)
        monkeypatch.setattr(sinks, "_rename", rename)
        with pytest.raises(OSError, match="cut off"):
            sinks.merge_dimension(spark, path, two, ["k"])
        monkeypatch.setattr(sinks, "_rename", real)
        sinks.recover_dimension(spark, path)
        assert {r.k for r in spark.read.parquet(path).collect()} >= {"1", "2"}
        sinks.merge_dimension(spark, path, two, ["k"])
        assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == {("1", "a"), ("2", "c"), ("3", "d")}


def test_step_report_reads_its_input_once(spark):
    from hazelake.operators import profile
    from hazelake.plans import pipeline
    from hazelake.plans.stages import Stages
    from conftest import SF_SMALL
    rows = Stages(spark, SF_SMALL).R()
    count = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            count.add(b.num_rows)
            yield b
    got = {r.step: r.rows for r in profile.step_report(rows.mapInArrow(counted, rows.schema), pipeline.STEPS).collect()}
    assert got["bronze"] == rows.count() == count.value
    assert got["bronze"] > got["deduplicated"] > got["validated"] >= got["outliers_removed"] >= got["silver"] > 0


def test_archive_holds_one_file_an_hour_and_landing_uses_all_cores(spark, tmp_path):
    """A landing of many files, each with all hours: the archive's files do not grow with the files read."""
    from hazelake.session import spread
    from hazelake.sources import fixtures
    from hazelake.streaming import jobs
    from hazelake.streaming import readings as RS
    msgs = fixtures.messages(spark, "/root/testdata/sf0.001").where("event_id < 240").repartition(12)
    RS.land_messages(msgs, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    q = jobs.start_archive(spark, jobs.message_source(spark, "json", str(tmp_path / "in")), out, str(tmp_path / "ck"))
    q.awaitTermination()
    assert q.exception() is None
    files = [(d, f) for d, _, names in os.walk(out) for f in names if f.endswith(".json.gz")]
    assert len(files) == len({d for d, _ in files})
    assert sorted(r.event_id for r in spark.read.schema("event_id long").json(out).collect()) == list(range(240))
    one = spark.range(0, 1000, 1, 1)
    dealt = spread(one, 100)
    assert dealt.rdd.getNumPartitions() == 10 and min(dealt.rdd.glom().map(len).collect()) == 100
    assert dealt.exceptAll(one).isEmpty() and dealt.count() == 1000
