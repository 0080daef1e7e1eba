from pyspark.sql import functions as F

from hazelake.functions.timeparse import parse_datetime, parse_datetime_helper
from hazelake.functions.units import conversion_factor, normalize_units, normalize_units_lenient
from hazelake.operators.dedupe import dedupe
from hazelake.operators.validate import is_value_valid, validate_nonzero, validate_ranges

BRONZE = "location_id string, datetime string, parameter string, unit string, value double, _file string, _ord long"


def test_dedupe_first_last_none(spark):
    rows = [("1", "t", "pm25", "u", 1.0, "a", 1), ("1", "t", "pm25", "u", 2.0, "a", 2),
            (None, "t", "pm25", "u", 3.0, "a", 3), (None, "t", "pm25", "u", 4.0, "a", 4),
            ("1", "2025-07-03T01:00:00Z", "pm25", "u", 5.0, "a", 5),
            ("1", "2025-07-03T08:00:00+07:00", "pm25", "u", 6.0, "a", 6)]
    df = spark.createDataFrame(rows, BRONZE)
    first = {r._ord for r in dedupe(df, keep="first").collect()}
    last = {r._ord for r in dedupe(df, keep="last").collect()}
    none = {r._ord for r in dedupe(df, keep=False).collect()}
    assert first == {1, 3, 5, 6}          # NULL keys compare equal; two spellings of an instant kept
    assert last == {2, 4, 5, 6}
    assert none == {5, 6}


def test_dedupe_is_an_aggregate_not_a_window(spark):
    df = spark.createDataFrame([("1", "t", "p", "u", 1.0, "a", 1)], BRONZE)
    plan = dedupe(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan


def test_pipeline_units(spark):
    rows = [("co", "ppm", 2.0), ("no2", "ppb", 10.0), ("no2", "ppm", 10.0), ("pm25", "mg/m³", 0.5),
            ("pm25", "µg/m³", None), ("co", "ppm", None)]
    df = spark.createDataFrame(rows, "parameter string, unit string, value double")
    out = normalize_units(df).collect()
    assert [r.value for r in out[:4]] == [2000.0, 18.799999999999997, 10.0, 500.0]
    assert out[2].unit == "ppm" and out[0].unit == "µg/m³"
    assert out[5].value is None and out[5].unit == "µg/m³"   # NULL value still relabelled


def test_lenient_units(spark):
    df = spark.createDataFrame([("no2", "ppm", 10.0), ("co", "ppb", 5.0), ("co", "ppm", None)],
                               "parameter string, unit string, value double")
    out = normalize_units_lenient(df).collect()
    assert [r.value for r in out] == [10000.0, 5.0, None]
    assert [r.unit for r in out] == ["µg/m³", "ppb", "ppm"]


def test_conversion_factor(spark):
    df = spark.createDataFrame([("o3", "ppb"), ("x", "mg/m3"), ("x", "ppm")], "p string, u string")
    assert [r.f for r in df.select(conversion_factor("p", "u").alias("f")).collect()] == [1.96, 1000.0, 1.0]


def test_parse_datetime(spark):
    df = spark.createDataFrame([("2025-07-03T01:00:00+07:00",), ("bad",), ("",)], "datetime string")
    out = parse_datetime(df).collect()
    assert str(out[0].datetime) == "2025-07-02 18:00:00" and str(out[0].date) == "2025-07-02"
    assert out[0].hour == 18 and out[0].day_of_week == 2
    assert out[1].datetime is None and out[2].datetime is None


def test_helper_parts(spark):
    df = spark.createDataFrame([("2025-07-05 10:00:00",)], "datetime string")
    r = parse_datetime_helper(df).first()
    assert (r.day_name, r.day_of_week, r.is_weekend) == ("Saturday", 5, True)


def test_ranges(spark):
    rows = [("pm25", 0.0), ("pm25", 1000.0), ("pm25", 1000.1), ("pm25", -0.1), ("pm25", None), ("xyz", 1e9)]
    df = spark.createDataFrame(rows, "parameter string, value double")
    c8 = [(r.parameter, r.value) for r in validate_ranges(df).collect()]
    c9 = [(r.parameter, r.value) for r in validate_nonzero(df).collect()]
    assert c8 == [("pm25", 0.0), ("pm25", 1000.0), ("xyz", 1e9)]
    assert c9 == [("pm25", 1000.0), ("xyz", 1e9)]


def test_is_value_valid(spark):
    df = spark.createDataFrame([("PM2.5", 1001.0), ("temperature", -10.0), ("xyz", -1.0), ("pm25", None)],
                               "p string, v double")
    assert [r.ok for r in df.select(is_value_valid("p", "v").alias("ok")).collect()] == [False, True, False, False]


def test_dedupe_hot_key_combines_before_shuffle(spark):
    hot = [("1", "t", "pm25", "u", float(i), "a", i) for i in range(3000)]          # one key, 1/3 of rows
    rest = [(str(i % 50), f"t{i}", "pm10", "u", 1.0, "a", 10_000 + i) for i in range(6000)]
    df = spark.createDataFrame(hot + rest, BRONZE).repartition(8)
    out = dedupe(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange hashpartitioning")[-1]
    assert "partial_min_by" in before_shuffle
    got = out.where("location_id = '1' AND datetime = 't'").collect()
    assert len(got) == 1 and got[0]._ord == 0 and got[0].value == 0.0
    assert out.count() == 1 + 6000


def test_parse_datetime_strict_raises(spark):
    import pytest
    df = spark.createDataFrame([("2025-07-03T01:00:00Z",), ("bad",)], "datetime string")
    with pytest.raises(Exception, match="unparsable datetime"):
        parse_datetime(df, strict=True).collect()
    ok = spark.createDataFrame([("2025-07-03T01:00:00Z",)], "datetime string")
    assert parse_datetime(ok, strict=True).count() == 1
