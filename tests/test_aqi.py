import math

import pytest
from pyspark.sql import functions as F

from hazelake.functions import aqi as Q

# FIXTURES §5: value -> (pipeline Q1, helper Q2, open top Q3, PM10 Q4); None = NULL
CASES = [
    (None, None, None, None, None), (float("nan"), None, None, None, None), (-1.0, None, None, None, None),
    (0.0, 0, 0, 0, 0), (11.99, 49, 49, 49, 11), (12.0, 50, 50, 50, 11), (12.05, None, None, None, 11),
    (12.1, 51, 51, 51, 11), (35.45, None, None, None, 32), (55.4, 150, 150, 150, 51),
    (54.5, 147, 147, 147, None), (250.4, 300, 300, 300, 148), (300.0, 340, 340, 500, 173),
    (424.5, 439, 439, 500, None), (500.0, 500, 499, 500, 384), (501.0, 500, 500, 500, 385),
    (605.0, 500, 500, 500, 500),
]


def _frame(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return df.withColumn("v", F.when(~F.isnan("v"), F.col("v")))  # NaN -> NULL at the scan


def test_pm25_and_pm10_ladders(spark):
    df = _frame(spark, [c[0] for c in CASES])
    rows = df.select("v", Q.aqi_pm25("v").alias("q1"), Q.aqi_pm25_helper("v").alias("q2"),
                     Q.aqi_pm25_open("v").alias("q3"), Q.aqi_pm10("v").alias("q4")).collect()
    got = {(None if r.v is None else r.v): (r.q1, r.q2, r.q3, r.q4) for r in rows}
    for v, *want in CASES:
        key = None if v is None or (isinstance(v, float) and math.isnan(v)) else v
        if key is None:
            assert got[None] == (None, None, None, None)
        else:
            assert got[key] == tuple(want), v


def test_estimate_fallback(spark):
    rows = [(12.05, "pm25", 24), (35.45, "pm25", 70), (55.45, "pm25", 110), (250.45, "pm25", 500),
            (-1.0, "pm25", 0), (54.5, "pm10", 54)]
    df = spark.createDataFrame(rows, "v double, p string, want int")
    out = df.select("want", Q.aqi_estimate("v", "p").alias("got")).collect()
    assert all(r.want == r.got for r in out)


def test_category_and_ladder(spark):
    df = spark.createDataFrame([(0,), (51,), (150,), (301,), (-5,), (None,)], "a int")
    out = df.select("a", Q.aqi_category("a")["level"].alias("lvl"), Q.level_ladder("a", Q.K.LEVELS).alias("lad")).collect()
    got = {r.a: (r.lvl, r.lad) for r in out}
    assert got[0] == ("Good", "Good")
    assert got[51] == ("Moderate", "Moderate")
    assert got[150][0] == "Unhealthy for Sensitive Groups"
    assert got[301] == ("Hazardous", "Hazardous")
    assert got[-5][0] == "Hazardous"      # out of every range -> last category
    assert got[None] == (None, None)


def test_breakpoint_join_is_broadcast(spark):
    df = spark.createDataFrame([("pm25", 12.0), ("pm10", 60.0), ("xyz", 1.0)], "parameter string, value double")
    out = Q.aqi_by_breakpoint_join(df, Q.breakpoint_frame(spark))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" in plan or "BroadcastHashJoin" in plan
    got = {r.parameter: r.aqi for r in out.collect()}
    assert got == {"pm25": 50, "pm10": 53, "xyz": None}


@pytest.mark.parametrize("param,avg,want", [("pm25", 12.0, "Good"), ("pm25", 35.4, "Moderate"),
                                            ("pm25", 260.0, "Hazardous"), ("co", 5.0, "N/A"), ("pm25", None, "N/A")])
def test_view_level(spark, param, avg, want):
    df = spark.createDataFrame([(param, avg)], "p string, a double")
    assert df.select(Q.view_level("p", "a").alias("l")).first().l == want
