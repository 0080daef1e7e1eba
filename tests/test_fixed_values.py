"""Fixed values written out by hand, so that a wrong constant fails here even if the oracle shares it."""

from hazelake import constants as K
from hazelake.functions import aqi as Q
from hazelake.functions.units import normalize_units


def _values(spark, expr, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, value double")
    return [r[0] for r in df.orderBy("i").select(expr("value").alias("a")).collect()]


def test_pm25_breakpoints(spark):
    ends = [0.0, 12.0, 12.1, 35.4, 35.5, 55.4, 55.5, 150.4, 150.5, 250.4, 250.5, 500.0]
    assert [round(a) for a in _values(spark, Q.aqi_pm25, ends)] == [0, 50, 51, 100, 101, 150, 151, 200, 201, 300, 301, 500]


def test_pm10_breakpoints(spark):
    ends = [0.0, 54.0, 55.0, 154.0, 155.0, 254.0, 255.0, 354.0, 355.0, 424.0]
    assert [round(a) for a in _values(spark, Q.aqi_pm10, ends)] == [0, 50, 51, 100, 101, 150, 151, 200, 201, 300]


def test_unit_factors(spark):
    rows = [("co", "ppm", 2.0, 2000.0), ("no2", "ppb", 2.0, 3.76), ("o3", "ppb", 2.0, 4.0), ("so2", "ppb", 2.0, 5.24),
            ("pm25", "mg/m³", 2.0, 2000.0), ("pm25", "µg/m³", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "parameter string, unit string, value double, want double")
    assert all(abs(r.value - r.want) < 1e-9 for r in normalize_units(df).collect())


def test_ranges_and_thresholds():
    assert K.PIPELINE_RANGES == {"pm25": (0, 1000), "pm10": (0, 2000), "no2": (0, 1000), "o3": (0, 1000), "co": (0, 50000), "so2": (0, 2000)}
    assert (K.MIN_RECORDS, K.MAX_NULL_PERCENT, K.MAX_DUPLICATE_PERCENT, K.IQR_MULTIPLIER, K.ZSCORE_THRESHOLD) == (10, 20.0, 5.0, 1.5, 3.0)
    assert K.STREAM_AQI_THRESHOLD == 150 and K.LOCAL_OFFSET_HOURS == 7 and list(K.ALERT_SLOT_HOURS) == [7, 17]
