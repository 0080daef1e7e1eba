"""AQI and classification as Column expressions (Q1–Q12).

Every breakpoint table becomes one CASE ladder evaluated inside whole-stage
codegen. Slopes are folded in Python so the doubles equal the source's
``(aqi_hi - aqi_lo) / (conc_hi - conc_lo)``; ``cast('int')`` truncates like ``int()``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazelake import constants as K


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def segments(table):
    """(lo, hi, aqi_lo, aqi_hi, slope) with slope folded in Python; hi None = open top."""
    out = []
    for lo, hi, alo, ahi in table:
        slope = None if hi is None else (ahi - alo) / (hi - lo)
        out.append((lo, hi, alo, ahi, slope))
    return out


def _ladder(v: Column, table, outputs, above=None, above_out=None, negative_null=False):
    """Generic CASE ladder: first matching segment wins; ``outputs(i, seg)`` gives the value."""
    expr = None
    for i, seg in enumerate(segments(table)):
        lo, hi, alo, ahi, slope = seg
        cond = (v >= F.lit(lo)) if hi is None else v.between(F.lit(lo), F.lit(hi))
        if negative_null:
            cond = cond & (v >= 0)
        out = outputs(i, seg)
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    if above is not None:
        expr = expr.when(v > F.lit(above), above_out)
    return expr


def _aqi_value(v: Column):
    def out(_i, seg):
        lo, hi, alo, ahi, slope = seg
        if hi is None:
            return F.lit(ahi)
        return (F.lit(slope) * (v - F.lit(lo)) + F.lit(alo)).cast("int")
    return out


def aqi(v, table, above=None) -> Column:
    v = _col(v)
    return _ladder(v, table, _aqi_value(v), above, F.lit(500)).cast("int")


def aqi_level(v, table, above=None, levels=K.LEVELS) -> Column:
    v = _col(v)
    return _ladder(v, table, lambda i, s: F.lit(levels[i]), above, F.lit(levels[-1]))


def aqi_color(v, table, above=None) -> Column:
    v = _col(v)
    return _ladder(v, table, lambda i, s: F.lit(K.COLORS[i]), above, F.lit(K.COLORS[-1]))


# Q1: pipeline PM2.5 (top segment ends at 500; above 500 -> 500)
def aqi_pm25(v) -> Column:
    return aqi(v, K.PM25_PIPELINE, above=500)


def aqi_pm25_level(v) -> Column:
    return aqi_level(v, K.PM25_PIPELINE, above=500)


# Q2: helper PM2.5 (top ends at 500.4; negatives null)
def aqi_pm25_helper(v) -> Column:
    v = _col(v)
    return F.when(v >= 0, aqi(v, K.PM25_HELPER, above=500.4))


def aqi_pm25_helper_level(v) -> Column:
    v = _col(v)
    return F.when(v >= 0, aqi_level(v, K.PM25_HELPER, above=500.4))


def aqi_pm25_helper_color(v) -> Column:
    v = _col(v)
    return F.when(v >= 0, aqi_color(v, K.PM25_HELPER, above=500.4))


# Q3: open top (>= 250.5 -> 500)
def aqi_pm25_open(v) -> Column:
    return aqi(v, K.PM25_OPEN_TOP)


def aqi_pm25_open_level(v) -> Column:
    return aqi_level(v, K.PM25_OPEN_TOP)


# Q4: PM10 (> 604 -> 500; negatives null)
def aqi_pm10(v) -> Column:
    v = _col(v)
    return F.when(v >= 0, aqi(v, K.PM10, above=604))


def aqi_pm10_level(v) -> Column:
    v = _col(v)
    return F.when(v >= 0, aqi_level(v, K.PM10, above=604))


def aqi_pm10_color(v) -> Column:
    v = _col(v)
    return F.when(v >= 0, aqi_color(v, K.PM10, above=604))


# Q5: dispatch by parameter
def add_aqi_columns(df: DataFrame, parameter="parameter", value="value") -> DataFrame:
    p = F.lower(F.col(parameter))
    v = F.col(value)
    return df.withColumns({
        "aqi": F.when(p == "pm25", aqi_pm25_helper(v)).when(p == "pm10", aqi_pm10(v)),
        "aqi_level": F.when(p == "pm25", aqi_pm25_helper_level(v)).when(p == "pm10", aqi_pm10_level(v)),
        "aqi_color": F.when(p == "pm25", aqi_pm25_helper_color(v)).when(p == "pm10", aqi_pm10_color(v))})


# Q8: level ladder over an AQI value (labels selectable)
def level_ladder(a, labels=K.LEVELS_VI) -> Column:
    a = _col(a)
    expr = None
    for bound, label in zip(K.LADDER_BOUNDS, labels):
        expr = F.when(a <= bound, label) if expr is None else expr.when(a <= bound, label)
    return expr.when(a.isNotNull(), labels[-1])


# Q6: estimate with fallback (unknown parameters use the PM2.5 table)
def aqi_estimate(v, parameter) -> Column:
    v, p = _col(v), F.lower(_col(parameter))
    pm25 = aqi(v, K.PM25_OPEN_TOP)
    pm10 = aqi(v, K.PM10_OPEN_TOP)
    table_value = F.when(p == "pm10", pm10).otherwise(pm25)
    est = F.when(p == "pm25", (v / F.lit(50.0) * F.lit(100)).cast("int")) \
           .otherwise((v / F.lit(100.0) * F.lit(100)).cast("int"))
    est = F.least(F.lit(500), F.greatest(F.lit(0), est))
    return (F.when(v.isNull(), None)
            .when(table_value.isNotNull(), table_value)
            .when(v <= 0, F.lit(0))
            .otherwise(est)).cast("int")


def aqi_estimate_level(v, parameter) -> Column:
    return level_ladder(aqi_estimate(v, parameter), K.LEVELS_VI)


# Q7: category of an AQI value; out of all ranges -> last category
def aqi_category(a) -> Column:
    a = _col(a)
    def pick(idx):
        expr = None
        for cat in K.AQI_CATEGORIES:
            cond = a.between(cat[0], cat[1])
            expr = F.when(cond, cat[idx]) if expr is None else expr.when(cond, cat[idx])
        return expr.when(a.isNotNull(), K.AQI_CATEGORIES[-1][idx])
    return F.struct(pick(2).alias("level"), pick(3).alias("color"), pick(4).alias("health_message"))


# Q9: level of a daily PM2.5 mean in the summary view
def view_level(parameter, avg) -> Column:
    p, a = _col(parameter), _col(avg)
    expr = None
    for bound, label in zip(K.VIEW_PM25_BOUNDS, K.VIEW_LEVELS):
        c = (p == "pm25") & (a <= F.lit(float(bound)))
        expr = F.when(c, label) if expr is None else expr.when(c, label)
    return expr.when((p == "pm25") & (a > F.lit(K.VIEW_PM25_BOUNDS[-1])), K.VIEW_LEVELS[-1]) \
               .otherwise("N/A")


# Q10: breakpoint table as a tiny DataFrame (35 rows, constant: broadcast is size-proven)
def breakpoint_frame(spark: SparkSession) -> DataFrame:
    rows = []
    for param, table in K.BREAKPOINT_TABLES.items():
        for i, (lo, hi, alo, ahi, slope) in enumerate(segments(table)):
            rows.append((param, float(lo), float(hi), int(alo), int(ahi), float(slope), K.LEVELS[i]))
    return spark.createDataFrame(
        rows, "bp_parameter string, bp_lo double, bp_hi double, bp_aqi_lo int, bp_aqi_hi int, "
              "bp_slope double, bp_level string")


def aqi_by_breakpoint_join(df: DataFrame, bp: DataFrame, parameter="parameter",
                           value="value") -> DataFrame:
    """Equi (parameter) + range (value in [lo, hi]) lookup; unmatched rows keep NULL AQI."""
    cond = ((F.lower(F.col(parameter)) == F.col("bp_parameter"))
            & (F.col(value) >= F.col("bp_lo")) & (F.col(value) <= F.col("bp_hi")))
    j = df.join(F.broadcast(bp), cond, "left")
    return (j.withColumn("aqi", (F.col("bp_slope") * (F.col(value) - F.col("bp_lo"))
                                 + F.col("bp_aqi_lo")).cast("int"))
             .withColumn("aqi_level", F.col("bp_level"))
             .drop(*bp.columns))


# Q11: guideline and alert threshold flags
def threshold_flags(parameter, avg, aqi_col=None) -> list[Column]:
    p, a = F.lower(_col(parameter)), _col(avg)
    t = K.ALERT_THRESHOLDS
    cols = [
        F.when(p == "pm25", a > t["pm25_who_guideline"])
         .when(p == "pm10", a > t["pm10_who_guideline"]).alias("over_who"),
        F.when(p == "pm25", a > t["pm25_vn_standard"])
         .when(p == "pm10", a > t["pm10_vn_standard"]).alias("over_national"),
    ]
    if aqi_col is not None:
        q = _col(aqi_col)
        cols += [(q > t["aqi_unhealthy"]).alias("aqi_unhealthy"),
                 (q > t["aqi_very_unhealthy"]).alias("aqi_very_unhealthy"),
                 (q > t["aqi_hazardous"]).alias("aqi_hazardous")]
    return cols


# Q12: dashboard colour bands (value >= step -> that colour)
def band(v, kind) -> Column:
    v = _col(v)
    bounds, colors = K.BANDS[kind]
    expr = None
    for bound, color in reversed(list(zip(bounds, colors[1:]))):
        expr = F.when(v >= bound, color) if expr is None else expr.when(v >= bound, color)
    return expr.when(v.isNotNull(), colors[0])


def any_of(conds):
    return reduce(lambda a, b: a | b, conds)
