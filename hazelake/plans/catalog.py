"""Registered queries: one Spark callable per operator and its DuckDB oracle SQL.

Every query reads the driver tables (through fixtures R, M, P or L, which Spark derives
from `events`), so its work grows with the data. Keys follow SURVEY §2's `q:` names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazelake import constants as K
from hazelake.functions import aqi as Q
from hazelake.functions import text as X
from hazelake.functions.timeparse import parse_datetime_helper, parse_utc_chain, partition_keys
from hazelake.functions.units import conversion_factor, normalize_units_lenient
from hazelake.operators import facts, profile, serve
from hazelake.operators.alerts import alert_bodies, alert_rollup, alert_summaries, alert_text
from hazelake.operators.dedupe import auto_keys, dedupe
from hazelake.operators.outliers import remove_outliers_iqr_param, remove_outliers_zscore
from hazelake.operators.quality import quality_report_full, quality_rules
from hazelake.operators.validate import is_value_valid, validate_nonzero
from hazelake.plans import oracle as O
from hazelake.plans import pipeline
from hazelake.plans.oracle import d, q, sql
from hazelake.plans.pipeline import bronze_to_silver_helper, nan_to_null
from hazelake.plans.stages import Stages, ntz, round6

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


BRONZE_COLS = "location_id, parameter, datetime, unit, value, run_date, _file, _ord"

# =========================================================== cleaning


@register("dedupe_first", sql(f"SELECT {BRONZE_COLS} FROM D", "D"))
def q_dedupe_first(spark, sf):
    return Stages(spark, sf).D()


@register("dedupe_last", sql(f"""
SELECT {BRONZE_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY location_id, datetime, parameter
  ORDER BY _file DESC, _ord DESC) AS _rn FROM R) WHERE _rn = 1""", "R"))
def q_dedupe_last(spark, sf):
    r = nan_to_null(Stages(spark, sf).R())
    return dedupe(r, keys=auto_keys(r), keep="last")


@register("dedupe_drop_all", sql(f"""
SELECT {BRONZE_COLS} FROM (SELECT *, count(*) OVER (PARTITION BY location_id, datetime, parameter) AS _n
  FROM R) WHERE _n = 1""", "R"))
def q_dedupe_drop_all(spark, sf):
    r = nan_to_null(Stages(spark, sf).R())
    return dedupe(r, keys=auto_keys(r), keep=False)


@register("normalize_units", sql(f"SELECT {BRONZE_COLS} FROM N", "N"))
def q_normalize_units(spark, sf):
    return Stages(spark, sf).N()


@register("normalize_units_lenient",
          sql(f"SELECT location_id, parameter, datetime, {O._H_UNIT} AS unit, {O._H_VAL} AS value, "
              "run_date, _file, _ord FROM D", "D"))
def q_normalize_units_lenient(spark, sf):
    return normalize_units_lenient(Stages(spark, sf).D())


def _factor_sql(p: str, u: str) -> str:
    exact = " ".join(f"WHEN {q(rp + '|' + ru)} THEN {d(f)}" for rp, ru, f in K.RULE_CONVERSIONS)
    key = f"concat_ws('|', lower({p}), lower({u}))"
    wild = f"concat_ws('|', '*', lower({u}))"
    return f"coalesce(CASE {key} {exact} END, CASE {wild} {exact} END, {d(1.0)})"


@register("conversion_factor",
          sql(f"SELECT _file, _ord, parameter, unit, {_factor_sql('parameter', 'unit')} AS factor FROM D", "D"))
def q_conversion_factor(spark, sf):
    return Stages(spark, sf).D().select("_file", "_ord", "parameter", "unit",
                                        conversion_factor("parameter", "unit").alias("factor"))


@register("parse_datetime", sql("SELECT * FROM T", "T"))
def q_parse_datetime(spark, sf):
    return ntz(Stages(spark, sf).T())


@register("datetime_parts", sql(f"""
SELECT location_id, parameter, ts AS datetime, unit, value, run_date, _file, _ord,
  CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  dayname(ts) AS day_name, isodow(ts) - 1 >= 5 AS is_weekend
FROM (SELECT *, {O.parse_ts('datetime')} AS ts FROM N)""", "N"))
def q_datetime_parts(spark, sf):
    return ntz(parse_datetime_helper(Stages(spark, sf).N()))


@register("validate_ranges", sql("SELECT * FROM V", "V"))
def q_validate_ranges(spark, sf):
    return ntz(Stages(spark, sf).V())


@register("validate_nonzero", sql(f"SELECT * FROM T WHERE {O.in_range()} AND value <> 0", "T"))
def q_validate_nonzero(spark, sf):
    return ntz(validate_nonzero(Stages(spark, sf).T()))


def _valid_sql(p: str, v: str) -> str:
    key = f"regexp_replace(lower({p}), '[.\\-]', '', 'g')"
    lo, hi = O.range_bounds(key, K.RULE_RANGES)
    return (f"coalesce({v} IS NOT NULL AND {v} >= coalesce({lo}, {d(0)}) "
            f"AND (({hi}) IS NULL OR {v} <= ({hi})), false)")


def _variant_spark():
    return F.concat(F.upper(F.substring("parameter", 1, 2)), F.lit("."), F.substring("parameter", 3, 10))
_VARIANT_SQL = "upper(substr(parameter, 1, 2)) || '.' || substr(parameter, 3, 10)"


@register("is_value_valid", sql(f"""
SELECT _file, _ord, parameter, value, {_valid_sql('parameter', 'value')} AS valid,
  {_VARIANT_SQL} AS variant, {_valid_sql(_VARIANT_SQL, 'value')} AS variant_valid FROM D""", "D"))
def q_is_value_valid(spark, sf):
    df = Stages(spark, sf).D().withColumn("variant", _variant_spark())
    return df.select("_file", "_ord", "parameter", "value", is_value_valid("parameter", "value").alias("valid"),
                     "variant", is_value_valid("variant", "value").alias("variant_valid"))


@register("outliers_iqr", sql("SELECT * FROM I", "I"))
def q_outliers_iqr(spark, sf):
    return ntz(Stages(spark, sf).I())


@register("outliers_iqr_param", sql(f"""
SELECT V.* FROM V JOIN (SELECT parameter, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
                        FROM V WHERE parameter IS NOT NULL GROUP BY parameter) s USING (parameter)
WHERE V.value >= s.q1 - {d(1.5)} * (s.q3 - s.q1) AND V.value <= s.q3 + {d(1.5)} * (s.q3 - s.q1)""", "V"))
def q_outliers_iqr_param(spark, sf):
    return ntz(remove_outliers_iqr_param(Stages(spark, sf).V(), ["parameter"]))


@register("outliers_zscore", sql(f"""
SELECT V.* FROM V JOIN (SELECT parameter, avg(value) AS mu, stddev_samp(value) AS sd FROM V GROUP BY parameter) s
  USING (parameter)
WHERE CASE WHEN s.sd = 0 THEN true ELSE abs((V.value - s.mu) / s.sd) < {d(K.ZSCORE_THRESHOLD)} END""", "V"))
def q_outliers_zscore(spark, sf):
    return ntz(remove_outliers_zscore(Stages(spark, sf).V(), ["parameter"]))


_HT = f"""
SELECT location_id, parameter, ts AS datetime, unit, value, run_date, _file, _ord,
  CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  dayname(ts) AS day_name, isodow(ts) - 1 >= 5 AS is_weekend
FROM (SELECT *, {O.parse_ts('datetime')} AS ts FROM (
  SELECT location_id, parameter, datetime, {O._H_UNIT} AS unit, {O._H_VAL} AS value, run_date, _file, _ord FROM D)
  WHERE {O.in_range()} AND value <> 0)"""
_HQ = """
SELECT location_id, run_date, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
FROM HT WHERE value IS NOT NULL AND location_id IS NOT NULL AND run_date IS NOT NULL GROUP BY location_id, run_date"""
_HP = "lower(parameter)"
_HELPER_AQI = (f"CASE WHEN {_HP} = 'pm25' THEN CASE WHEN value >= 0 THEN {O.aqi_case('value', K.PM25_HELPER, 500.4)} END "
               f"WHEN {_HP} = 'pm10' THEN CASE WHEN value >= 0 THEN {O.aqi_case('value', K.PM10, 604)} END END")
_HELPER_LVL = (f"CASE WHEN {_HP} = 'pm25' THEN CASE WHEN value >= 0 THEN {O.level_case('value', K.PM25_HELPER, 500.4)} END "
               f"WHEN {_HP} = 'pm10' THEN CASE WHEN value >= 0 THEN {O.level_case('value', K.PM10, 604)} END END")
_HELPER_COL = (f"CASE WHEN {_HP} = 'pm25' THEN CASE WHEN value >= 0 THEN "
               f"{O.level_case('value', K.PM25_HELPER, 500.4, K.COLORS)} END "
               f"WHEN {_HP} = 'pm10' THEN CASE WHEN value >= 0 THEN {O.level_case('value', K.PM10, 604, K.COLORS)} END END")


@register("bronze_to_silver", sql(f"""
SELECT HT.*, {_HELPER_AQI} AS aqi, {_HELPER_LVL} AS aqi_level, {_HELPER_COL} AS aqi_color
FROM HT JOIN HQ USING (location_id, run_date)
WHERE HT.value >= HQ.q1 - {d(1.5)} * (HQ.q3 - HQ.q1) AND HT.value <= HQ.q3 + {d(1.5)} * (HQ.q3 - HQ.q1)""", "D",
          extra=[("HT", _HT), ("HQ", _HQ)]))
def q_bronze_to_silver(spark, sf):
    return ntz(bronze_to_silver_helper(Stages(spark, sf).R()))


# =========================================================== AQI (Q1–Q12)

@register("aqi_pm25", sql(f"""
SELECT _file, _ord, value, {O.aqi_case('value', K.PM25_PIPELINE, 500)} AS aqi,
  {O.level_case('value', K.PM25_PIPELINE, 500)} AS aqi_level FROM V WHERE lower(parameter) = 'pm25'""", "V"))
def q_aqi_pm25(spark, sf):
    v = Stages(spark, sf).V().where(X.ci_equals("parameter", "pm25"))
    return v.select("_file", "_ord", "value", Q.aqi_pm25("value").alias("aqi"),
                    Q.aqi_pm25_level("value").alias("aqi_level"))


def _nonneg(x: str) -> str:
    return f"CASE WHEN value >= 0 THEN {x} END"


@register("aqi_pm25_color", sql(f"""
SELECT _file, _ord, value, {_nonneg(O.aqi_case('value', K.PM25_HELPER, 500.4))} AS aqi,
  {_nonneg(O.level_case('value', K.PM25_HELPER, 500.4))} AS aqi_level,
  {_nonneg(O.level_case('value', K.PM25_HELPER, 500.4, K.COLORS))} AS aqi_color
FROM N WHERE lower(parameter) = 'pm25'""", "N"))
def q_aqi_pm25_color(spark, sf):
    n = Stages(spark, sf).N().where(X.ci_equals("parameter", "pm25"))
    return n.select("_file", "_ord", "value", Q.aqi_pm25_helper("value").alias("aqi"),
                    Q.aqi_pm25_helper_level("value").alias("aqi_level"),
                    Q.aqi_pm25_helper_color("value").alias("aqi_color"))


@register("aqi_pm25_open", sql(f"""
SELECT _file, _ord, value, {O.aqi_case('value', K.PM25_OPEN_TOP)} AS aqi,
  {O.level_case('value', K.PM25_OPEN_TOP)} AS aqi_level FROM N WHERE lower(parameter) = 'pm25'""", "N"))
def q_aqi_pm25_open(spark, sf):
    n = Stages(spark, sf).N().where(X.ci_equals("parameter", "pm25"))
    return n.select("_file", "_ord", "value", Q.aqi_pm25_open("value").alias("aqi"),
                    Q.aqi_pm25_open_level("value").alias("aqi_level"))


@register("aqi_pm10", sql(f"""
SELECT _file, _ord, value, {_nonneg(O.aqi_case('value', K.PM10, 604))} AS aqi,
  {_nonneg(O.level_case('value', K.PM10, 604))} AS aqi_level FROM N WHERE lower(parameter) = 'pm10'""", "N"))
def q_aqi_pm10(spark, sf):
    n = Stages(spark, sf).N().where(X.ci_equals("parameter", "pm10"))
    return n.select("_file", "_ord", "value", Q.aqi_pm10("value").alias("aqi"),
                    Q.aqi_pm10_level("value").alias("aqi_level"))


@register("aqi_columns", sql(f"""
SELECT _file, _ord, parameter, value, {_HELPER_AQI} AS aqi, {_HELPER_LVL} AS aqi_level,
  {_HELPER_COL} AS aqi_color FROM V""", "V"))
def q_aqi_columns(spark, sf):
    v = Q.add_aqi_columns(Stages(spark, sf).V())
    return v.select("_file", "_ord", "parameter", "value", "aqi", "aqi_level", "aqi_color")


def _estimate_sql() -> str:
    pm25 = O.aqi_case("value", K.PM25_OPEN_TOP)
    pm10 = O.aqi_case("value", K.PM10_OPEN_TOP)
    tv = f"(CASE WHEN lower(parameter) = 'pm10' THEN {pm10} ELSE {pm25} END)"
    est = (f"least(500, greatest(0, CASE WHEN lower(parameter) = 'pm25' "
           f"THEN CAST(trunc(value / {d(50.0)} * 100) AS INTEGER) "
           f"ELSE CAST(trunc(value / {d(100.0)} * 100) AS INTEGER) END))")
    return (f"CAST(CASE WHEN value IS NULL THEN NULL WHEN {tv} IS NOT NULL THEN {tv} "
            f"WHEN value <= 0 THEN 0 ELSE {est} END AS INTEGER)")


_EST = _estimate_sql()


@register("aqi_estimate", sql(f"""
SELECT _file, _ord, parameter, value, {_EST} AS aqi, {O.ladder_case(_EST)} AS aqi_level FROM N""", "N"))
def q_aqi_estimate(spark, sf):
    n = Stages(spark, sf).N()
    return n.select("_file", "_ord", "parameter", "value",
                    Q.aqi_estimate("value", "parameter").alias("aqi"),
                    Q.aqi_estimate_level("value", "parameter").alias("aqi_level"))


def _category_sql(a: str, idx: int) -> str:
    parts = " ".join(f"WHEN {a} BETWEEN {c[0]} AND {c[1]} THEN {q(c[idx])}" for c in K.AQI_CATEGORIES)
    return f"CASE {parts} WHEN {a} IS NOT NULL THEN {q(K.AQI_CATEGORIES[-1][idx])} END"


_Q2 = _nonneg(O.aqi_case("value", K.PM25_HELPER, 500.4))


@register("aqi_category", sql(f"""
SELECT _file, _ord, aqi, {_category_sql('aqi', 2)} AS level, {_category_sql('aqi', 3)} AS color,
  {_category_sql('aqi', 4)} AS health_message
FROM (SELECT _file, _ord, {_Q2} AS aqi FROM N WHERE lower(parameter) = 'pm25')""", "N"))
def q_aqi_category(spark, sf):
    n = Stages(spark, sf).N().where(X.ci_equals("parameter", "pm25"))
    a = n.select("_file", "_ord", Q.aqi_pm25_helper("value").alias("aqi"))
    return a.select("_file", "_ord", "aqi", Q.aqi_category("aqi").alias("c")) \
            .select("_file", "_ord", "aqi", "c.level", "c.color", "c.health_message")


@register("aqi_level_ladder", sql(f"SELECT event_id, value, {O.ladder_case('value')} AS aqi_level FROM RD", "RD"))
def q_aqi_level_ladder(spark, sf):
    return Stages(spark, sf).RD().select("event_id", "value", Q.level_ladder("value").alias("aqi_level"))


def _bp_values_sql() -> str:
    rows = []
    for param, table in K.BREAKPOINT_TABLES.items():
        for i, (lo, hi, alo, ahi, slope) in enumerate(Q.segments(table)):
            rows.append(f"({q(param)}, {d(lo)}, {d(hi)}, {alo}, {ahi}, {d(slope)}, {q(K.LEVELS[i])})")
    return ("SELECT * FROM (VALUES " + ", ".join(rows) +
            ") AS t(bp_parameter, bp_lo, bp_hi, bp_aqi_lo, bp_aqi_hi, bp_slope, bp_level)")


@register("aqi_breakpoint_join", sql(f"""
SELECT V._file, V._ord, V.parameter, V.value,
  CAST(trunc(bp.bp_slope * (V.value - bp.bp_lo) + bp.bp_aqi_lo) AS INTEGER) AS aqi, bp.bp_level AS aqi_level
FROM V LEFT JOIN ({_bp_values_sql()}) bp
  ON lower(V.parameter) = bp.bp_parameter AND V.value >= bp.bp_lo AND V.value <= bp.bp_hi""", "V"))
def q_aqi_breakpoint_join(spark, sf):
    v = Stages(spark, sf).V().select("_file", "_ord", "parameter", "value")
    return Q.aqi_by_breakpoint_join(v, Q.breakpoint_frame(spark))


_T = K.ALERT_THRESHOLDS


@register("guideline_exceedance", sql(f"""
SELECT location_id, parameter, count(*) AS days,
  CAST(sum(CAST(who AS INTEGER)) AS BIGINT) AS days_over_who,
  CAST(sum(CAST(nat AS INTEGER)) AS BIGINT) AS days_over_national,
  round(sum(CAST(who AS INTEGER)) / count(*) * 100, 2) AS share_over_who
FROM (SELECT *, CASE WHEN parameter = 'pm25' THEN value_avg > {_T['pm25_who_guideline']}
                     WHEN parameter = 'pm10' THEN value_avg > {_T['pm10_who_guideline']} END AS who,
                CASE WHEN parameter = 'pm25' THEN value_avg > {_T['pm25_vn_standard']}
                     WHEN parameter = 'pm10' THEN value_avg > {_T['pm10_vn_standard']} END AS nat
      FROM DF WHERE parameter IN ('pm25', 'pm10'))
GROUP BY location_id, parameter""", "DF"))
def q_guideline_exceedance(spark, sf):
    return serve.guideline_exceedance(Stages(spark, sf).DF())


@register("aqi_exceedance", sql(f"""
SELECT location_id, count(*) AS readings, count(*) FILTER (aqi > {_T['aqi_unhealthy']}) AS aqi_unhealthy,
  count(*) FILTER (aqi > {_T['aqi_very_unhealthy']}) AS aqi_very_unhealthy, count(*) FILTER (aqi > {_T['aqi_hazardous']}) AS aqi_hazardous,
  count(DISTINCT date) FILTER (aqi > {_T['aqi_unhealthy']}) AS days_unhealthy
FROM A WHERE aqi IS NOT NULL GROUP BY location_id""", "A"))
def q_aqi_exceedance(spark, sf):
    return serve.aqi_exceedance(Stages(spark, sf).A())


def _band_sql(v: str, kind: str) -> str:
    bounds, colors = K.BANDS[kind]
    parts = " ".join(f"WHEN {v} >= {b} THEN {q(c)}" for b, c in reversed(list(zip(bounds, colors[1:]))))
    return f"CASE {parts} WHEN {v} IS NOT NULL THEN {q(colors[0])} END"


@register("band_classify", sql(f"""
SELECT location_id, date, parameter, value_avg,
  CASE WHEN parameter = 'pm25' THEN {_band_sql('value_avg', 'pm25')} ELSE {_band_sql('value_avg', 'pm10')} END AS band
FROM DF WHERE parameter IN ('pm25', 'pm10')""", "DF"))
def q_band_classify(spark, sf):
    return serve.band_classify(Stages(spark, sf).DF())


# =========================================================== quality

@register("quality_report", sql(f"""
SELECT *, concat_ws('; ',
  CASE WHEN total_records < {K.MIN_RECORDS} THEN 'Too few records: ' || total_records || ' < {K.MIN_RECORDS}' END,
  CASE WHEN null_percent > {d(K.MAX_NULL_PERCENT)}
       THEN 'Too many nulls: ' || null_percent || '% > {K.MAX_NULL_PERCENT}%' END) AS issues
FROM QR""", "QR"))
def q_quality_report(spark, sf):
    return Stages(spark, sf).QR()


@register("quality_gate", sql("SELECT * FROM S", "S"))
def q_quality_gate(spark, sf):
    return ntz(Stages(spark, sf).S())


_A_COLS = O._DATA_COLS


def _full_sql() -> str:
    per = ", ".join(f"CAST(sum(CAST({c} IS NULL AS INTEGER)) AS BIGINT) AS nulls_{c}" for c in _A_COLS)
    tot = " + ".join(f"nulls_{c}" for c in _A_COLS)
    return f"""
SELECT *, (total_records >= {K.MIN_RECORDS} AND null_percent <= {d(K.MAX_NULL_PERCENT)}
           AND duplicate_percent <= {d(K.MAX_DUPLICATE_PERCENT)}) AS passed,
  concat_ws('; ', CASE WHEN total_records < {K.MIN_RECORDS} THEN 'Too few records: ' || total_records || ' < {K.MIN_RECORDS}' END,
    CASE WHEN null_percent > {d(K.MAX_NULL_PERCENT)} THEN 'Too many nulls: ' || round(({tot}) / (total_records * {len(_A_COLS)}) * 100, 1) || '% > {K.MAX_NULL_PERCENT}%' END,
    CASE WHEN duplicate_percent > {d(K.MAX_DUPLICATE_PERCENT)} 
      THEN 'Too many duplicates: ' || round((total_records - _distinct) / total_records * 100, 1) || '% > {K.MAX_DUPLICATE_PERCENT}%' END) AS issues
FROM (SELECT *, {tot} AS null_count,
        round(({tot}) / (total_records * {len(_A_COLS)}) * 100, 2) AS null_percent,
        total_records - _distinct AS duplicate_count,
        round((total_records - _distinct) / total_records * 100, 2) AS duplicate_percent
      FROM (SELECT location_id, run_date, count(*) AS total_records,
              count(DISTINCT ({", ".join(_A_COLS)})) AS _distinct, {per}
            FROM A GROUP BY location_id, run_date))"""


FULL_SQL = _full_sql()


@register("quality_report_full", sql(FULL_SQL.replace("SELECT *,", "SELECT * EXCLUDE (_distinct),", 1), "A"))
def q_quality_report_full(spark, sf):
    return quality_report_full(Stages(spark, sf).A())


_INVALID_SQL = f"""SELECT location_id, run_date,
  CAST(sum(CAST(NOT {_valid_sql('parameter', 'value')} AS INTEGER)) AS BIGINT) AS _invalid
FROM A GROUP BY location_id, run_date"""


@register("quality_rules", sql(f"""
SELECT location_id, run_date, rule, level, check_type, observed, threshold,
  CASE WHEN check_type = 'count_check' THEN observed >= threshold ELSE observed <= threshold END AS passed
FROM (
  SELECT location_id, run_date, 'min_records' AS rule, 'error' AS level, 'count_check' AS check_type,
    CAST(total_records AS DOUBLE) AS observed, {d(K.MIN_RECORDS)} AS threshold FROM F
  UNION ALL SELECT location_id, run_date, 'max_null_percent', 'warning', 'null_check', null_percent,
    {d(K.MAX_NULL_PERCENT)} FROM F
  UNION ALL SELECT location_id, run_date, 'max_duplicate_percent', 'warning', 'duplicate_check',
    duplicate_percent, {d(K.MAX_DUPLICATE_PERCENT)} FROM F
  UNION ALL SELECT F.location_id, F.run_date, 'value_range', 'error', 'range_check',
    CAST(IV._invalid AS DOUBLE), {d(0.0)} FROM F JOIN IV USING (location_id, run_date))""", "A",
          extra=[("F", FULL_SQL), ("IV", _INVALID_SQL)]))
def q_quality_rules(spark, sf):
    return quality_rules(Stages(spark, sf).A())


@register("step_report", sql("""
SELECT 0 AS step_no, 'bronze' AS step, count(*) AS rows FROM R
UNION ALL SELECT 1, 'deduplicated', count(*) FROM D
UNION ALL SELECT 2, 'validated', count(*) FROM V
UNION ALL SELECT 3, 'outliers_removed', count(*) FROM I
UNION ALL SELECT 4, 'silver', count(*) FROM S""", "S"))
def q_step_report(spark, sf):
    s = Stages(spark, sf)
    return profile.step_report(s.R(), pipeline.STEPS)


# =========================================================== facts and dimensions

@register("hourly_fact", sql("SELECT * FROM HF", "HF"))
def q_hourly_fact(spark, sf):
    return Stages(spark, sf).HF()


@register("daily_fact", sql("SELECT * FROM DF", "DF"))
def q_daily_fact(spark, sf):
    return Stages(spark, sf).DF()


def _all_sql(keys: str) -> str:
    return f"""
SELECT {keys}, min(value) AS value_min, max(value) AS value_max, {O.exact_avg()} AS value_avg,
  round(median(value), 6) AS value_median, count(value) AS value_count
FROM (SELECT location_id, value, CAST(substr(datetime, 1, 10) AS DATE) AS date,
        TRY_CAST(substr(datetime, 12, 2) AS INTEGER) AS hour FROM N)
WHERE {" AND ".join(k.strip() + " IS NOT NULL" for k in keys.split(","))}
GROUP BY {keys}"""


@register("hourly_all", sql(_all_sql("location_id, date, hour"), "N"))
def q_hourly_all(spark, sf):
    n = facts.local_hour_parts(Stages(spark, sf).N(), "datetime")
    return round6(facts.hourly_all(n))


@register("daily_all", sql(_all_sql("location_id, date"), "N"))
def q_daily_all(spark, sf):
    n = facts.local_hour_parts(Stages(spark, sf).N(), "datetime")
    return round6(facts.daily_all(n))


@register("group_size", sql("""
SELECT location_id, date, parameter, count(*) AS count FROM V
WHERE location_id IS NOT NULL AND date IS NOT NULL AND parameter IS NOT NULL
GROUP BY location_id, date, parameter""", "V"))
def q_group_size(spark, sf):
    return facts.group_size(Stages(spark, sf).V())


@register("dim_location", sql("SELECT * FROM DL", "DL"))
def q_dim_location(spark, sf):
    return Stages(spark, sf).DL()


@register("dim_parameter", sql("SELECT * FROM DP", "DP"))
def q_dim_parameter(spark, sf):
    return Stages(spark, sf).DP()


@register("dim_time", sql("SELECT * FROM DT", "DT"))
def q_dim_time(spark, sf):
    return Stages(spark, sf).DT()


def _view_level_sql() -> str:
    parts = " ".join(f"WHEN d.parameter = 'pm25' AND d.value_avg <= {d(b)} THEN {q(l)}"
                     for b, l in zip(K.VIEW_PM25_BOUNDS, K.VIEW_LEVELS))
    return (f"CASE {parts} WHEN d.parameter = 'pm25' AND d.value_avg > {d(K.VIEW_PM25_BOUNDS[-1])} "
            f"THEN {q(K.VIEW_LEVELS[-1])} ELSE 'N/A' END")


@register("gold_aqi_summary", sql(f"""
SELECT d.date, d.parameter, d.value_avg AS daily_avg, d.value_max AS daily_max, d.value_min AS daily_min,
  d.value_count AS measurement_count, l.location_name, l.city, t.day_of_week, t.is_weekend,
  {_view_level_sql()} AS aqi_level
FROM SDF d LEFT JOIN DL l ON d.location_id = l.location_id LEFT JOIN DT t ON d.date = t.date""", "SDF", "DL", "DT"))
def q_gold_aqi_summary(spark, sf):
    s = Stages(spark, sf)
    return facts.gold_aqi_summary(s.SDF(), s.DL(), s.DT())


# =========================================================== profiling

@register("table_counts", sql("""
SELECT 'hourly' AS table_name, count(*) AS n FROM SHF
UNION ALL SELECT 'daily', count(*) FROM SDF
UNION ALL SELECT 'dim_location', count(*) FROM DL
UNION ALL SELECT 'dim_parameter', count(*) FROM DP
UNION ALL SELECT 'dim_time', count(*) FROM DT""", "SHF", "SDF", "DL", "DP", "DT"))
def q_table_counts(spark, sf):
    s = Stages(spark, sf)
    return profile.table_counts({"hourly": s.SHF(), "daily": s.SDF(), "dim_location": s.DL(),
                                 "dim_parameter": s.DP(), "dim_time": s.DT()})


@register("station_coverage", sql("""
SELECT location_id, count(*) AS total_records, min(date) AS first_date, max(date) AS last_date,
  count(DISTINCT parameter) AS num_parameters FROM SHF GROUP BY location_id""", "SHF"))
def q_station_coverage(spark, sf):
    return profile.station_coverage(Stages(spark, sf).SHF())


@register("gold_station_coverage", sql("""
SELECT count(*) AS count, min(date) AS first_date, max(date) AS last_date FROM SHF
WHERE CAST(location_id AS VARCHAR) LIKE '%1%'""", "SHF"))
def q_gold_station_coverage(spark, sf):
    return profile.gold_station_coverage(Stages(spark, sf).SHF(), "%1%")


@register("gold_outcome", sql("""
SELECT table_name, locations, locations < 2 AS warning FROM (
  SELECT 'hourly' AS table_name, count(DISTINCT location_id) AS locations FROM SHF
  UNION ALL SELECT 'daily', count(DISTINCT location_id) FROM SDF
  UNION ALL SELECT 'dim_location', count(DISTINCT location_id) FROM DL)""", "SHF", "SDF", "DL"))
def q_gold_outcome(spark, sf):
    s = Stages(spark, sf)
    return profile.gold_outcome(s.SHF(), s.SDF(), s.DL())


@register("raw_coverage", sql("""
SELECT location_id, location_name, count(*) AS count, min(created_at) AS first_record,
  max(created_at) AS last_record, min(measurement_time) AS first_measurement,
  max(measurement_time) AS last_measurement FROM RD GROUP BY location_id, location_name""", "RD"))
def q_raw_coverage(spark, sf):
    return ntz(profile.raw_coverage(Stages(spark, sf).RD()))


# =========================================================== serving

@register("latest_daily", sql("""
SELECT date, parameter, value_avg, value_max, location_id FROM SDF
ORDER BY date DESC, parameter, location_id LIMIT 5""", "SDF"))
def q_latest_daily(spark, sf):
    return serve.latest_daily(Stages(spark, sf).SDF())


@register("union_files", sql(f"""
SELECT {BRONZE_COLS} FROM R WHERE _file = 'a'
UNION ALL
SELECT location_id, parameter, datetime, NULL AS unit, value, run_date, _file, _ord FROM R WHERE _file = 'b'""", "R"))
def q_union_files(spark, sf):
    r = Stages(spark, sf).R()
    a = r.where(F.col("_file") == "a")
    b = r.where(F.col("_file") == "b").drop("unit")
    return serve.union_files([a, b]).select(*r.columns)


def _recent(src: str, ts: str, hours: int) -> str:
    return f"{ts} > (SELECT max({ts}) FROM {src}) - INTERVAL {hours} HOUR"


@register("series_pm25", sql(f"""
SELECT datetime AS time, value FROM V WHERE {_recent('V', 'datetime', 6)} AND parameter = 'pm25'""", "V"))
def q_series_pm25(spark, sf):
    return ntz(serve.series(Stages(spark, sf).V(), "pm25", ts="datetime"))


@register("series_wide", sql(f"""
SELECT datetime AS time,
  {", ".join(f"max(CASE WHEN parameter = {q(p)} THEN value END) AS {p}" for p in serve.SERIES_PARAMETERS)}
FROM V WHERE {_recent('V', 'datetime', 6)} AND parameter IN
  ({", ".join(q(p) for p in serve.SERIES_PARAMETERS)})
GROUP BY datetime""", "V"))
def q_series_wide(spark, sf):
    return ntz(serve.series_wide(Stages(spark, sf).V(), ts="datetime"))


@register("latest_readings", sql(f"""
SELECT location_name, parameter, value, unit, measurement_time,
  CASE WHEN alerted THEN 'Có' ELSE 'Không' END AS alerted_label, event_id
FROM RF WHERE {_recent('RF', 'measurement_time', 24)}
ORDER BY measurement_time DESC, location_id, event_id LIMIT 100""", "RF"))
def q_latest_readings(spark, sf):
    return ntz(serve.latest_readings(Stages(spark, sf).RF()))


@register("readings_24h", sql(f"SELECT count(*) AS count FROM RF WHERE {_recent('RF', 'measurement_time', 24)}",
                              "RF"))
def q_readings_24h(spark, sf):
    return serve.readings_24h(Stages(spark, sf).RF())


@register("alerts_24h", sql(f"""
SELECT count, {_band_sql('count', 'alerts')} AS band FROM (
  SELECT count(*) AS count FROM RF WHERE {_recent('RF', 'measurement_time', 24)} AND alerted)""", "RF"))
def q_alerts_24h(spark, sf):
    return serve.alerts_24h(Stages(spark, sf).RF())


@register("distinct_parameters", sql("SELECT count(DISTINCT parameter) AS count FROM RF", "RF"))
def q_distinct_parameters(spark, sf):
    return serve.distinct_parameters(Stages(spark, sf).RF())


# =========================================================== alerts (T4 batch, A17, P10)

@register("alert_rollup", sql(f"""
SELECT location_id, count(*) AS num_exceeded, max(value) AS max_aqi,
  first({O.ladder_case('value')} ORDER BY value DESC, created_at, event_id) AS max_aqi_level,
  first(main_pollutant ORDER BY created_at, event_id) AS main_pollutant
FROM AL GROUP BY location_id""", "AL"))
def q_alert_rollup(spark, sf):
    return alert_rollup(Stages(spark, sf).AL())


@register("alert_text", sql(f"""
SELECT event_id,
  '[CẢNH BÁO AQI] ' || coalesce(location_name, 'None') || ' vượt ngưỡng (AQI=' || CAST(CAST(value AS DOUBLE) AS VARCHAR)
    || CASE WHEN nullif(main_pollutant, '') IS NOT NULL THEN ' - Chất ô nhiễm chính: ' || main_pollutant ELSE '' END
    || ')' AS subject,
  concat_ws(', ', location_name, nullif(locality, ''), nullif(country, '')) AS location_info,
  {O.ladder_case('value')} AS aqi_level
FROM AL""", "AL"))
def q_alert_text(spark, sf):
    return alert_text(Stages(spark, sf).AL())


def _main_sql(name: str) -> str:
    return f"CASE WHEN nullif({name}, '') IS NOT NULL THEN ', Main: ' || {name} ELSE '' END"


@register("alert_summary", sql(f"""
SELECT location_id, num_exceeded, max_aqi, '[CẢNH BÁO AQI] ' || CASE WHEN num_exceeded > 1
    THEN num_exceeded || ' bản ghi vượt ngưỡng tại ' || name || ' (AQI cao nhất: ' ELSE name || ' vượt ngưỡng (AQI=' END
  || CAST(CAST(max_aqi AS DOUBLE) AS VARCHAR) || {_main_sql('main')} || ')' AS subject
FROM (SELECT location_id, count(*) AS num_exceeded, max(value) AS max_aqi,
    coalesce(first(location_name ORDER BY created_at, event_id), 'None') AS name, first(main_pollutant ORDER BY created_at, event_id) AS main
  FROM AL GROUP BY location_id)""", "AL"))
def q_alert_summary(spark, sf):
    return alert_summaries(Stages(spark, sf).AL())


@register("alert_body", sql(f"""
SELECT event_id, 'CẢNH BÁO AQI tại ' || concat_ws(', ', location_name, nullif(locality, ''), nullif(country, '')) || ': AQI='
  || CAST(CAST(value AS DOUBLE) AS VARCHAR) || ', mức ' || {O.ladder_case('value')} || '. Giá trị ' || upper(parameter) || ' = '
  || CAST(CAST(value AS DOUBLE) AS VARCHAR) || ' ' || unit || ', vượt ngưỡng ' || CAST({d(K.STREAM_AQI_THRESHOLD)} AS VARCHAR) || ' ' || unit
  || '. Thời điểm đo: ' || strftime(measurement_time, '%Y-%m-%d %H:%M:%S UTC') AS body
FROM AL""", "AL"))
def q_alert_body(spark, sf):
    return alert_bodies(Stages(spark, sf).AL())


# =========================================================== scalars over messages and payloads

_CODE_SQL = ("CASE event_type WHEN 'click' THEN 'p2' WHEN 'view' THEN 'p1' WHEN 'purchase' THEN 'n2' "
             "WHEN 'signup' THEN 'co' WHEN 'error' THEN 'o3' ELSE 's2' END")


def _map_sql(k: str, m: dict, default: str) -> str:
    parts = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in m.items())
    return f"coalesce(CASE {k} {parts} END, {default})"


@register("pollutant_map", sql(f"""
SELECT event_id, code, {_map_sql('code', K.POLLUTANT_CODES, 'code')} AS parameter,
  {_map_sql('code', K.POLLUTANT_DISPLAY, 'upper(code)')} AS display
FROM (SELECT event_id, {_CODE_SQL} AS code FROM events)"""))
def q_pollutant_map(spark, sf):
    from hazelake.sources.fixtures import _main_code, events
    ev = events(spark, sf).select("event_id", _main_code(F.col("event_type")).alias("code"))
    return ev.select("event_id", "code", X.pollutant_code("code").alias("parameter"),
                     X.pollutant_display("code").alias("display"))


def _param_raw_spark():
    o = F.col("_ord") % 4
    return (F.when(o == 0, F.upper("parameter"))
             .when(o == 1, F.concat(F.col("parameter"), F.lit(" mass")))
             .when(o == 2, F.concat(F.lit(" "), F.col("parameter"), F.lit("_concentration")))
             .otherwise(F.concat(F.substring("parameter", 1, 2), F.lit("."), F.substring("parameter", 3, 10))))
_PARAM_RAW_SQL = ("CASE _ord % 4 WHEN 0 THEN upper(parameter) WHEN 1 THEN parameter || ' mass' "
                  "WHEN 2 THEN ' ' || parameter || '_concentration' "
                  "ELSE substr(parameter, 1, 2) || '.' || substr(parameter, 3, 10) END")


def _normalize_param_sql(raw: str) -> str:
    t = f"lower(regexp_replace(coalesce(nullif({raw}, ''), ''), '^\\s+|\\s+$', '', 'g'))"
    t = f"replace(replace({t}, ' mass', ''), ' concentration', '')"
    t = f"regexp_replace(translate({t}, '_.', '  '), '^\\s+|\\s+$', '', 'g')"
    parts = " ".join(f"WHEN _t IN ({', '.join(q(n) for n in names)}) THEN {q(c)}" for names, c in K.PARAM_ALIASES)
    return t, f"CASE {parts} ELSE translate(_t, ' .', '') END"


_NP_T, _NP_CASE = _normalize_param_sql("raw")


@register("normalize_param", sql(f"""
SELECT _file, _ord, raw, {_NP_CASE} AS parameter_norm
FROM (SELECT _file, _ord, raw, {_NP_T} AS _t FROM (SELECT _file, _ord, {_PARAM_RAW_SQL} AS raw FROM D))""", "D"))
def q_normalize_param(spark, sf):
    dd = Stages(spark, sf).D().select("_file", "_ord", _param_raw_spark().alias("raw"))
    return dd.select("_file", "_ord", "raw", X.normalize_param("raw").alias("parameter_norm"))


@register("parse_utc", sql("""
SELECT event_id, CASE WHEN event_id % 31 = 0 THEN NULL ELSE date_trunc('second', ts) END AS sensor_time,
  date_trunc('second', ts) AS message_time FROM events"""))
def q_parse_utc(spark, sf):
    m = Stages(spark, sf).M()
    first = F.element_at(F.col("sensors"), 1)
    sensor_time = F.when(F.size("sensors") > 0,
                         parse_utc_chain(first["latest_datetime"], F.col("timestamp"), fallback=F.col("ingest_ts")))
    return ntz(m.select("event_id", sensor_time.alias("sensor_time"),
                        parse_utc_chain(F.col("timestamp"), fallback=F.col("ingest_ts")).alias("message_time")))


@register("partition_keys", sql("""
SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
  strftime(ts, '%H') AS hour FROM events"""))
def q_partition_keys(spark, sf):
    m = Stages(spark, sf).M()
    return m.select("event_id", *partition_keys(parse_utc_chain(F.col("timestamp"), fallback=F.col("ingest_ts"))))


@register("sensor_text", sql("""
SELECT event_id, CASE WHEN event_id % 31 = 0 THEN '    Không có dữ liệu sensors'
  ELSE '    • AQI: ' || CAST(value * 4 AS VARCHAR) || ' ' || CASE WHEN event_id % 7 = 0 THEN 'µg/m³' ELSE 'AQI' END
       || CASE WHEN event_id % 19 = 0 THEN ' (Cập nhật: not-a-time)'
               ELSE ' (Cập nhật: ' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || ')' END END AS text
FROM events"""))
def q_sensor_text(spark, sf):
    m = Stages(spark, sf).M()
    return m.select("event_id", X.sensor_text("sensors").alias("text"))


@register("stream_sample", sql("""
SELECT event_id, CAST(user_id % 5 AS VARCHAR) AS location_id, ts AS ingest_ts FROM events
ORDER BY ts DESC, event_id DESC LIMIT 20"""))
def q_stream_sample(spark, sf):
    m = Stages(spark, sf).M()
    return ntz(m.orderBy(F.col("ingest_ts").desc(), F.col("event_id").desc()).limit(20)
                .select("event_id", "location_id", "ingest_ts"))


_COUNTRY_SQL = "CASE WHEN user_id % 2 = 0 THEN 'Vietnam' ELSE 'Laos' END"


@register("country_code", sql(f"""
SELECT event_id, country, {_map_sql('country', K.COUNTRY_CODES, 'upper(substr(country, 1, 2))')} AS country_code
FROM (SELECT event_id, {_COUNTRY_SQL} AS country FROM events)"""))
def q_country_code(spark, sf):
    p = Stages(spark, sf).P()
    c = p.select("event_id", F.get_json_object("payload", "$.data.country").alias("country"))
    return c.select("event_id", "country", X.country_code("country").alias("country_code"))


def queries() -> dict[str, QueryFn]:
    from hazelake.plans import catalog_io  # noqa: F401  (registers source/sink/stream queries)
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from hazelake.plans import catalog_io  # noqa: F401
    return dict(ORACLE)


@register("quartiles", sql("""
SELECT location_id, parameter, count(value) AS n, round(quantile_cont(value, 0.25), 6) AS q25,
  round(quantile_cont(value, 0.75), 6) AS q75 FROM V
WHERE location_id IS NOT NULL AND parameter IS NOT NULL AND value IS NOT NULL GROUP BY location_id, parameter""",
                           "V"))
def q_quartiles(spark, sf):
    """Exact quartiles per station and pollutant (split-quantile operator)."""
    from hazelake.operators.quantiles import group_quantiles
    qs = group_quantiles(Stages(spark, sf).V(), ["location_id", "parameter"], "value", {"q25": 0.25, "q75": 0.75})
    return round6(qs.withColumnRenamed("_n", "n"), ["q25", "q75"])


@register("sql_functions", sql(f"""
SELECT _file, _ord, value, aqi, aqi_level, {_category_sql('aqi', 2)} AS category FROM (
  SELECT _file, _ord, value, {O.aqi_case('value', K.PM25_PIPELINE, 500)} AS aqi,
    {O.level_case('value', K.PM25_PIPELINE, 500)} AS aqi_level FROM V WHERE lower(parameter) = 'pm25')""", "V"))
def q_sql_functions(spark, sf):
    """§2.12: the AQI functions called from SQL text (SQL-language temporary functions)."""
    import uuid

    from hazelake.functions.sqlfuncs import register_sql_functions
    register_sql_functions(spark)
    view = f"hz_validated_{uuid.uuid4().hex[:8]}"
    Stages(spark, sf).V().createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT _file, _ord, value, hz_aqi_pm25(value) AS aqi, hz_aqi_level_pm25(value) AS aqi_level,
               hz_aqi_category(hz_aqi_pm25(value)) AS category
        FROM {view} WHERE lower(parameter) = 'pm25'""")


@register("stream_sample_ids", sql("""
SELECT DISTINCT location_id, contains(location_id, '1') AS matches FROM (
  SELECT CAST(user_id % 5 AS VARCHAR) AS location_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 20)"""))
def q_stream_sample_ids(spark, sf):
    """Distinct station ids among the newest 20 messages, and whether an id matches."""
    m = Stages(spark, sf).M()
    newest = m.orderBy(F.col("ingest_ts").desc(), F.col("event_id").desc()).limit(20)
    return newest.select("location_id").distinct().withColumn("matches", F.col("location_id").contains("1"))
