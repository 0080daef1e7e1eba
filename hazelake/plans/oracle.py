"""DuckDB SQL for the correctness oracle.

The stage CTEs restate each operator in plain SQL over the pre-registered driver
views; CASE ladders are generated from the same fixed tables as the Spark side.
`sql(body, *ctes)` prepends the needed CTEs in dependency order.
"""

from __future__ import annotations

from hazelake import constants as K
from hazelake.functions.aqi import segments


def d(x) -> str:
    """A DOUBLE literal that parses to exactly the Python float."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ----------------------------------------------------------------- ladders
def aqi_case(v: str, table, above=None) -> str:
    parts = []
    for lo, hi, alo, ahi, slope in segments(table):
        if hi is None:
            parts.append(f"WHEN {v} >= {d(lo)} THEN {ahi}")
        else:
            parts.append(f"WHEN {v} >= {d(lo)} AND {v} <= {d(hi)} THEN "
                         f"CAST(trunc({d(slope)} * ({v} - {d(lo)}) + {alo}) AS INTEGER)")
    if above is not None:
        parts.append(f"WHEN {v} > {d(above)} THEN 500")
    return "CASE " + " ".join(parts) + " END"


def level_case(v: str, table, above=None, labels=K.LEVELS) -> str:
    parts = []
    for i, (lo, hi, alo, ahi, slope) in enumerate(segments(table)):
        cond = f"{v} >= {d(lo)}" if hi is None else f"{v} >= {d(lo)} AND {v} <= {d(hi)}"
        parts.append(f"WHEN {cond} THEN {q(labels[i])}")
    if above is not None:
        parts.append(f"WHEN {v} > {d(above)} THEN {q(labels[-1])}")
    return "CASE " + " ".join(parts) + " END"


def ladder_case(a: str, labels=K.LEVELS_VI) -> str:
    parts = [f"WHEN {a} <= {b} THEN {q(l)}" for b, l in zip(K.LADDER_BOUNDS, labels)]
    return "CASE " + " ".join(parts) + f" WHEN {a} IS NOT NULL THEN {q(labels[-1])} END"


def range_bounds(key: str, ranges) -> tuple[str, str]:
    lo = "CASE " + " ".join(f"WHEN {key} = {q(p)} THEN {d(a)}" for p, (a, b) in ranges.items()) + " END"
    hi = "CASE " + " ".join(f"WHEN {key} = {q(p)} THEN {d(b)}" for p, (a, b) in ranges.items()) + " END"
    return lo, hi


def in_range(p="parameter", v="value", ranges=K.PIPELINE_RANGES) -> str:
    lo, hi = range_bounds(f"lower({p})", ranges)
    return f"({v} IS NOT NULL AND (({lo}) IS NULL OR ({v} >= ({lo}) AND {v} <= ({hi}))))"


def pipeline_units(p="parameter", u="unit", v="value") -> tuple[str, str]:
    conds = []
    for rp, ru, f in K.PIPELINE_CONVERSIONS:
        c = f"coalesce(contains(lower({u}), {q(ru)}), false)"
        if rp != "*":
            c = f"(coalesce(lower({p}) = {q(rp)}, false) AND {c})"
        conds.append((c, f))
    val = "CASE " + " ".join(f"WHEN {c} THEN {v} * {d(f)}" for c, f in conds) + f" ELSE {v} END"
    hit = " OR ".join(c for c, _ in conds)
    unit = f"CASE WHEN {hit} THEN {q(K.TARGET_UNIT)} ELSE {u} END"
    return val, unit


def helper_units(p="parameter", u="unit", v="value") -> tuple[str, str]:
    ppm = f"({v} IS NOT NULL AND coalesce(contains(lower({u}), 'ppm'), false))"
    ppb = f"({v} IS NOT NULL AND NOT {ppm} AND coalesce(contains(lower({u}), 'ppb'), false))"
    mg = (f"({v} IS NOT NULL AND NOT {ppm} AND NOT {ppb} "
          f"AND coalesce(contains(lower({u}), {q('mg/m³')}), false))")
    val = f"CASE WHEN {ppm} THEN {v} * {d(K.HELPER_PPM_FACTOR)} "
    for gas, f in K.HELPER_PPB_FACTORS:
        val += f"WHEN {ppb} AND lower({p}) = {q(gas)} THEN {v} * {d(f)} "
    val += f"WHEN {mg} THEN {v} * {d(K.HELPER_MG_FACTOR)} ELSE {v} END"
    gases = ", ".join(q(g) for g, _ in K.HELPER_PPB_FACTORS)
    hit = f"({ppm} OR ({ppb} AND coalesce(lower({p}) IN ({gases}), false)) OR {mg})"
    unit = f"CASE WHEN {hit} THEN {q(K.TARGET_UNIT)} ELSE {u} END"
    return val, unit


def parse_ts(t: str) -> str:
    base = f"TRY_CAST(replace(left(trim({t}), 19), 'T', ' ') AS TIMESTAMP)"
    return f"CASE WHEN {t} LIKE '%+07:00' THEN {base} - INTERVAL 7 HOUR ELSE {base} END"


def r6(x: str) -> str:
    return f"round({x}, 6)"


def exact_avg(v: str = "value", scale: int = 6, in_scale: int = 9) -> str:
    """Mean from an exact DECIMAL sum, rounded half away from zero with integer arithmetic."""
    unit = 10 ** (in_scale - scale)
    si = f"CAST(sum(CAST({v} AS DECIMAL(38,{in_scale}))) * {10 ** in_scale} AS HUGEINT)"
    n = f"count({v})"
    q = f"((abs({si}) * 2 + {n} * {unit}) // ({n} * {2 * unit}))"
    return (f"CASE WHEN {n} = 0 THEN NULL WHEN {si} < 0 THEN -{q} ELSE {q} END "
            f"/ CAST({10 ** scale} AS DOUBLE)")


# ----------------------------------------------------------------- stage CTEs
_PM25 = "lower(parameter) = 'pm25'"
_U_VAL, _U_UNIT = pipeline_units()
_H_VAL, _H_UNIT = helper_units()

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte("B", [], """
SELECT CAST(user_id % 5 AS VARCHAR) AS location_id,
  CASE WHEN event_id % 50 = 0 THEN 'so2' WHEN event_type = 'click' THEN 'pm25'
       WHEN event_type = 'view' THEN 'pm10' WHEN event_type = 'purchase' THEN 'no2'
       WHEN event_type = 'signup' THEN 'co' ELSE 'o3' END AS parameter,
  CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
       WHEN 1 THEN strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00'
       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS datetime,
  CASE event_id % 10 WHEN 0 THEN 'ppb' WHEN 1 THEN 'ppm' WHEN 2 THEN 'mg/m³' ELSE 'µg/m³' END AS unit,
  CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 23 = 0 THEN -value
       WHEN event_id % 29 = 0 THEN 0 * value WHEN event_id % 41 = 0 THEN value * 20
       ELSE value END AS value,
  CAST(CASE WHEN event_id % 3 = 1 THEN ts + INTERVAL 7 HOUR ELSE ts END AS DATE) AS run_date,
  'a' AS _file, event_id AS _ord
FROM events""")
cte("R", ["B"], """
SELECT * FROM B
UNION ALL
SELECT location_id, parameter, datetime, unit, value + 1, run_date, 'b', _ord FROM B WHERE _ord % 13 = 0""")
# C1
cte("D", ["R"], """
SELECT location_id, parameter, datetime, unit, value, run_date, _file, _ord FROM (
  SELECT *, row_number() OVER (PARTITION BY location_id, datetime, parameter ORDER BY _file, _ord) AS _rn
  FROM R) WHERE _rn = 1""")
# C3
cte("N", ["D"], f"""
SELECT location_id, parameter, datetime, {_U_UNIT} AS unit, {_U_VAL} AS value, run_date, _file, _ord FROM D""")
# C6
cte("T", ["N"], f"""
SELECT location_id, parameter, ts AS datetime, unit, value, run_date, _file, _ord,
  CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week
FROM (SELECT *, {parse_ts('datetime')} AS ts FROM N)""")
# C8
cte("V", ["T"], f"SELECT * FROM T WHERE {in_range()}")
# C11
cte("IQ", ["V"], """
SELECT location_id, run_date, count(value) AS n,
  quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
FROM V WHERE location_id IS NOT NULL AND run_date IS NOT NULL AND value IS NOT NULL
GROUP BY location_id, run_date""")
cte("I", ["V", "IQ"], f"""
SELECT V.* FROM V LEFT JOIN IQ USING (location_id, run_date)
WHERE coalesce(IQ.n, 0) <= {K.IQR_MIN_ROWS}
   OR (V.value >= IQ.q1 - {d(K.IQR_MULTIPLIER)} * (IQ.q3 - IQ.q1)
       AND V.value <= IQ.q3 + {d(K.IQR_MULTIPLIER)} * (IQ.q3 - IQ.q1))""")
# Q1
cte("A", ["I"], f"""
SELECT *, CASE WHEN {_PM25} THEN {aqi_case('value', K.PM25_PIPELINE, 500)} END AS aqi,
  CASE WHEN {_PM25} THEN {level_case('value', K.PM25_PIPELINE, 500)} END AS aqi_level
FROM I""")
# A5
_DATA_COLS = ["location_id", "parameter", "datetime", "unit", "value", "date", "hour", "day_of_week",
              "aqi", "aqi_level"]
_NULLS = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in _DATA_COLS)
cte("QR", ["A"], f"""
SELECT location_id, run_date, total_records, null_count, null_percent,
  (total_records >= {K.MIN_RECORDS} AND null_percent <= {d(K.MAX_NULL_PERCENT)}) AS passed
FROM (SELECT location_id, run_date, count(*) AS total_records, CAST(sum({_NULLS}) AS BIGINT) AS null_count,
        round(sum({_NULLS}) / (count(*) * {len(_DATA_COLS)}) * 100, 2) AS null_percent
      FROM A GROUP BY location_id, run_date)""")
# J7 -> silver
cte("S", ["A", "QR"], """
SELECT A.* FROM A WHERE EXISTS (
  SELECT 1 FROM QR WHERE QR.passed AND QR.location_id = A.location_id AND QR.run_date = A.run_date)""")


def _stats_sql(src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return f"""
SELECT {k}, min(value) AS value_min, max(value) AS value_max, {exact_avg()} AS value_avg,
  {r6('median(value)')} AS value_median, count(value) AS value_count,
  {r6('stddev_samp(value)')} AS value_std
FROM {src} WHERE {nn} GROUP BY {k}"""


cte("HF", ["V"], _stats_sql("V", ["location_id", "date", "hour", "parameter"]))
cte("DF", ["V"], _stats_sql("V", ["location_id", "date", "parameter"]))
cte("SHF", ["S"], _stats_sql("S", ["location_id", "date", "hour", "parameter"]))
cte("SDF", ["S"], _stats_sql("S", ["location_id", "date", "parameter"]))
cte("DL", ["S"], f"""
SELECT DISTINCT location_id, 'Location ' || location_id AS location_name, {q(K.DIM_CITY)} AS city,
  {q(K.DIM_COUNTRY)} AS country, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude
FROM S WHERE location_id IS NOT NULL""")
cte("DP", ["S"], f"""
SELECT DISTINCT parameter, upper(parameter) AS parameter_name, {q(K.TARGET_UNIT)} AS unit,
  CAST(NULL AS VARCHAR) AS description FROM S WHERE parameter IS NOT NULL""")
cte("DT", ["S"], """
SELECT date, CAST(day(date) AS INTEGER) AS day, CAST(month(date) AS INTEGER) AS month,
  CAST(year(date) AS INTEGER) AS year, dayname(date) AS day_of_week, isodow(date) >= 6 AS is_weekend,
  CAST(floor((month(date) - 1) / 3) + 1 AS INTEGER) AS quarter
FROM (SELECT DISTINCT run_date AS date FROM S WHERE run_date IS NOT NULL)""")

# readings from the message fixture (T1 twin): AQI-unit sensors of non-empty messages
cte("RD", [], f"""
SELECT CAST(user_id % 5 AS VARCHAR) AS location_id, 'Station ' || CAST(user_id % 5 AS VARCHAR) AS location_name,
  {q(K.DIM_CITY)} AS locality, {q(K.DIM_COUNTRY)} AS country, 'VN' AS country_code,
  {d(21.0)} + (user_id % 5) * {d(0.01)} AS latitude, {d(105.8)} + (user_id % 5) * {d(0.01)} AS longitude,
  {q(K.PROVIDER)} AS provider, 'aqi' AS parameter, 'AQI' AS unit, value * 4 AS value,
  date_trunc('second', ts) AS measurement_time,
  CASE event_type WHEN 'click' THEN 'PM2.5' WHEN 'view' THEN 'PM10' WHEN 'purchase' THEN 'NO₂ mass'
    WHEN 'signup' THEN 'CO mass' WHEN 'error' THEN 'O₃ mass' ELSE 'SO₂ mass' END AS main_pollutant,
  ts AS created_at, event_id
FROM events WHERE event_id % 31 <> 0 AND event_id % 7 <> 0""")
# T4 twin
cte("AL", ["RD"], f"""
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY location_id, parameter, slot_date, slot_hour
                               ORDER BY created_at, event_id) AS _rn
  FROM (SELECT *, CAST(created_at + INTERVAL {K.LOCAL_OFFSET_HOURS} HOUR AS DATE) AS slot_date,
          CAST(hour(created_at + INTERVAL {K.LOCAL_OFFSET_HOURS} HOUR) AS INTEGER) AS slot_hour
        FROM RD)
  WHERE slot_hour IN ({", ".join(str(h) for h in K.ALERT_SLOT_HOURS)}) AND value IS NOT NULL
    AND value > {d(K.STREAM_AQI_THRESHOLD)})
WHERE _rn = 1""")
cte("RF", ["RD", "AL"], """
SELECT RD.*, AL.event_id IS NOT NULL AS alerted FROM RD LEFT JOIN AL USING (event_id)""")


def sql(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prepend the named stage CTEs (in dependency order) and any query-local `extra` CTEs."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    defs = [(n, CTES[n][1]) for n in order] + list(extra or [])
    if not defs:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({text.strip()})" for n, text in defs)
    return f"WITH {parts}\n{body.strip()}"


# bronze object keys (fixture L): layout by location_id % 3
cte("LK", ["R"], """
SELECT CASE CAST(location_id AS INTEGER) % 3
  WHEN 0 THEN 'lake/bronze/year=' || strftime(run_date, '%Y') || '/locationid=' || location_id
              || '/month=' || strftime(run_date, '%m') || '/day=' || strftime(run_date, '%d') || '/' || name
  WHEN 1 THEN 'lake/bronze/year=' || strftime(run_date, '%Y') || '/month=' || strftime(run_date, '%m')
              || '/day=' || strftime(run_date, '%d') || '/locationid=' || location_id || '/' || name
  ELSE 'lake/bronze/year=' || strftime(run_date, '%Y') || '/locationid=' || location_id
              || '/month=' || strftime(run_date, '%m') || '/' || name END AS key
FROM (SELECT DISTINCT location_id, run_date,
        'location-' || location_id || '-' || strftime(run_date, '%Y%m%d') || '.csv.gz' AS name
      FROM R WHERE location_id IS NOT NULL AND run_date IS NOT NULL)""")

_FILE_RE = r"^location-(\d+)-(\d{8})\.csv\.gz"


def _part(k: str, name: str) -> str:
    return f"nullif(regexp_extract({k}, '(?:^|/){name}=([^/]+)', 1), '')"


def _fn(k: str, i: int) -> str:
    return f"nullif(regexp_extract(regexp_extract({k}, '([^/]+)$', 1), '{_FILE_RE}', {i}), '')"


cte("LR", ["LK"], f"""
SELECT key, location_id, year, month, day, layout,
  make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), CAST(day AS INTEGER)) AS run_date
FROM (SELECT key,
  coalesce({_part('key', 'locationid')}, {_fn('key', 1)}) AS location_id,
  coalesce({_part('key', 'year')}, substr({_fn('key', 2)}, 1, 4)) AS year,
  coalesce({_part('key', 'month')}, substr({_fn('key', 2)}, 5, 2)) AS month,
  coalesce({_part('key', 'day')}, substr({_fn('key', 2)}, 7, 2)) AS day,
  CASE WHEN {_part('key', 'day')} IS NOT NULL AND strpos(key, 'locationid=') < strpos(key, 'month=') THEN 1
       WHEN {_part('key', 'day')} IS NOT NULL THEN 2 ELSE 3 END AS layout
FROM LK)""")
cte("INV", ["LR"], """
SELECT DISTINCT location_id, year, month, day FROM LR WHERE location_id IS NOT NULL AND day IS NOT NULL""")
