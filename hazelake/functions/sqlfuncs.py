"""SQL-callable AQI functions as SQL-language temporary functions.

They are plain SQL expressions (no Python), so Catalyst inlines them and they stay inside
whole-stage codegen: `SELECT hz_aqi_pm25(value) FROM ...`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from hazelake import constants as K
from hazelake.functions.aqi import segments


def _dbl(x) -> str:
    return f"{float(x)!r}D"


def _str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def aqi_sql(v: str, table, above=None) -> str:
    parts = []
    for lo, hi, alo, ahi, slope in segments(table):
        if hi is None:
            parts.append(f"WHEN {v} >= {_dbl(lo)} THEN {ahi}")
        else:
            parts.append(f"WHEN {v} >= {_dbl(lo)} AND {v} <= {_dbl(hi)} THEN "
                         f"CAST({_dbl(slope)} * ({v} - {_dbl(lo)}) + {alo} AS INT)")
    if above is not None:
        parts.append(f"WHEN {v} > {_dbl(above)} THEN 500")
    return "CASE " + " ".join(parts) + " END"


def level_sql(v: str, table, above=None, labels=K.LEVELS) -> str:
    parts = []
    for i, (lo, hi, alo, ahi, slope) in enumerate(segments(table)):
        cond = f"{v} >= {_dbl(lo)}" if hi is None else f"{v} >= {_dbl(lo)} AND {v} <= {_dbl(hi)}"
        parts.append(f"WHEN {cond} THEN {_str(labels[i])}")
    if above is not None:
        parts.append(f"WHEN {v} > {_dbl(above)} THEN {_str(labels[-1])}")
    return "CASE " + " ".join(parts) + " END"


def category_sql(a: str) -> str:
    parts = " ".join(f"WHEN {a} BETWEEN {c[0]} AND {c[1]} THEN {_str(c[2])}" for c in K.AQI_CATEGORIES)
    return f"CASE {parts} WHEN {a} IS NOT NULL THEN {_str(K.AQI_CATEGORIES[-1][2])} END"


def ladder_sql(a: str, labels=K.LEVELS_VI) -> str:
    parts = " ".join(f"WHEN {a} <= {b} THEN {_str(l)}" for b, l in zip(K.LADDER_BOUNDS, labels))
    return f"CASE {parts} WHEN {a} IS NOT NULL THEN {_str(labels[-1])} END"


FUNCTIONS = {
    "hz_aqi_pm25": ("v DOUBLE", "INT", lambda: aqi_sql("v", K.PM25_PIPELINE, 500)),
    "hz_aqi_level_pm25": ("v DOUBLE", "STRING", lambda: level_sql("v", K.PM25_PIPELINE, 500)),
    "hz_aqi_pm10": ("v DOUBLE", "INT", lambda: f"CASE WHEN v >= 0 THEN {aqi_sql('v', K.PM10, 604)} END"),
    "hz_aqi_category": ("a INT", "STRING", lambda: category_sql("a")),
    "hz_aqi_level_ladder": ("a DOUBLE", "STRING", lambda: ladder_sql("a")),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    for name, (args, ret, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body()}")
    return list(FUNCTIONS)
