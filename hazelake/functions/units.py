"""Unit normalisation and conversion factors (C3–C5) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazelake import constants as K
from hazelake.functions.aqi import any_of


def _lower(c: str) -> Column:
    return F.lower(F.col(c))


def pipeline_rule_conditions(parameter="parameter", unit="unit") -> list[tuple[Column, float]]:
    """(condition, factor) per rule: parameter equal (or '*') and unit token contained."""
    p, u = _lower(parameter), _lower(unit)
    out = []
    for rp, ru, factor in K.PIPELINE_CONVERSIONS:
        cond = u.contains(ru) if rp == "*" else ((p == rp) & u.contains(ru))
        out.append((F.coalesce(cond, F.lit(False)), factor))
    return out


def normalize_units(df: DataFrame, parameter="parameter", value="value", unit="unit") -> DataFrame:
    """First matching rule converts the value and relabels the unit (even for NULL values)."""
    rules = pipeline_rule_conditions(parameter, unit)
    v = None
    for cond, factor in rules:
        v = F.when(cond, F.col(value) * F.lit(factor)) if v is None else v.when(cond, F.col(value) * F.lit(factor))
    v = v.otherwise(F.col(value))
    hit = any_of([c for c, _ in rules])
    # one projection: both new columns are computed from the input row
    return df.withColumns({value: v, unit: F.when(hit, F.lit(K.TARGET_UNIT)).otherwise(F.col(unit))})


def normalize_units_lenient(df: DataFrame, parameter="parameter", value="value", unit="unit") -> DataFrame:
    """C4: NULL values are skipped; any ppm x1000; ppb only for listed gases; mg/m³ x1000."""
    p, u, val = _lower(parameter), _lower(unit), F.col(value)
    has = val.isNotNull()
    ppm = has & F.coalesce(u.contains("ppm"), F.lit(False))
    ppb = has & ~ppm & F.coalesce(u.contains("ppb"), F.lit(False))
    mg = has & ~ppm & ~ppb & F.coalesce(u.contains("mg/m³"), F.lit(False))
    factor = F.when(ppm, F.lit(float(K.HELPER_PPM_FACTOR)))
    ppb_hit = F.lit(False)
    for gas, f in K.HELPER_PPB_FACTORS:
        factor = factor.when(ppb & (p == gas), F.lit(f))
        ppb_hit = ppb_hit | (ppb & F.coalesce(p == gas, F.lit(False)))
    factor = factor.when(mg, F.lit(float(K.HELPER_MG_FACTOR)))
    converted = ppm | ppb_hit | mg
    return df.withColumns({value: F.when(converted, val * factor).otherwise(val),
                           unit: F.when(converted, F.lit(K.TARGET_UNIT)).otherwise(F.col(unit))})


def _factor_map() -> Column:
    kv = []
    for rp, ru, f in K.RULE_CONVERSIONS:
        kv += [F.lit(f"{rp}|{ru}"), F.lit(float(f))]
    return F.create_map(*kv)


def conversion_factor(parameter, unit) -> Column:
    """Exact (parameter, unit) then ('*', unit) else 1.0 — map literal, no join."""
    p = F.lower(F.col(parameter) if isinstance(parameter, str) else parameter)
    u = F.lower(F.col(unit) if isinstance(unit, str) else unit)
    m = _factor_map()
    return F.coalesce(F.element_at(m, F.concat_ws("|", p, u)),
                      F.element_at(m, F.concat_ws("|", F.lit("*"), u)),
                      F.lit(1.0))
