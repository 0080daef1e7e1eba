"""Bronze -> silver -> gold as one lazy plan per layer (all stations and days at once).

Pipeline order: dedupe (C1) -> units (C3) -> parse (C6) -> ranges (C8) -> IQR per
run (C11) -> PM2.5 AQI (Q1) -> quality gate (A5 + J7). Helper order (C14):
dedupe (C2) -> units (C4) -> ranges+nonzero (C9) -> parse (C7) -> IQR (C12) -> AQI (Q5).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.functions import aqi as Q
from hazelake.functions.text import ci_equals
from hazelake.functions.timeparse import parse_datetime, parse_datetime_helper
from hazelake.functions.units import normalize_units, normalize_units_lenient
from hazelake.operators import facts
from hazelake.operators.dedupe import auto_keys, dedupe
from hazelake.operators.outliers import remove_outliers_iqr, remove_outliers_iqr_param
from hazelake.operators.quality import quality_gate, quality_report, quality_report_full
from hazelake.operators.validate import validate_nonzero, validate_ranges
from hazelake.session import materialize

RUN_KEYS = ["location_id", "run_date"]


def nan_to_null(df: DataFrame, cols=("value",)) -> DataFrame:
    """NaN -> NULL once at the scan, so every later test sees one kind of missing."""
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in cols if c in df.columns})


def add_pm25_aqi(df: DataFrame, parameter="parameter", value="value") -> DataFrame:
    """Q1 on rows whose lower-cased parameter is pm25; other rows get NULL."""
    is_pm25 = ci_equals(parameter, "pm25")
    return df.withColumns({"aqi": F.when(is_pm25, Q.aqi_pm25(value)),
                           "aqi_level": F.when(is_pm25, Q.aqi_pm25_level(value))})


def cleaned(bronze: DataFrame) -> DataFrame:
    """Pipeline steps up to and including AQI (before the gate)."""
    df = nan_to_null(bronze)
    df = dedupe(df, keep="first")
    df = normalize_units(df)
    df = parse_datetime(df)
    df = validate_ranges(df)
    df = remove_outliers_iqr(df, RUN_KEYS)
    return add_pm25_aqi(df)


def _deduplicated(df: DataFrame) -> DataFrame:
    return dedupe(nan_to_null(df), keep="first")


def _validated(df: DataFrame) -> DataFrame:
    return validate_ranges(parse_datetime(normalize_units(df)))


def _without_outliers(df: DataFrame) -> DataFrame:
    return add_pm25_aqi(remove_outliers_iqr(df, RUN_KEYS))


def _gated(df: DataFrame) -> DataFrame:
    return quality_gate(df, quality_report(df, RUN_KEYS), RUN_KEYS)


#: The pipeline's steps as (name, function, stored): the two steps whose rows the next one reads twice are stored.
STEPS = (("deduplicated", _deduplicated, False), ("validated", _validated, True), ("outliers_removed", _without_outliers, True),
         ("silver", _gated, False))


def silver(bronze: DataFrame, materialize_layers: bool = True) -> DataFrame:
    """Cleaned rows of the runs that pass the quality gate. The cleaned set feeds both the
    report and the gate, so it is materialised once in the shared checkpoint folder."""
    c = cleaned(bronze)
    if materialize_layers:
        c = materialize(c, "cleaned")
    return quality_gate(c, quality_report(c, RUN_KEYS), RUN_KEYS)


def bronze_to_silver_helper(bronze: DataFrame) -> DataFrame:
    """C14 (helper profile), grouped per run."""
    df = nan_to_null(bronze)
    df = dedupe(df, keys=auto_keys(df), keep="first")
    df = normalize_units_lenient(df)
    df = validate_nonzero(df)
    df = parse_datetime_helper(df)
    df = remove_outliers_iqr_param(df, RUN_KEYS)
    return Q.add_aqi_columns(df)


@dataclass
class Gold:
    hourly: DataFrame
    daily: DataFrame
    dim_location: DataFrame
    dim_parameter: DataFrame
    dim_time: DataFrame

    def summary(self) -> DataFrame:
        return facts.gold_aqi_summary(self.daily, self.dim_location, self.dim_time)


def gold(silver_df: DataFrame) -> Gold:
    return Gold(hourly=facts.hourly_fact(silver_df), daily=facts.daily_fact(silver_df),
                dim_location=facts.dim_location(silver_df),
                dim_parameter=facts.dim_parameter(silver_df),
                dim_time=facts.dim_time(silver_df))


__all__ = ["cleaned", "silver", "gold", "Gold", "bronze_to_silver_helper", "nan_to_null",
           "add_pm25_aqi", "quality_report_full"]
