"""Quality reports and the gate.

A report is one row per run (location_id, run_date), computed in one grouped pass;
the gate is a left-semi join of the rows with the passing runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake import constants as K
from hazelake.operators.validate import is_value_valid

RUN_KEYS = ["location_id", "run_date"]
LINEAGE = {"run_date", "_file", "_ord"}


def data_columns(df: DataFrame, keys=RUN_KEYS) -> list[str]:
    """Columns that count for NULL statistics: everything but lineage columns."""
    return [c for c in df.columns if c not in LINEAGE]


def _null_sum(cols):
    total = None
    for c in cols:
        x = F.col(c).isNull().cast("long")
        total = x if total is None else total + x
    return total


def quality_report(df: DataFrame, keys=RUN_KEYS, min_records=K.MIN_RECORDS,
                   max_null_percent=K.MAX_NULL_PERCENT) -> DataFrame:
    """A5: rows, NULL cells over rows x columns, pass = rows >= min and NULL % <= max."""
    cols = data_columns(df, keys)
    ncols = len(cols)
    rep = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_records"),
                                F.sum(_null_sum(cols)).alias("null_count"))
    raw = F.col("null_count") / (F.col("total_records") * F.lit(ncols)) * 100   # judged as it is, rounded for the report
    pct = F.round(raw, 2)
    too_few = F.col("total_records") < min_records
    too_null = raw > max_null_percent
    return rep.withColumns({
        "null_percent": pct,
        "passed": ~too_few & ~too_null,
        "issues": F.concat_ws("; ",
                              F.when(too_few, F.concat(F.lit("Too few records: "), F.col("total_records"),
                                                       F.lit(f" < {min_records}"))),
                              F.when(too_null, F.concat(F.lit("Too many nulls: "), pct,
                                                        F.lit(f"% > {max_null_percent}%"))))})


def quality_gate(df: DataFrame, report: DataFrame | None = None, keys=RUN_KEYS) -> DataFrame:
    """Only rows of passing runs continue."""
    report = report if report is not None else quality_report(df, keys)
    return df.join(report.where("passed").select(*keys), list(keys), "left_semi")


def quality_report_full(df: DataFrame, keys=RUN_KEYS, min_records=K.MIN_RECORDS,
                        max_null_percent=K.MAX_NULL_PERCENT,
                        max_duplicate_percent=K.MAX_DUPLICATE_PERCENT, extra_aggs=(), keep_raw=False) -> DataFrame:
    """+ full-row duplicates (count - distinct rows), per-column NULL counts, issue texts with figures."""
    cols = data_columns(df, keys)
    ncols = len(cols)
    per_col = [F.sum(F.col(c).isNull().cast("long")).alias(f"nulls_{c}") for c in cols]
    rep = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(F.struct(*cols)).alias("_distinct"),
        *per_col, *extra_aggs)
    null_count = None
    for c in cols:
        null_count = F.col(f"nulls_{c}") if null_count is None else null_count + F.col(f"nulls_{c}")
    rep = (rep.withColumn("null_count", null_count)
              .withColumn("_null_raw", F.col("null_count") / (F.col("total_records") * ncols) * 100)
              .withColumn("null_percent", F.round("_null_raw", 2))
              .withColumn("duplicate_count", F.col("total_records") - F.col("_distinct"))
              .withColumn("_dup_raw", F.col("duplicate_count") / F.col("total_records") * 100)
              .withColumn("duplicate_percent", F.round("_dup_raw", 2))
              .drop("_distinct"))
    too_few = F.col("total_records") < min_records
    too_null = F.col("_null_raw") > max_null_percent
    too_dup = F.col("_dup_raw") > max_duplicate_percent
    rep = (rep.withColumn("passed", ~too_few & ~too_null & ~too_dup)
               .withColumn("issues", F.concat_ws("; ",
                   F.when(too_few, F.concat(F.lit("Too few records: "), F.col("total_records"), F.lit(f" < {min_records}"))),
                   F.when(too_null, F.concat(F.lit("Too many nulls: "), F.round("_null_raw", 1), F.lit(f"% > {max_null_percent}%"))),
                   F.when(too_dup, F.concat(F.lit("Too many duplicates: "), F.round("_dup_raw", 1), F.lit(f"% > {max_duplicate_percent}%"))))))
    return rep if keep_raw else rep.drop("_null_raw", "_dup_raw")


RULES = [
    # (name, level, check_type, threshold)  — the declared rule set
    ("min_records", "error", "count_check", float(K.MIN_RECORDS)),
    ("max_null_percent", "warning", "null_check", K.MAX_NULL_PERCENT),
    ("max_duplicate_percent", "warning", "duplicate_check", K.MAX_DUPLICATE_PERCENT),
    ("value_range", "error", "range_check", 0.0),
]


def quality_rules(df: DataFrame, keys=RUN_KEYS, parameter="parameter", value="value") -> DataFrame:
    """One row per (run, rule): observed value, threshold, passed."""
    # one grouped pass: the invalid-value count rides along with the full report
    j = quality_report_full(df, keys, extra_aggs=[
        F.sum((~is_value_valid(parameter, value)).cast("long")).alias("_invalid")], keep_raw=True)
    observed = {"count_check": F.col("total_records").cast("double"),
                "null_check": F.col("null_percent"),
                "duplicate_check": F.col("duplicate_percent"),
                "range_check": F.col("_invalid").cast("double")}
    entries = []
    for name, level, kind, thr in RULES:
        obs = observed[kind]
        judged = {"null_check": F.col("_null_raw"), "duplicate_check": F.col("_dup_raw")}.get(kind, obs)
        ok = judged >= F.lit(thr) if kind == "count_check" else judged <= F.lit(thr)
        entries.append(F.struct(F.lit(name).alias("rule"), F.lit(level).alias("level"),
                                F.lit(kind).alias("check_type"), obs.alias("observed"),
                                F.lit(float(thr)).alias("threshold"), ok.alias("passed")))
    return j.select(*keys, F.explode(F.array(*entries)).alias("r")).select(*keys, "r.*")
