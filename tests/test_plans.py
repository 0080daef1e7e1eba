"""Plan discipline: no Cartesian products, no nested-loop joins, no Python UDFs in batch
queries, and filters/columns pushed into the Parquet scans."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]
BATCH = ["dedupe_first", "hourly_fact", "outliers_iqr", "quality_gate", "gold_aqi_summary", "aqi_columns",
         "aqi_breakpoint_join", "upsert_dim_location", "recipient_batches", "series_wide", "latest_readings",
         "quality_rules", "payload_flatten", "normalize_param", "alert_rollup"]


@pytest.mark.parametrize("name", BATCH)
def test_no_forbidden_operators(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan], name


def test_pushdown_into_scan(spark):
    """On a stored table the parameter and the time bound reach the scan; nothing is written."""
    import contextlib
    import io

    from pyspark.sql import functions as F

    from hazelake.operators import serve
    from hazelake.plans.stages import Stages
    from hazelake.session import scratch_path
    path = scratch_path(spark, "serving")
    Stages(spark, SF_SMALL).V().write.parquet(path)
    stored = spark.read.parquet(path)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        serve.series(stored, "pm25", "datetime", now=F.lit("2025-07-10 00:00:00").cast(stored.schema["datetime"].dataType)).explain("formatted")
    text = buf.getvalue()
    assert "EqualTo(parameter,pm25)" in text and "GreaterThan(datetime,2025-07-09" in text


def test_serving_writes_nothing(spark, monkeypatch):
    from hazelake import session
    from hazelake.operators import serve
    from hazelake.plans.stages import Stages

    def refuse(*_, **__):
        raise AssertionError("a serving query wrote a copy of its input")
    v = Stages(spark, SF_SMALL).V()
    monkeypatch.setattr(session, "materialize", refuse)
    assert serve.series(v, "pm25", "datetime").count() > 0
