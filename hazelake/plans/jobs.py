"""The daily batch as one Spark job over a date range and all stations.

    python -m hazelake.plans.jobs --bronze <dir> --out <dir> [--start 2025-07-01 --end 2025-07-31]

bronze CSV.gz (three layouts) -> silver (partitioned, sorted) -> gold facts and dimensions
-> one manifest row per (station, run date). Only files whose path (or name, where the path has
no date) lies in the date range are opened; headers of files seen by earlier runs come from the file catalogue.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from hazelake.operators.quality import quality_gate, quality_report
from hazelake.operators.summary import daily_summary, write_summary
from hazelake.plans import pipeline
from hazelake.session import apply_scale_conf, build_session, materialize
from hazelake.sources import bronze, sinks
from hazelake.sources.filecatalog import catalogue


def run_batch(spark: SparkSession, bronze_base: str, out_base: str,
              start: dt.date | None = None, end: dt.date | None = None) -> dict[str, str]:
    """One run over a date range (all dates without one), which adds to what earlier runs wrote.

    Fact rows belong to UTC dates, which runs of neighbouring local days share: every UTC date
    that this run touches is rebuilt from the stored silver rows of all runs (medians do not
    merge). Dimensions are merged by key, and the manifest gets one entry per run from the
    report before the gate, failed runs included."""
    out = out_base.rstrip("/")
    files = catalogue(spark, bronze_base, start, end, store=f"{out}/catalogue/bronze_files")
    apply_scale_conf(spark, files.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])
    raw = bronze.read_bronze(spark, bronze_base, files=files)
    raw = raw.withColumn("location_id", F.coalesce(F.col("location_id"), F.col("path_location_id"))).drop("path_location_id")
    cleaned = materialize(pipeline.cleaned(raw), "cleaned")
    report = materialize(quality_report(cleaned, pipeline.RUN_KEYS), "report")
    silver = materialize(quality_gate(cleaned, report, pipeline.RUN_KEYS), "silver")
    manifest = sinks.run_manifest(report, f"{out}/gold/fact_aqi_hourly", f"{out}/gold/fact_aqi_daily")
    sinks.write_manifest(manifest, f"{out}/gold/metadata")
    first, last = silver.agg(F.min("date"), F.max("date")).first()
    if first is None:   # no run passed the gate: nothing to add
        return {"silver": f"{out}/silver", "gold": f"{out}/gold"}
    sinks.write_silver(silver.drop("_file", "_ord"), f"{out}/silver")
    day = dt.timedelta(days=1)
    stored = sinks.read_table(spark, f"{out}/silver", sinks.FACT_PARTITIONS[True])
    run_day = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    # runs whose rows may fall on the touched UTC dates (offsets stay below a day)
    rows = stored.where(run_day.between(F.lit(first - day), F.lit(last + day)) & F.col("date").between(F.lit(first), F.lit(last)))
    g = pipeline.gold(materialize(rows.drop("year", "month", "day", "locationid"), "touched"))
    sinks.write_hourly(g.hourly, f"{out}/gold/fact_aqi_hourly")
    sinks.write_daily(g.daily, f"{out}/gold/fact_aqi_daily")
    fact_day = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    rebuilt = sinks.read_table(spark, f"{out}/gold/fact_aqi_hourly", sinks.FACT_PARTITIONS[True]).where(fact_day.between(F.lit(first), F.lit(last)))
    write_summary(daily_summary(rebuilt), f"{out}/gold/summary")
    new = pipeline.gold(silver)
    for name, dim, keys in (("dim_location", new.dim_location, ["location_id"]), ("dim_parameter", new.dim_parameter, ["parameter"]),
                            ("dim_time", new.dim_time, ["date"])):
        sinks.merge_dimension(spark, f"{out}/gold/{name}", dim, keys)
    return {"silver": f"{out}/silver", "gold": f"{out}/gold"}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--bronze", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--start", type=dt.date.fromisoformat)
    ap.add_argument("--end", type=dt.date.fromisoformat)
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    print(run_batch(spark, a.bronze, a.out, a.start, a.end))


if __name__ == "__main__":
    main()
