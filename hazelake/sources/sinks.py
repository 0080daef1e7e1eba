"""Layered writers (K1–K5). Idempotent re-runs via dynamic partition overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _partition_cols(df: DataFrame, date_col="run_date", loc_col="location_id", day=True) -> DataFrame:
    out = (df.withColumn("year", F.date_format(date_col, "yyyy"))
             .withColumn("month", F.date_format(date_col, "MM"))
             .withColumn("locationid", F.col(loc_col)))
    if day:
        out = out.withColumn("day", F.date_format(date_col, "dd"))
    return out


def write_partitioned(df: DataFrame, path: str, parts: list[str], fmt="parquet",
                      sort_within: list[str] | None = None) -> None:
    """Rebalance on the partition columns (AQE splits a hot partition over several tasks and
    merges small ones), optionally sort inside each task so Parquet min/max statistics let
    later filters skip row groups, then overwrite only the partitions present in `df`."""
    out = df.hint("rebalance", *parts)
    if sort_within:
        out = out.sortWithinPartitions(*parts, *[c for c in sort_within if c in df.columns])
    (out.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("compression", "snappy" if fmt == "parquet" else "gzip")
       .partitionBy(*parts).format(fmt).save(path))


def write_silver(silver: DataFrame, path: str) -> None:
    """K1: year/month/day/locationid."""
    write_partitioned(_partition_cols(silver), path, ["year", "month", "day", "locationid"],
                      sort_within=["parameter", "datetime"])


def write_hourly(hourly: DataFrame, path: str) -> None:
    """K2: fact_aqi_hourly/year/month/day/locationid."""
    write_partitioned(_partition_cols(hourly, "date"), path, ["year", "month", "day", "locationid"],
                      sort_within=["parameter", "hour"])


def write_daily(daily: DataFrame, path: str) -> None:
    """K3: fact_aqi_daily/year/month/locationid/day."""
    write_partitioned(_partition_cols(daily, "date"), path, ["year", "month", "locationid", "day"],
                      sort_within=["parameter"])


def write_dimension(dim: DataFrame, path: str) -> None:
    """K4: a merged dimension is rewritten whole (it is small and keyed): written beside the live table and swapped
    in by rename, so a failure at any point leaves the old or the new version complete."""
    path = path.rstrip("/")
    spark = dim.sparkSession
    recover_dimension(spark, path)
    dim.write.mode("overwrite").parquet(f"{path}__new")
    _swap(spark, path)


def _files(spark, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _rename(spark, a: str, b: str) -> None:
    (src, fs), (dst, _) = _files(spark, a), _files(spark, b)
    if not fs.rename(src, dst):
        raise OSError(f"cannot rename {a} to {b}")


def _remove(spark, path: str) -> None:
    p, fs = _files(spark, path)
    fs.delete(p, True)


def _swap(spark, path: str) -> None:
    """live -> old, new -> live, then the old version goes."""
    from hazelake.session import path_exists
    if path_exists(spark, path):
        _remove(spark, f"{path}__old")
        _rename(spark, path, f"{path}__old")
    _rename(spark, f"{path}__new", path)
    _remove(spark, f"{path}__old")


def recover_dimension(spark, path: str) -> None:
    """Finish or undo a swap that was cut off: without a live table, the new version is complete (it is written
    before the live one moves), else the old one is taken back."""
    from hazelake.session import path_exists
    path = path.rstrip("/")
    if path_exists(spark, path):
        return
    for version in (f"{path}__new", f"{path}__old"):
        if path_exists(spark, f"{version}/_SUCCESS"):
            _rename(spark, version, path)
            return


def run_manifest(report: DataFrame, hourly_path: str, daily_path: str) -> DataFrame:
    """K5: one manifest row per (location_id, run_date) with the quality report and outputs."""
    return report.select(
        F.date_format("run_date", "yyyy-MM-dd").alias("execution_date"), "location_id",
        F.struct("total_records", "null_count", "null_percent", "passed", "issues").alias("quality_report"),
        F.struct(F.lit(hourly_path).alias("hourly"), F.lit(daily_path).alias("daily")).alias("outputs"),
        F.when(F.col("passed"), F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"))


def write_manifest(manifest: DataFrame, path: str) -> None:
    """One folder per execution date and station: a run replaces its own entries only."""
    (manifest.withColumn("locationid", F.col("location_id")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("execution_date", "locationid").json(path))


FACT_PARTITIONS = {True: ["year", "month", "day", "locationid"], False: ["year", "month", "locationid", "day"]}
FACT_SORT = {True: ["parameter", "hour"], False: ["parameter"]}


def read_table(spark, path: str, partition_cols: list[str]) -> DataFrame:
    """A partitioned Parquet table with its partition columns as text ('07' stays '07')."""
    from pyspark.sql.types import StringType, StructField, StructType
    found = spark.read.option("basePath", path).parquet(path).schema
    kept = [StructField(f.name, StringType()) if f.name in partition_cols else f for f in found.fields]
    return spark.read.schema(StructType(kept)).option("basePath", path).parquet(path)


def _touched_partitions(target: DataFrame, updates: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Rows of `target` in the partitions `updates` touches (NULL partitions included). The
    semi-join is on partition columns only, so Spark prunes the scan at run time."""
    from functools import reduce
    touched = updates.select(*[F.col(c).alias(f"_t_{c}") for c in partition_cols]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in partition_cols])
    return target.join(touched, same, "left_semi")


def merge_partitioned(spark, path: str, updates: DataFrame, keys: list[str], update_cols: list[str],
                      partition_cols: list[str], scratch: str, sort_within: list[str] | None = None) -> None:
    """K9 on a partitioned table: read only the partitions the updates touch, merge by key, stage
    the result under `scratch`, and overwrite just those partitions in the table's own sort
    order. Untouched partitions are never rewritten, so the cost follows the size of the update."""
    from hazelake.operators.upsert import upsert
    from hazelake.session import reusable
    updates = reusable(updates, "merge-updates")   # read for the touched partitions and the merge
    current = _touched_partitions(read_table(spark, path, partition_cols), updates, partition_cols)
    merged = upsert(current.select(*updates.columns), updates, keys, update_cols)
    merged.write.mode("overwrite").parquet(scratch)            # cut the read/write cycle on `path`
    staged = spark.read.schema(merged.schema).parquet(scratch)
    write_partitioned(staged, path, partition_cols, sort_within=sort_within)


def merge_fact(spark, path: str, updates: DataFrame, keys: list[str], update_cols: list[str], scratch: str,
               hourly: bool) -> None:
    """Merge fact rows into a table that `write_hourly` or `write_daily` wrote."""
    merge_partitioned(spark, path, _partition_cols(updates, "date"), keys, update_cols, FACT_PARTITIONS[hourly], scratch,
                      sort_within=FACT_SORT[hourly])


def merge_dimension(spark, path: str, dim: DataFrame, keys: list[str]) -> None:
    """K4 over runs: new keys are added, known keys take the run's values."""
    from hazelake.operators.upsert import upsert
    from hazelake.session import materialize, path_exists
    recover_dimension(spark, path)
    if path_exists(spark, path):
        dim = materialize(upsert(spark.read.parquet(path).select(*dim.columns), dim, keys, [c for c in dim.columns if c not in keys]), "dimension")
    write_dimension(dim, path)
