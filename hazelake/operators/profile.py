"""Profiling and coverage queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from hazelake.session import materialize


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A10: COUNT(*) of each table as (table_name, n)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def station_coverage(fact: DataFrame) -> DataFrame:
    """Per station rows, first and last date, distinct parameters."""
    return fact.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("total_records"), F.min("date").alias("first_date"),
        F.max("date").alias("last_date"), F.count_distinct("parameter").alias("num_parameters"))


def raw_coverage(readings: DataFrame) -> DataFrame:
    """Per (id, name): readings, first/last created and measured."""
    return readings.groupBy("location_id", "location_name").agg(
        F.count(F.lit(1)).alias("count"),
        F.min("created_at").alias("first_record"), F.max("created_at").alias("last_record"),
        F.min("measurement_time").alias("first_measurement"),
        F.max("measurement_time").alias("last_measurement"))


def gold_station_coverage(fact: DataFrame, pattern: str) -> DataFrame:
    """One station by LIKE on its text id: count, first and last date."""
    f = fact.where(F.col("location_id").cast("string").like(pattern))
    return f.agg(F.count(F.lit(1)).alias("count"), F.min("date").alias("first_date"),
                 F.max("date").alias("last_date"))


def inventory_counts(inventory: DataFrame) -> DataFrame:
    """Days per station and per station-month (month NULL = station total)."""
    per_month = inventory.groupBy("location_id", "year", "month").agg(F.count(F.lit(1)).alias("days"))
    per_loc = inventory.groupBy("location_id").agg(F.count(F.lit(1)).alias("days")) \
        .select("location_id", F.lit(None).cast("string").alias("year"),
                F.lit(None).cast("string").alias("month"), "days")
    return per_month.unionByName(per_loc)


def object_coverage(resolved: DataFrame, table: str, samples: int = 3) -> DataFrame:
    """Files per station with the first few keys as a sample. The sample is a top-k per
    station (row_number <= k is planned as a partial WindowGroupLimit before the shuffle)."""
    counts = resolved.groupBy("location_id").agg(F.count(F.lit(1)).alias("files"))
    w = Window.partitionBy("location_id").orderBy("key")
    top = (resolved.select("location_id", "key").withColumn("_r", F.row_number().over(w))
                   .where(F.col("_r") <= samples)
                   .groupBy("location_id").agg(F.array_sort(F.collect_list("key")).alias("_s")))
    return (counts.join(top, "location_id")
                  .select(F.lit(table).alias("table_name"), "location_id", "files",
                          F.array_join("_s", ",").alias("sample_keys")))


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """(key, location_id, size, changed) of a stored table's data files, one row a file; their content is not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return found.select(F.col("path").alias("key"), F.regexp_extract("path", "/locationid=([^/]+)/", 1).alias("location_id"),
                        F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def gold_object_coverage(spark: SparkSession, tables: dict[str, str], samples: int = 3) -> DataFrame:
    """A18 of gold tables (name -> path): per table and station the files, their partitions and bytes, the newest
    change, and the first few keys as a sample."""
    out = None
    for name, path in tables.items():
        files = stored_files(spark, path)
        totals = files.groupBy("location_id").agg(
            F.count_distinct(F.regexp_extract("key", "^(.*)/", 1)).alias("partitions"), F.sum("size").alias("bytes"), F.max("changed").alias("newest"))
        part = object_coverage(files, name, samples).join(totals, "location_id")
        out = part if out is None else out.unionByName(part)
    return out


def step_report(source: DataFrame, steps) -> DataFrame:
    """Row count after the source and after each step, counted while the steps run. `steps` are (name, function,
    stored): a stored step's rows are written once, as the next step reads them more than once, and every step
    runs once. A step that is not stored must read its input once."""
    spark = source.sparkSession
    seen = [("bronze", Observation())]
    df = source.observe(seen[0][1], F.count(F.lit(1)).alias("rows"))
    pending = True
    for name, step, stored in steps:
        seen.append((name, Observation()))
        df = step(df).observe(seen[-1][1], F.count(F.lit(1)).alias("rows"))
        pending = not stored
        if stored:
            df = materialize(df, f"step-{name}")
    if pending:
        df.write.format("noop").mode("overwrite").save()
    rows = [(i, name, o.get["rows"]) for i, (name, o) in enumerate(seen)]
    return spark.createDataFrame(rows, "step_no int, step string, rows long")


def gold_outcome(hourly: DataFrame, daily: DataFrame, dim_loc: DataFrame, expected: int = 2) -> DataFrame:
    """Stations present in each gold table and the 'fewer than expected' warning."""
    def n(df, name):
        return df.agg(F.count_distinct("location_id").alias("locations")).select(
            F.lit(name).alias("table_name"), "locations")
    out = n(hourly, "hourly").unionByName(n(daily, "daily")).unionByName(n(dim_loc, "dim_location"))
    return out.withColumn("warning", F.col("locations") < expected)
