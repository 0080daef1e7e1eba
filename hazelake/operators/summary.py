"""A mergeable daily summary of a fact, kept between runs, that answers the coverage and count queries
without another scan of the facts.

One row per (location, parameter, date) with what merges: counts, least and greatest values. A run files the dates it
rebuilt, replacing what earlier runs filed for them, so two runs give the summary of one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazelake.sources.sinks import read_table, write_partitioned

SUMMARY_PARTITIONS = ["year", "month", "day"]


def daily_summary(fact: DataFrame) -> DataFrame:
    return fact.groupBy("location_id", "parameter", "date").agg(
        F.count(F.lit(1)).alias("records"), F.sum("value_count").alias("readings"),
        F.min("value_min").alias("value_min"), F.max("value_max").alias("value_max"))


def write_summary(summary: DataFrame, path: str) -> None:
    """`summary` holds whole dates: they replace those of earlier runs, other dates stay."""
    parts = [F.date_format("date", f).alias(c) for c, f in zip(SUMMARY_PARTITIONS, ("yyyy", "MM", "dd"), strict=True)]
    write_partitioned(summary.select("*", *parts), path, SUMMARY_PARTITIONS, sort_within=["location_id", "parameter"])


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, SUMMARY_PARTITIONS).drop(*SUMMARY_PARTITIONS)


def summary_coverage(summary: DataFrame) -> DataFrame:
    """A11 from the summary: per station rows, first and last date, distinct parameters."""
    return summary.groupBy("location_id").agg(
        F.sum("records").alias("total_records"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count_distinct("parameter").alias("num_parameters"), F.sum("readings").alias("readings"),
        F.min("value_min").alias("value_min"), F.max("value_max").alias("value_max"))
