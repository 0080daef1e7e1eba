"""Consecutive global row numbers without a single-partition window.

Rows are range-partitioned on a total order, numbered inside each chunk, and shifted by
the sizes of the chunks before them (one row per chunk, so its broadcast is bounded by
the chunk count).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazelake.session import materialize


def global_index(df: DataFrame, order_cols: list[str], name: str = "idx",
                 chunks: int | None = None) -> DataFrame:
    """Adds `name` = 0-based position in `order_cols` order (the order must be total)."""
    n = chunks or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    # stored once: range bounds come from sampling, and both readers below must see the same chunks
    ranged = materialize(df.repartitionByRange(n, *order_cols).withColumn("_chunk", F.spark_partition_id()), "range-chunks")
    ranged = ranged.withColumn("_r", F.row_number().over(Window.partitionBy("_chunk").orderBy(*order_cols)))
    sizes = ranged.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_t"))
    offs = sizes.select("_chunk", F.coalesce(
        F.sum("_t").over(Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offs), "_chunk")
                  .withColumn(name, (F.col("_off") + F.col("_r") - 1).cast("long"))
                  .drop("_chunk", "_r", "_off"))


def batches(df: DataFrame, order_cols: list[str], size: int, name: str = "batch") -> DataFrame:
    """Split an ordered list into consecutive batches of `size`."""
    return global_index(df, order_cols, "idx").withColumn(name, F.floor(F.col("idx") / size).cast("long"))
