"""T4 as a stream: at most one alert per (station, parameter, local date, slot).

Every micro-batch finds its first candidate of each slot with an aggregate, drops the slots that an
earlier batch has alerted (an anti join with the slot table, pruned to the batch's slot dates), and stores the
new slots and all readings under its batch id. A batch that is run again reads the slots of earlier batches
only and overwrites its own folders, so the outcome is the same; late and out-of-order batches never
raise a second alert. No rows of a station are gathered in one place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from hazelake import constants as K
from hazelake.operators.alerts import SLOT_KEYS, arrival_order, candidates, first_in_slot, mark, with_slot
from hazelake.session import path_exists

SLOT_TABLE = StructType([StructField("location_id", StringType()), StructField("parameter", StringType()),
                         StructField("slot_hour", IntegerType()), StructField("slot_date", DateType()),
                         StructField("batch_id", LongType())])


def with_slot_columns(readings: DataFrame) -> DataFrame:
    """`slot_date` and `slot_hour` of readings that arrive in a slot hour, NULL for the rest."""
    return with_slot(readings).withColumn("slot_date", F.when(F.col("slot_hour").isNotNull(), F.col("slot_date")))


def alert_once_per_slot(readings: DataFrame, threshold=K.STREAM_AQI_THRESHOLD) -> DataFrame:
    """Candidate readings of a bounded frame (above the threshold inside a slot hour) with their `alerted` flag."""
    c = candidates(readings, threshold).drop("slot_date", "slot_hour")
    return with_slot_columns(mark(c, first_in_slot(readings, threshold, order=arrival_order(readings))))


def flag_batch(batch: DataFrame, batch_id: int, store: str, threshold=K.STREAM_AQI_THRESHOLD) -> DataFrame:
    """K8 rows of one micro-batch; writes the slots it alerts to the slot table at `store`."""
    spark = batch.sparkSession
    firsts = first_in_slot(batch, threshold, order=arrival_order(batch))
    low, high = firsts.agg(F.min("slot_date"), F.max("slot_date")).first()
    if low is not None and path_exists(spark, store):
        earlier = (spark.read.schema(SLOT_TABLE).option("basePath", store).parquet(store)
                   .where(F.col("slot_date").between(F.lit(low), F.lit(high)) & (F.col("batch_id") < batch_id)))
        firsts = firsts.join(earlier.select(*SLOT_KEYS), SLOT_KEYS, "left_anti")
    if low is not None:
        (firsts.select("location_id", "parameter", "slot_hour", "slot_date", F.lit(batch_id).cast("long").alias("batch_id"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot_date", "batch_id").parquet(store))
    return with_slot_columns(mark(batch, firsts))


def store_batch(batch: DataFrame, batch_id: int, out: str, threshold=K.STREAM_AQI_THRESHOLD,
                handler: Callable[[DataFrame, int], None] | None = None) -> None:
    """Flag one micro-batch of readings, file it under its batch id, and hand its alerts to `handler`."""
    path = f"{out.rstrip('/')}/batch_id={batch_id}"
    flag_batch(batch, batch_id, f"{out.rstrip('/')}_slots", threshold).write.mode("overwrite").parquet(path)
    if handler is not None:
        handler(batch.sparkSession.read.parquet(path).where(F.col("alerted")), batch_id)


def start_flagged(readings: DataFrame, out: str, checkpoint: str, trigger: str | None = None, threshold=K.STREAM_AQI_THRESHOLD,
                  handler: Callable[[DataFrame, int], None] | None = None):
    """Run `store_batch` over a stream of readings: every reading is stored once, with its flag."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()   # read for the slots, for the readings and for the count of both
        try:
            store_batch(batch, batch_id, out, threshold, handler)
        finally:
            batch.unpersist()

    w = readings.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    return (w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)).start()


def run_flagged(readings: DataFrame, out: str, checkpoint: str, **options) -> DataFrame:
    """Drain what is available and return all stored readings."""
    q = start_flagged(readings, out, checkpoint, **options)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return readings.sparkSession.read.parquet(out).drop("batch_id")
