"""Catalogue of bronze files (S1, S2): what lies under a folder, without reading the data.

A listing gives path, size and modification time; the path gives station, date and layout. Only files
that are new or changed since the last run, and of the dates asked for, are opened, and of those only
the first bytes, for the header that binds their columns. The entries are kept in a table, so a scan of
a date range opens exactly the files of that range.
"""

from __future__ import annotations

import datetime as dt
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazelake.session import materialize, path_exists, ship_package
from hazelake.sources.listing import resolve_layout

REQUIRED = ("datetime", "parameter", "value")
HEAD_BYTES = 64 << 10   # the header is looked for in so many first bytes of a file
ENTRY = ["path", "size", "modified"]


def list_files(spark: SparkSession, base: str, glob: str | None = "*.csv.gz") -> DataFrame:
    """path, size, modified of every file under `base` (the contents are not read), with station, run date
    and layout from the path."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(base).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    out = resolve_layout(files, "path", carry=["size", "modified"])
    return out.select(F.col("key").alias("path"), "size", "modified", "location_id", "run_date", "layout")


def in_range(files: DataFrame, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """Files whose path gives a date of the range (all files without one)."""
    if start is not None:
        files = files.where(F.col("run_date") >= F.lit(start))
    if end is not None:
        files = files.where(F.col("run_date") <= F.lit(end))
    return files


def literal_path(path: str) -> str:
    """A path for a reader that would take some characters as a pattern."""
    return "".join(f"\\{c}" if c in "\\{}[]*?" else c for c in path)


def header_names(line: str) -> list[str]:
    return [c.strip().strip('"').strip().lower() for c in line.split(",")]


def find_header(head: bytes) -> str | None:
    """The first line that names all required columns, from the first bytes of a file (gzip or plain)."""
    if head[:2] == b"\x1f\x8b":
        try:
            head = zlib.decompressobj(31).decompress(head, 4 * HEAD_BYTES)
        except zlib.error:
            return None
    lines = head.decode("utf-8", "replace").removeprefix("\ufeff").splitlines()
    return next((line for line in lines if set(REQUIRED) <= set(header_names(line))), None)


def _headers(batches):
    for batch in batches:
        found = [find_header(x.as_py() or b"") for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["path", "header"])


def read_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, header of each file; NULL where its first bytes hold no header. Only those bytes leave the scan,
    and nothing behind them is decompressed."""
    ship_package(spark)
    heads = (spark.read.format("binaryFile").load([literal_path(p) for p in paths])
             .select("path", F.substring("content", 1, HEAD_BYTES).alias("head")))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "64")   # of HEAD_BYTES each
    try:
        return materialize(heads.mapInArrow(_headers, "path string, header string"), "headers")
    finally:
        spark.conf.set(key, before)


def catalogue(spark: SparkSession, base: str, start: dt.date | None = None, end: dt.date | None = None,
              store: str | None = None, glob: str | None = "*.csv.gz") -> DataFrame:
    """path, size, modified, location_id, run_date, layout, header of the files in the range. With a `store`
    the headers of unchanged files come from there, and those read now are added to it."""
    listed = materialize(in_range(list_files(spark, base, glob), start, end), "listing")
    known = spark.read.parquet(store) if store and path_exists(spark, store) else None
    fresh = listed if known is None else listed.join(known, ENTRY, "left_anti")
    paths = [r[0] for r in fresh.select("path").collect()]   # the driver's file index holds the same list
    if paths:
        read = materialize(fresh.join(read_headers(spark, paths), "path", "left").select(*ENTRY, "header"), "new-headers")
        if store:
            read.write.mode("append").parquet(store)
        known = read if known is None else known.select(*read.columns).unionByName(read)
    if known is None:
        return listed.withColumn("header", F.lit(None).cast("string"))
    # a retried append may hold an entry twice
    entries = known.groupBy(*ENTRY).agg(F.max("header").alias("header"))
    return materialize(listed.join(entries, ENTRY, "left"), "catalogue")
