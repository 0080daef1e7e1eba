"""Bronze CSV scans over mixed layouts (S1, S2 on real files, S8 gold scan).

Partition discovery fails when layouts disagree on the column order, so the scan takes the files of
the date range from the file catalogue, binds columns by each file's header, and takes
year/month/day/locationid from the file path (`_metadata.file_path`), falling back to the date in the file name.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hazelake import schemas
from hazelake.sources.filecatalog import REQUIRED, catalogue, header_names, literal_path
from hazelake.sources.listing import file_name, parse_file_name


def read_bronze(spark: SparkSession, base: str, schema: StructType = schemas.BRONZE, glob: str | None = "*.csv.gz",
                start: dt.date | None = None, end: dt.date | None = None, store: str | None = None,
                files: DataFrame | None = None) -> DataFrame:
    """Every CSV.gz under `base` whose path dates it from `start` to `end` (one task per file: gzip is
    not splittable). Files of other dates are listed, not opened. Columns are bound by the names in each
    file's header, so files may order them differently or hold more; a column that a file lacks is NULL, and a
    file whose header lacks a required one (or that has none) fails. `_ord` is the position of a row in its file's
    scan. `store` keeps the headers between runs; `files` is a catalogue made before."""
    if files is None:
        files = catalogue(spark, base, start, end, store, glob)
    by_header: dict[str | None, list[str]] = {}
    for r in files.select("header", "path").collect():   # the scan's own file list
        by_header.setdefault(r["header"], []).append(r["path"])
    if None in by_header:
        raise ValueError(f"no header with {', '.join(REQUIRED)} in {', '.join(sorted(by_header[None])[:5])}"
                         f" ({len(by_header[None])} files)")
    parts = [_scan(spark, sorted(by_header[line]), header_names(line), schema) for line in sorted(by_header)]
    if not parts:
        empty = StructType([*schema.fields, *(StructField(n, StringType()) for n in ("_file", "path_location_id"))])
        df = spark.createDataFrame([], empty).withColumn("_ord", F.lit(0).cast("long")).withColumn("run_date", F.lit(None).cast("date"))
        return df.select(*[f.name for f in schema.fields], "_file", "_ord", "run_date", "path_location_id")
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    return df


def _scan(spark: SparkSession, paths: list[str], names: list[str], schema: StructType) -> DataFrame:
    """The files of one header line."""
    cells = StructType([StructField(f"_c{i}", StringType()) for i in range(len(names))])
    df = (spark.read.schema(cells).option("header", False).option("mode", "PERMISSIVE").csv([literal_path(p) for p in paths])
          .withColumn("_file", F.col("_metadata.file_path")).withColumn("_ord", F.monotonically_increasing_id()))

    def cell(name):
        return F.col(f"_c{names.index(name)}") if name in names else F.lit(None).cast("string")

    def part(name):
        return F.nullif(F.regexp_extract(F.col("_file"), rf"/{name}=([^/]+)", 1), F.lit(""))
    loc_f, y_f, m_f, d_f = parse_file_name(file_name(F.col("_file")))
    year, month, day = (F.coalesce(part(n), f) for n, f in (("year", y_f), ("month", m_f), ("day", d_f)))
    # the header row itself names its columns in the columns' places
    df = df.where(~F.coalesce(F.lower(F.trim(F.regexp_replace(cell("datetime"), "^\ufeff", ""))) == "datetime", F.lit(False)))
    return df.select(*[cell(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields], "_file", "_ord",
                     F.make_date(year.cast("int"), month.cast("int"), day.cast("int")).alias("run_date"),
                     F.coalesce(part("locationid"), loc_f).alias("path_location_id"))


def with_partition_strings(schema: StructType, parts: list[str]) -> StructType:
    """Schema for reading a partitioned table with its partition columns kept as text."""
    return StructType(list(schema.fields) + [StructField(p, StringType()) for p in parts])


def read_gold(spark: SparkSession, path: str, schema: StructType, parts: list[str],
              skip_unreadable: bool = False) -> DataFrame:
    """Partitioned Parquet with `location_id` taken from `locationid=` in the path. Unreadable
    files fail the scan unless the caller asks to skip them (the result is then incomplete)."""
    df = (spark.read.schema(with_partition_strings(schema, parts))
               .option("ignoreCorruptFiles", skip_unreadable).option("basePath", path).parquet(path))
    return df.withColumn("location_id", F.col("locationid"))
