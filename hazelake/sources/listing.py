"""Object-key listings and bronze layouts.

A listing is a DataFrame of keys (what an object-store LIST or `_metadata.file_path`
returns). Three bronze layouts coexist, which Spark's partition discovery rejects, so
the layout is resolved per key with regular expressions instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE_RE = r"^location-(\d+)-(\d{8})\.csv\.gz"


def bronze_keys(readings: DataFrame, prefix="lake/bronze") -> DataFrame:
    """Fixture L: one key per distinct (location_id, run_date); layout by location_id % 3."""
    d = readings.select("location_id", "run_date").where(
        F.col("location_id").isNotNull() & F.col("run_date").isNotNull()).distinct()
    y, m, dd = (F.date_format("run_date", "yyyy"), F.date_format("run_date", "MM"),
                F.date_format("run_date", "dd"))
    loc = F.col("location_id")
    name = F.concat(F.lit("location-"), loc, F.lit("-"), F.date_format("run_date", "yyyyMMdd"), F.lit(".csv.gz"))
    layout = loc.cast("int") % 3
    key = (F.when(layout == 0, F.concat_ws("/", F.lit(prefix), F.concat(F.lit("year="), y),
                                           F.concat(F.lit("locationid="), loc), F.concat(F.lit("month="), m),
                                           F.concat(F.lit("day="), dd), name))
           .when(layout == 1, F.concat_ws("/", F.lit(prefix), F.concat(F.lit("year="), y),
                                          F.concat(F.lit("month="), m), F.concat(F.lit("day="), dd),
                                          F.concat(F.lit("locationid="), loc), name))
           .otherwise(F.concat_ws("/", F.lit(prefix), F.concat(F.lit("year="), y),
                                  F.concat(F.lit("locationid="), loc), F.concat(F.lit("month="), m), name)))
    return d.select(key.alias("key"))


def file_name(key: Column) -> Column:
    return F.regexp_extract(key, r"([^/]+)$", 1)


def parse_file_name(name) -> list[Column]:
    """Location-<id>-<YYYYMMDD>.csv.gz -> id, year, month, day (NULL when not matching)."""
    n = F.col(name) if isinstance(name, str) else name
    def g(i):
        return F.nullif(F.regexp_extract(n, FILE_RE, i), F.lit(""))
    d = g(2)
    return [g(1).alias("location_id"), F.substring(d, 1, 4).alias("year"),
            F.substring(d, 5, 2).alias("month"), F.substring(d, 7, 2).alias("day")]


def _segment(segs, name: str):
    """Value of the first `name=value` path segment, NULL when there is none."""
    hit = F.get(F.filter(segs, lambda x: x.startswith(f"{name}=")), 0)
    return F.when(hit.isNotNull(), F.substring_index(hit, "=", -1))


def resolve_layout(keys: DataFrame, key="key", carry: list[str] | None = None) -> DataFrame:
    """year/month/day/locationid from `name=value` path segments (the path is split once),
    with the date in the file name as the fallback. `carry`: further columns to keep."""
    k = F.col(key)
    carry = carry or []
    parsed = keys.select(k.alias("key"), F.split(k, "/").alias("_segs"), file_name(k).alias("_name"), *carry)
    fn_loc, fn_y, fn_m, fn_d = parse_file_name("_name")
    segs = F.col("_segs")
    day_part = _segment(segs, "day")
    out = parsed.select(
        "key", *carry,
        F.coalesce(_segment(segs, "locationid"), fn_loc).alias("location_id"),
        F.coalesce(_segment(segs, "year"), fn_y).alias("year"),
        F.coalesce(_segment(segs, "month"), fn_m).alias("month"),
        F.coalesce(day_part, fn_d).alias("day"),
        F.when(day_part.isNotNull()
               & (F.locate("locationid=", F.col("key")) < F.locate("month=", F.col("key"))), F.lit(1))
         .when(day_part.isNotNull(), F.lit(2)).otherwise(F.lit(3)).alias("layout"))
    return out.withColumn("run_date", F.make_date(F.col("year").cast("int"), F.col("month").cast("int"),
                                                  F.col("day").cast("int")))


def partition_inventory(keys: DataFrame) -> DataFrame:
    """Distinct (location, year, month, day) across all layouts."""
    r = resolve_layout(keys)
    return (r.where(F.col("location_id").isNotNull() & F.col("day").isNotNull())
             .select("location_id", "year", "month", "day").dropDuplicates())


def archive_key_filter(keys: DataFrame, location_id: str, year: str, month: str) -> DataFrame:
    """Keys of one station and month, accepting zero-padded and plain month spellings."""
    k = F.col("key")
    m_int = str(int(month))
    month_ok = (k.contains(f"month={int(month):02d}/") | k.contains(f"month={m_int}/"))
    return keys.where(k.contains(f"locationid={location_id}/") & k.contains(f"year={year}/") & month_ok)


def incremental(source: DataFrame, target: DataFrame, key="key") -> DataFrame:
    """Keys not yet present in the target (left anti join)."""
    return source.join(target.select(key), key, "left_anti")


def compare(source: DataFrame, target: DataFrame, key="key", size="size") -> DataFrame:
    """Every key of two listings with what a copy has to do: new, changed (another size), same, or gone (only in
    the target). One full outer join."""
    s = source.select(F.col(key).alias("key"), F.col(size).alias("_s"), F.lit(True).alias("_in"))
    t = target.select(F.col(key).alias("key"), F.col(size).alias("_t"), F.lit(True).alias("_out"))
    status = (F.when(F.col("_out").isNull(), "new").when(F.col("_in").isNull(), "gone")
              .when(F.col("_s").eqNullSafe(F.col("_t")), "same").otherwise("changed"))
    return s.join(t, "key", "full_outer").select("key", F.col("_s").alias("size"), status.alias("status"))


def outcome_counts(compared: DataFrame) -> DataFrame:
    """Keys and bytes for each status."""
    return compared.groupBy("status").agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("bytes"))


def station_days(days: DataFrame, keys: DataFrame, location_id: str) -> DataFrame:
    """Days that hold data for one station (left semi join)."""
    inv = partition_inventory(keys).where(F.col("location_id") == location_id)
    inv = inv.select(F.make_date(F.col("year").cast("int"), F.col("month").cast("int"),
                                 F.col("day").cast("int")).alias("run_date"))
    return days.join(inv, "run_date", "left_semi")


def has_data(df: DataFrame, location_id: str | None = None, run_date=None) -> bool:
    """S3: existence probe for a station-day (stops at the first matching row)."""
    f = df
    if location_id is not None:
        f = f.where(F.col("location_id") == location_id)
    if run_date is not None:
        f = f.where(F.col("run_date") == F.lit(run_date))
    return not f.isEmpty()
