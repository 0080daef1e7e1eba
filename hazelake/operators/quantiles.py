"""Exact per-group quantiles that never route one large group through one task.

Semantics: linear interpolation between closest ranks (pandas `quantile`, DuckDB
`quantile_cont`, Spark `percentile`): pos = p * (n - 1), value = lo + (hi - lo) * frac.

Groups of at most `SMALL` rows are one aggregate: their values are collected and sorted, which the row
count bounds. Which groups are larger (hot) is found by a count that Spark combines before the shuffle; mostly
there are none, and nothing is stored. Hot groups take two narrow passes:
 1. a mergeable quantile sketch per group (`percentile_approx`, combined map-side) gives, for each wanted rank, two
    values that the rank's value lies between for certain (the sketch's rank error is bounded)
 2. rows below the lower value are counted, rows between the two are pre-aggregated and ranked; the ranking
    range-partitions the distinct (group, value) rows, so even these span many tasks, and takes chunk offsets from a table of
    one row per chunk (its broadcast is bounded by the chunk count).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazelake.session import materialize

SMALL = 1_000_000      # rows of a group that one task may hold (8 MB of doubles)
MANY_HOT = 10_000      # hot groups up to this many are broadcast; more are joined
ACCURACY = 10_000      # the sketch's ranks are off by at most rows / ACCURACY


def _chunks(df: DataFrame, chunks: int | None) -> int:
    if chunks:
        return int(chunks)
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def known(df: DataFrame, keys: list[str], value: str | None = None) -> DataFrame:
    """Rows without NULL keys (pandas groupby default), and without NULL values if one is named."""
    for c in [*keys, *([value] if value else [])]:
        df = df.where(F.col(c).isNotNull())
    return df


def hot_groups(df: DataFrame, keys: list[str], value: str, small: int | None = None) -> DataFrame | None:
    """Keys of the groups with more than `small` non-NULL values; None when there are none."""
    small = SMALL if small is None else small
    hot = known(df, keys, value).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > small).select(*keys)
    rows = hot.limit(MANY_HOT + 1).collect()
    if not rows:
        return None
    if len(rows) > MANY_HOT:
        return materialize(hot, "hot-groups")
    return F.broadcast(df.sparkSession.createDataFrame(rows, hot.schema))


def value_list(value: str) -> Column:
    """Aggregate: the group's non-NULL values in order."""
    return F.sort_array(F.collect_list(F.col(value)))


def interpolated(values: Column, p: float) -> Column:
    """Quantile p of an ordered array; NULL if it is empty."""
    x = F.lit(float(p)) * (F.size(values) - 1)
    lo = F.floor(x).cast("int")
    a = F.get(values, lo)
    b = F.get(values, F.least(lo + 1, F.size(values) - 1))
    return a + (b - a) * (x - lo)


def ranked_values(src: DataFrame, keys: list[str], value: str, n_chunks: int) -> DataFrame:
    """Distinct (keys, value) with copy counts `_c`, the range chunk `_chunk` they
    landed in, and the running copy count `_cum` inside that chunk (in (keys, value) order)."""
    vc = src.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    ranged = vc.repartitionByRange(n_chunks, *keys, value).withColumn("_chunk", F.spark_partition_id())
    w = (Window.partitionBy("_chunk").orderBy(*keys, value)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return ranged.withColumn("_cum", F.sum("_c").over(w))


def _hot_quantiles(rows: DataFrame, keys: list[str], value: str, probs: dict[str, float], chunks: int, accuracy: int, small: int) -> DataFrame:
    """keys, `_n` and one column per entry of `probs` for groups of more than `small` rows."""
    names = list(probs)
    slack = 1.0 / accuracy + 3.0 / (small + 1)   # the sketch's own error, and the neighbours that are interpolated
    near = [(max(p - slack, 0.0), min(p + slack, 1.0)) for p in probs.values()]
    sketch = F.percentile_approx(value, F.array(*[F.lit(x) for pair in near for x in pair]), F.lit(accuracy))
    bounds = materialize(rows.groupBy(*keys).agg(sketch.alias("_s"), F.count(F.lit(1)).alias("_n")), "quantile-bounds")
    inside = rows.join(bounds, keys)
    v = F.col(value)
    low = [F.get("_s", F.lit(2 * i)) for i in range(len(names))]
    high = [F.get("_s", F.lit(2 * i + 1)) for i in range(len(names))]
    below = inside.groupBy(*keys).agg(*[F.sum(F.when(v < lo, 1).otherwise(0)).alias(f"_b{i}") for i, lo in enumerate(low)])
    # a row that lies near several wanted ranks counts for each
    wanted = F.array_compact(F.array(*[F.when((v >= lo) & (v <= hi), F.lit(i)) for i, (lo, hi) in enumerate(zip(low, high, strict=True))]))
    part = inside.select(*keys, value, F.explode(wanted).alias("_i"))
    by = [*keys, "_i"]
    ranged = materialize(ranked_values(part, by, value, chunks), "quantile-ranks")   # a few rows in ACCURACY of the input
    offsets = ranged.groupBy("_chunk").agg(F.sum("_c").alias("_t")).select("_chunk", F.coalesce(
        F.sum("_t").over(Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    pos = (ranged.join(F.broadcast(offsets), "_chunk")
           .select(*by, value, "_c", (F.col("_off") + F.col("_cum") - F.col("_c")).alias("_p0")))
    first = pos.groupBy(*by).agg(F.min("_p0").alias("_g0"))
    counts = bounds.select(*keys, "_n").join(below, keys)
    p = reduce(lambda a, i: F.when(F.col("_i") == i, F.lit(float(probs[names[i]]))).otherwise(a), range(len(names)), F.lit(0.0))
    b = reduce(lambda a, i: F.when(F.col("_i") == i, F.col(f"_b{i}")).otherwise(a), range(len(names)), F.lit(0))
    x = p * (F.col("_n") - 1)
    lo = F.floor(x)
    targets = first.join(counts, keys).select(*by, "_n", (F.col("_g0") - b).alias("_shift"), lo.alias("_lo"),
                                              F.ceil(x).alias("_hi"), (x - lo).alias("_fr"))
    r0 = F.col("_p0") - F.col("_shift")
    r1 = r0 + F.col("_c") - 1
    at_lo, at_hi = (r0 <= F.col("_lo")) & (F.col("_lo") <= r1), (r0 <= F.col("_hi")) & (F.col("_hi") <= r1)
    picked = (pos.join(targets, by).where(at_lo | at_hi).groupBy(*by)
              .agg(F.max("_n").alias("_n"), F.max(F.when(at_lo, v)).alias("_a"), F.max(F.when(at_hi, v)).alias("_b"), F.max("_fr").alias("_fr")))
    found = picked.withColumn("_q", F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_fr"))
    return found.groupBy(*keys).agg(F.max("_n").alias("_n"), *[F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)])


def group_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                    chunks: int | None = None, with_count: bool = True, small: int | None = None,
                    accuracy: int = ACCURACY) -> DataFrame:
    """keys + `_n` (non-NULL values) + one column per entry of `probs`. Groups with NULL keys
    are dropped. The input is read once to find hot groups and once for the rest."""
    whole = not keys
    if whole:
        df, keys = df.withColumn("_all", F.lit(0)), ["_all"]
    keys = list(keys)
    src = known(df.select(*keys, value), keys, value)
    hot = hot_groups(src, keys, value, small)
    rest = src if hot is None else src.join(hot, keys, "left_anti")
    out = (rest.groupBy(*keys).agg(value_list(value).alias("_v"))
           .select(*keys, F.size("_v").cast("long").alias("_n"), *[interpolated(F.col("_v"), p).alias(n) for n, p in probs.items()]))
    if hot is not None:
        out = out.unionByName(_hot_quantiles(src.join(hot, keys, "left_semi"), keys, value, probs, _chunks(df, chunks), accuracy, SMALL if small is None else small))
    out = out.select(*([] if whole else keys), *(["_n"] if with_count else []), *probs)
    return out


def group_quantiles_builtin(df: DataFrame, keys: list[str], value: str,
                            probs: dict[str, float]) -> DataFrame:
    """Reference form with Spark's `percentile` (whole group per final task); used in tests."""
    src = df.where(F.col(value).isNotNull())
    for k in keys:
        src = src.where(F.col(k).isNotNull())
    aggs = [F.count(F.col(value)).alias("_n")] + [
        F.percentile(F.col(value), F.lit(float(p))).alias(n) for n, p in probs.items()]
    return src.groupBy(*keys).agg(*aggs)
