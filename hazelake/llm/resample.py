"""Importance resampling towards a target distribution, by bit-sliced aggregation (operator 11).

Features are runs of 1 to ``n`` consecutive words, hashed into buckets. A bucket's gain is the scaled log
ratio of its smoothed shares in the target and in the corpus; a document's weight is the floored mean
of the gains over its features. The sum behind it is computed on bits: the document's bucket counts
become planes of one bit per bucket (plane k holds bit k of every count), the gains become planes in
two's complement, and the sum over all pairs of planes of popcount(count plane AND gain plane) times its
power of two, negative for the sign plane, is the exact integer sum.

The draw adds Gumbel noise from a keyed hash of the id to the weight and takes a share of the eligible
documents by rank, over a range-partitioned order.

Defined cases: null and empty texts have no words, no features and weight 0; documents with a null key
get a weight but no noise, so no score and no rank, and do not count as eligible; rows that share a key are each a
document; empty tables give empty results; an empty target leaves only the smoothing; further columns do not matter.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazelake.llm.arrays import ALNUM, LOWER, column, owners, prepare, slices, spans, text_bytes
from hazelake.operators.rowindex import global_index
from hazelake.session import materialize

BUCKETS = 10_000
SCALE = 1000
CHUNK = 1 << 20  # bytes of text worked on at once
SHORT = 48  # longer words are hashed one by one


def crc_table() -> np.ndarray:
    """CRC-32 of single bytes (reflected polynomial 0xEDB88320)."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


CRC = crc_table()


def crc_on(state: np.ndarray, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """CRC-32 states (before the last inversion) carried on over byte spans."""
    state = state.copy()
    long = np.flatnonzero(lens > SHORT)
    for i in long.tolist():
        state[i] = zlib.crc32(data[starts[i]:starts[i] + lens[i]], int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    at = np.flatnonzero(lens <= SHORT)
    at = at[np.argsort(lens[at], kind="stable")]
    left, step = np.searchsorted(lens[at], np.arange(SHORT + 1), side="right"), 0
    while left[step] < len(at):
        live = at[left[step]:]  # spans longer than ``step``
        state[live] = CRC[(state[live] ^ data[starts[live] + step]) & np.uint32(0xFF)] ^ (state[live] >> np.uint32(8))
        step += 1
    return state


def features(data: np.ndarray, offs: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document and bucket of every feature, and the documents' word counts. ``data`` is lower-cased."""
    starts, ends = spans(ALNUM[data], offs)
    lens, owner = ends - starts, owners(offs, starts)
    first = np.arange(len(starts))  # first word of each run, whose state covers the run so far
    state = crc_on(np.full(len(starts), 0xFFFFFFFF, np.uint32), data, starts, lens)
    docs, crcs = [owner], [state]
    for more in range(1, n):
        ok = np.flatnonzero(first + more < len(starts))
        ok = ok[owner[first[ok] + more] == owner[first[ok]]]
        first, state = first[ok], state[ok]
        blank = CRC[(state ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (state >> np.uint32(8))
        state = crc_on(blank, data, starts[first + more], lens[first + more])
        docs.append(owner[first])
        crcs.append(state)
    crc = np.concatenate(crcs) ^ np.uint32(0xFFFFFFFF)
    return np.concatenate(docs), (crc % np.uint32(buckets)).astype(np.int64), np.bincount(owner, minlength=len(offs) - 1)


def lowered(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offs = text_bytes(column(part, "text"))
    return LOWER[data], offs


def bucket_counts(texts: DataFrame, text: str = "text", n: int = 2, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, count) over all features of all rows; each task sends one row for a bucket it has met."""
    prepare(texts.sparkSession)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, "text", CHUNK):
            total += np.bincount(features(*lowered(part), n, buckets)[1], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["bucket", "count"])

    part = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket bigint, count bigint")
    return part.groupBy("bucket").agg(F.sum("count").alias("count"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket from the two tables of bucket counts (at most ``buckets`` rows each come to the driver)."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, into in ((corpus, s), (target, t)):
        for r in counts.collect():
            into[r["bucket"]] = r["count"]
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.array([math.floor(SCALE * math.log(x)) for x in ratio.tolist()], np.int64)


def row_bytes(buckets: int) -> int:
    return -(-buckets // 64) * 8


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Bit planes of the gains in two's complement, 64 buckets a number, and each plane's factor."""
    bits = max(int(np.abs(gain).max(initial=0)).bit_length(), 1)
    wide = np.zeros(row_bytes(len(gain)) * 8, np.int64)
    wide[:len(gain)] = gain
    planes = np.stack([np.packbits((wide >> j) & 1 == 1, bitorder="little") for j in range(bits + 1)])
    return planes.view(np.uint64), [1 << j for j in range(bits)] + [-(1 << bits)]


def count_planes(docs: np.ndarray, bucket: np.ndarray, buckets: int):
    """(documents with a bit in the plane, their planes) for every bit of the counts, from the lowest."""
    size = row_bytes(buckets)
    key, count = np.unique(docs * (size * 8) + bucket, return_counts=True)
    k = 0
    while len(key):
        at = key[(count >> k) & 1 == 1]
        rows, row = np.unique(at // (size * 8), return_inverse=True)
        plane = np.zeros(len(rows) * size, np.uint8)
        if len(at):
            place = row * size + (at % (size * 8)) // 8
            new = np.flatnonzero(np.diff(place, prepend=-1))
            plane[place[new]] = np.bitwise_or.reduceat((1 << (at & 7)).astype(np.uint8), new)
        yield rows, plane.view(np.uint64).reshape(len(rows), size // 8)
        k += 1
        more = count >> k > 0
        key, count = key[more], count[more]


def sums(docs: np.ndarray, bucket: np.ndarray, many: int, planes: np.ndarray, factors: list[int], buckets: int) -> np.ndarray:
    """Exact sum of the gains over each document's features."""
    out = np.zeros(many, np.int64)
    for k, (rows, plane) in enumerate(count_planes(docs, bucket, buckets)):
        for gain, factor in zip(planes, factors, strict=True):
            out[rows] += np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64) * (factor << k)
    return out


def importance_weights(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", n: int = 2) -> DataFrame:
    """(key, n_words, n_features, weight) of every document: the floored mean of the gains over its features."""
    prepare(docs.sparkSession)
    buckets = len(gain)
    shared = docs.sparkSession.sparkContext.broadcast(gain_planes(gain))  # bounded by the buckets
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        planes, factors = shared.value
        for part in slices(batches, "text", CHUNK):
            owner, bucket, words = features(*lowered(part), n, buckets)
            many = np.bincount(owner, minlength=part.num_rows)
            total = sums(owner, bucket, part.num_rows, planes, factors, buckets)
            yield pa.RecordBatch.from_arrays([column(part, "key"), *(pa.array(x, pa.int64()) for x in (words, many, total // np.maximum(many, 1)))],
                                             ["key", "n_words", "n_features", "weight"])

    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"key {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(key: Column, seed: str) -> Column:
    """Scaled Gumbel noise from a hash of the id; null for a null id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))


def draw(weights: DataFrame, percent: int = 25, least_words: int = 20, seed: str = "7") -> DataFrame:
    """Adds ``score`` and ``rank`` (1, 2, 3, ... by falling score, ties to the smaller key; null if not drawn).
    Drawn are floor(percent * N / 100) of the N documents with at least ``least_words`` words."""
    scored = materialize(weights.withColumn("score", (F.col("weight") + noise(F.col("key"), seed)).cast("long")), "resample-scores")
    may = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    take = scored.where(may).count() * percent // 100
    ranked = global_index(scored.where(may).withColumn("first", -F.col("score")), ["first", "key", "weight", "n_features", "n_words"], "rank").drop("first")
    rank = F.when(F.col("rank") < take, F.col("rank") + 1).cast("long")
    return ranked.withColumn("rank", rank).unionByName(scored.where(~may).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", n: int = 2,
             buckets: int = BUCKETS, percent: int = 25, least_words: int = 20, seed: str = "7") -> DataFrame:
    """(key, n_words, n_features, weight, score, rank) of every document."""
    gain = gains(bucket_counts(docs, text, n, buckets), bucket_counts(target, target_text, n, buckets), buckets)
    drawn = draw(importance_weights(docs, gain, key, text, n), percent, least_words, seed)
    return drawn.toDF(key, *drawn.columns[1:])


def digests(docs: DataFrame, target: DataFrame) -> DataFrame:
    """The query's columns."""
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


#: The same query for DuckDB. Buckets of distinct features come from a table-driven CRC-32 over their bytes.
ORACLE_SQL = """
WITH t AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
texts AS (SELECT true AS own, row_number() OVER () AS id, doc_id, text FROM documents
          UNION ALL SELECT false, row_number() OVER (), NULL, text FROM benchmark),
words AS (SELECT own, id, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM texts),
feats AS (SELECT own, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
counted AS (SELECT own, id, f, count(*) AS c FROM feats GROUP BY ALL),
bytes AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM counted)),
hashed AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
             lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, t),
placed AS (SELECT own, id, bucket, sum(c) AS c FROM counted JOIN hashed USING (f) GROUP BY ALL),
totals AS (SELECT coalesce(sum(c) FILTER (own), 0) AS s, coalesce(sum(c) FILTER (NOT own), 0) AS t FROM placed),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(sum(c) FILTER (NOT own), 0) + 1)::DOUBLE * (any_value(totals.t * 0 + totals.s) + 10000)::DOUBLE
             / ((coalesce(sum(c) FILTER (own), 0) + 1)::DOUBLE * (any_value(totals.t) + 10000)::DOUBLE)))::BIGINT AS g
         FROM placed, totals GROUP BY bucket),
weighed AS (SELECT id, sum(c)::BIGINT AS n, floor(sum(c * g)::DOUBLE / sum(c)::DOUBLE)::BIGINT AS weight FROM placed JOIN gain USING (bucket) WHERE own GROUP BY id),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) AS n_words,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
           FROM words LEFT JOIN weighed USING (id) WHERE own),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 AND score IS NOT NULL ORDER BY score DESC, doc_id, weight, n_features, n_words) AS r,
             count(*) FILTER (n_words >= 20 AND score IS NOT NULL) OVER () AS many FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND score IS NOT NULL AND r <= 25 * many // 100 THEN r END AS rank FROM ranked
"""
