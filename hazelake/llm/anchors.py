"""Windows that repeat, found through winnowed anchors: the Spark part of operators 1 and 7.

Symbols are bytes (operator 1) or words (operator 7). Every window of ``window`` symbols selects
one anchor, the gram with the smallest hash in it; consecutive windows with one anchor form a
segment. Equal windows select equal anchors at equal offsets, so windows can only be equal within
segments of one anchor hash. Segments whose anchor is alone are dropped after one count. Of the
rest, equal segments are settled by their content hash (counts combine before the shuffle, so a
passage that a third of all documents share costs no hot task). Segments that share an anchor but
not all content, at the ends of shared passages, are compared window by window in tasks that
hold the anchor's segments. An anchor with more than ``HOT`` different segments is dealt out
over several tasks by content; their windows then meet by window hash, combined before that
shuffle too. No case is capped or dropped.

A row is named by its doc_id and a 64-bit hash of its text (``th``), so rows that share a doc_id, or
have none, may hold different texts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.llm.arrays import (
    column,
    lean,
    mix,
    owners,
    powers,
    prefix_hashes,
    prepare,
    ranges,
    slices,
    span_hashes,
    spans,
    text_bytes,
)
from hazelake.session import materialize

HOT = 8192  # about 3 MB of content and 100 MB of work arrays in one call
BLOCK_BYTES = 1 << 20


@dataclass
class Rows:
    """Segments of a block, ordered by group: content as symbols laid end to end."""
    symbols: np.ndarray  # values to hash
    raw: np.ndarray      # the symbols themselves, for comparing without hashes
    begin: np.ndarray    # of every row in symbols
    size: np.ndarray     # symbols of every row
    n: np.ndarray        # windows of every row
    anchor: np.ndarray   # place of the anchor in the row
    group: np.ndarray
    weight: np.ndarray   # operator 1: copies of the segment (2 stands for more); operator 7: its smallest doc_id


@dataclass
class Rule:
    window: int
    gram: int
    #: (data, offs) of a chunk of texts -> (symbols, raw symbols, offsets by document)
    symbols: Callable
    raw_type: np.dtype
    #: rows -> (row, window, class) of all windows, classes numbered from 0
    classes: Callable
    #: True: windows that occur twice anywhere; False: windows that occur in a smaller document
    anywhere: bool


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[:len(x) - (width - done)], x[width - done:]) if done < width else x


def segments(values: np.ndarray, offs: np.ndarray, window: int, gram: int):
    """(document, start, windows, anchor place, anchor hash, content hash) of all segments."""
    n = len(values)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    prefix = prefix_hashes(values)
    grams = mix((prefix[gram:] - prefix[:-gram]) * powers(n + 1)[1][:n - gram + 1])
    low = np.uint64((1 << 31) - 1)  # the same for every chunk, so that equal windows choose alike
    best = sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), window - gram + 1) & low
    size = np.diff(offs)
    long = size >= window
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, offs[:-1][long], 1)
    np.add.at(change, (offs[:-1] + size - window + 1)[long], -1)
    valid = np.cumsum(change)[:len(best)] > 0
    new = np.ones(len(best), bool)
    new[1:] = (best[1:] != best[:-1]) | (valid[1:] != valid[:-1])
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(best)))
    start, count = start[valid[start]], count[valid[start]]
    anchor = best[start].astype(np.int64)
    doc = owners(offs, start)
    content = mix(span_hashes(prefix, start, start + count - 1 + window) + count.astype(np.uint64))
    return doc, start - offs[doc], count, anchor - start, grams[anchor], content


def window_classes_by_hash(rows: Rows, window: int):
    """(row, window, place of the anchor after the window's start) of all windows of a block."""
    row = np.repeat(np.arange(len(rows.n)), rows.n)
    at = ranges(np.zeros(len(rows.n)), rows.n)
    return row, at, rows.anchor[row] - at


def _find(rule: Rule):
    def run(batches):
        for part in slices(batches, "text"):
            values, _, offs = rule.symbols(*text_bytes(column(part, "text")))
            doc, start, n, anchor, h, content = segments(values, offs, rule.window, rule.gram)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(content.view(np.int64)), column(part, "doc_id").take(pa.array(doc)), column(part, "th").take(pa.array(doc)),
                 pa.array(start * 65536 * 65536 + n * 65536 + anchor)], ["h", "content", "doc_id", "th", "place"])
    return run


def _unpack(place):
    return place >> 32, (place >> 16) & 0xFFFF, place & 0xFFFF


def _cut_out(rule: Rule):
    """Documents with the list of their open segments -> one row per segment with its content."""
    def run(batches):
        for part in slices(batches, "text"):
            _, raw, offs = rule.symbols(*text_bytes(column(part, "text")))
            lists = column(part, "open")
            flat = lists.flatten()
            per = np.diff(np.asarray(lists.offsets))
            doc = np.repeat(np.arange(part.num_rows), per)
            place = flat.field("place").to_numpy()
            start, n, _ = _unpack(place)
            size = n - 1 + rule.window
            body = raw[ranges(offs[doc] + start, size)].tobytes()
            ends = np.concatenate([[0], np.cumsum(size * raw.itemsize)]).tolist()
            yield pa.RecordBatch.from_arrays(
                [flat.field("h"), flat.field("salt"), column(part, "doc_id").take(pa.array(doc)), column(part, "th").take(pa.array(doc)), flat.field("place"), flat.field("weight"), flat.field("asks"),
                 flat.field("hot"), pa.array([body[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                ["h", "salt", "doc_id", "th", "place", "weight", "asks", "hot", "body"])
    return run


def _resolve(rule: Rule):
    """Rows ordered by (h, salt) -> ranges of repeated windows, and of hot anchors their windows."""
    names = ["doc_id", "th", "start", "stop", "h", "w", "weight", "asks"]

    def block(table: pa.Table):
        table = table.combine_chunks()
        col = {c: table.column(c).to_numpy() for c in ("h", "salt", "place", "weight", "asks", "hot")}
        start, n, anchor = _unpack(col["place"])
        data, offs = text_bytes(table.column("body").combine_chunks() if table.num_rows else pa.array([], pa.binary()))
        raw = data.view(rule.raw_type) if len(data) else np.zeros(0, rule.raw_type)
        offs = offs // np.dtype(rule.raw_type).itemsize
        group = np.cumsum(np.concatenate([[False], (col["h"][1:] != col["h"][:-1]) | (col["salt"][1:] != col["salt"][:-1])]))
        rows = Rows(symbol_values(raw), raw, offs[:-1], np.diff(offs), n, anchor, group, col["weight"])
        row, at, label = rule.classes(rows, rule.window)
        if rule.anywhere:
            total = np.bincount(label, rows.weight[row]) if len(label) else np.zeros(0)
            repeated = total[label] >= 2
            weight = np.minimum(total, 2)[label] if len(label) else label
        else:
            least = np.full(label.max() + 1 if len(label) else 0, np.iinfo(np.int64).max)
            np.minimum.at(least, label, rows.weight[row])
            repeated = rows.weight[row] > least[label]
            weight = least[label] if len(label) else label
        ids, texts = table.column("doc_id"), table.column("th")
        # consecutive repeated windows of a row become one range
        base = np.concatenate([[0], np.cumsum(n)])
        a, b = spans(repeated & col["asks"][row], base)
        r = row[a]
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(r)).combine_chunks(), texts.take(pa.array(r)).combine_chunks(), pa.array(start[r] + at[a]), pa.array(start[r] + at[b - 1] + rule.window),
             pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.bool_())], names)
        hot = np.flatnonzero(col["hot"][row])
        if len(hot):
            if rule.anywhere:
                # one row for each different window of a task: one that occurs twice here is settled, and only counts
                _, first = np.unique(label[hot], return_index=True)
                hot = hot[np.sort(first)]
            else:
                # every occurrence in the smallest document of a task asks for itself
                hot = hot[~repeated[hot]]
            r = row[hot]
            prefix = prefix_hashes(rows.symbols)
            s = rows.begin[r] + at[hot]
            w = mix(span_hashes(prefix, s, s + rule.window) + (rows.anchor[r] - at[hot]).astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(r)).combine_chunks(), texts.take(pa.array(r)).combine_chunks(), pa.array(start[r] + at[hot]), pa.array(start[r] + at[hot] + rule.window), pa.array(col["h"][r]),
                 pa.array(w.view(np.int64)), pa.array(weight[hot].astype(np.int64)), pa.array(col["asks"][r] & ~repeated[hot])], names)

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < BLOCK_BYTES:
                continue
            table = pa.Table.from_batches(held)
            h, salt = table.column("h").to_numpy(), table.column("salt").to_numpy()
            ends = np.flatnonzero((h[1:] != h[:-1]) | (salt[1:] != salt[:-1])) + 1
            if not len(ends):
                continue
            cut = int(ends[-1])
            bytes_ = np.cumsum(np.asarray(pc.binary_length(table.column("body")), np.int64))
            lo = 0
            for e in ends:  # whole groups, about BLOCK_BYTES at a time
                if e == cut or bytes_[e - 1] - (bytes_[lo - 1] if lo else 0) >= BLOCK_BYTES:
                    yield from block(table.slice(lo, int(e) - lo))
                    lo = int(e)
            held, size = table.slice(cut).to_batches(), table.slice(cut).nbytes
        if held:
            yield from block(pa.Table.from_batches(held))
    return run


def symbol_values(raw: np.ndarray) -> np.ndarray:
    """Values to hash: random odd numbers for bytes; word hashes stand for themselves."""
    from hazelake.llm.arrays import BYTE_VALUES
    return BYTE_VALUES[raw] if raw.dtype == np.uint8 else raw


def named_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, th) of all rows."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))


def with_ranges(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, text, th, ranges) of all rows; ranges is NULL where nothing repeats."""
    lists = repeated_ranges(docs, rule).toDF("__id", "__th", "ranges")
    return named_texts(docs).join(lists, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")), "left").drop("__id", "__th")


def repeated_ranges(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, th, ranges array<struct<start, stop>>) of the rows with repeated windows, in symbols. Rows without a
    doc_id take part where windows count that occur anywhere; they are not smaller than any other."""
    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = named_texts(docs).where("text is not null" if rule.anywhere else "doc_id is not null and text is not null")
    found = materialize(texts.mapInArrow(lean(_find(rule)), f"h bigint, content bigint, doc_id {kind}, th bigint, place bigint"), "segments")
    alone = found.groupBy("h").agg(F.count("*").alias("__c"), *([] if rule.anywhere else [F.min("doc_id").alias("__lo"), F.max("doc_id").alias("__hi")]))
    # written first: with a plain table on that side Spark can split a hot anchor's rows in the join
    several = materialize(alone.where("__c > 1" if rule.anywhere else "__lo < __hi").select("h"), "several")
    shared = materialize(found.join(several, "h", "left_semi"), "shared")
    by_content = shared.groupBy("h", "content").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "th", "place")).alias("first"))
    by_content = materialize(by_content, "contents")
    kinds = by_content.groupBy("h").agg(F.count("*").alias("kinds"))
    known = by_content.join(kinds, "h").select("h", "content", "copies", "first", "kinds")
    t = shared.join(known, ["h", "content"])
    if rule.anywhere:  # all copies of a segment repeat; of several copies one stands for them before other segments
        first = F.struct("doc_id", "th", "place").eqNullSafe(F.col("first"))
        whole, asks = F.col("copies") > 1, F.col("copies") == 1
        opens, weight = asks | first, F.least("copies", F.lit(2))
    else:              # copies in larger documents repeat; those of the smallest document may repeat smaller ones still
        whole, asks = F.col("doc_id") > F.col("first.doc_id"), F.lit(True)
        opens, weight = F.col("doc_id") == F.col("first.doc_id"), F.col("first.doc_id")
    salt = F.when(F.col("kinds") > HOT, F.pmod(F.xxhash64("content"), F.ceil(F.col("kinds") / HOT))).otherwise(F.lit(0).cast("long"))
    t = materialize(t.select("h", "doc_id", "th", "place", whole.alias("whole"), (opens & (F.col("kinds") > 1)).alias("opens"), asks.alias("asks"),
                             weight.cast("long").alias("weight"), salt.alias("salt"), (F.col("kinds") > HOT).alias("hot")).where("whole or opens"), "flagged")
    lists = t.where("opens").groupBy(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).agg(
        F.collect_list(F.struct("h", "salt", "place", "weight", "asks", "hot")).alias("open"))
    with_open = texts.join(lists, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th"))).drop("__id", "__th")
    pieces = with_open.mapInArrow(
        lean(_cut_out(rule)), f"h bigint, salt bigint, doc_id {kind}, th bigint, place bigint, weight bigint, asks boolean, hot boolean, body binary")
    resolved = materialize(pieces.repartition("h", "salt").sortWithinPartitions("h", "salt").mapInArrow(
        lean(_resolve(rule)), f"doc_id {kind}, th bigint, start bigint, stop bigint, h bigint, w bigint, weight bigint, asks boolean"), "resolved")
    windows = resolved.where("h is not null")
    met = windows.groupBy("h", "w").agg(F.sum("weight").alias("__sum"), F.min("weight").alias("__min"))
    hot = windows.where("asks").join(met, ["h", "w"]).where("__sum > 1" if rule.anywhere else "weight > __min")
    start = F.shiftright("place", 32)
    size = F.shiftright("place", 16).bitwiseAND(0xFFFF)
    every = (t.where("whole").select("doc_id", "th", start.alias("start"), (start + size - 1 + rule.window).alias("stop"))
             .unionByName(resolved.where("h is null").select("doc_id", "th", "start", "stop")).unionByName(hot.select("doc_id", "th", "start", "stop")))
    return every.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))


def covered(lists: pa.Array, offs: np.ndarray) -> np.ndarray:
    """Mask of the symbols in the ranges of every document (null: none)."""
    change = np.zeros(int(offs[-1]) + 1, np.int64)
    if pa.types.is_list(lists.type) and len(lists):
        flat = lists.flatten()
        per = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
        doc = np.repeat(np.arange(len(lists)), per)
        np.add.at(change, offs[doc] + flat.field("start").to_numpy(), 1)
        np.add.at(change, offs[doc] + flat.field("stop").to_numpy(), -1)
    return np.cumsum(change)[:-1] > 0
