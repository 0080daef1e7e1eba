"""Substring deduplication over bytes with a hash-compared suffix sort (operator 1).

Which suffixes to sort comes from ``anchors``: window starts in segments that share an anchor.
They are sorted by mergesort. Two suffixes are compared through their longest common extension,
found by binary search over prefix polynomial hashes, in logarithmic time; all comparisons of one
merge level run together as arrays. Neighbours that agree on a whole window are then compared
byte by byte, so a hash collision cannot join them. Suffixes of one anchor at one offset are
merged among themselves, since no others can be equal.

Result: every byte covered by a window of 200 bytes that also starts anywhere else goes. Defined
cases: null text is empty; texts shorter than a window lose nothing; repeated rows repeat each
other, rows that share a doc_id or have none included; bytes are UTF-8, and kept bytes may cut a
character, so they are given as binary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.llm.anchors import Rows, Rule, covered, window_classes_by_hash, with_ranges
from hazelake.llm.arrays import (
    BYTE_VALUES,
    column,
    lean,
    powers,
    prefix_hashes,
    slices,
    spans,
    text_bytes,
)

WINDOW = 200
GRAM = 40


class Suffixes:
    """Suffixes of a text, compared over ``window`` symbols."""

    def __init__(self, rows: Rows, window: int):
        self.raw, self.window = rows.raw, window
        self.prefix = prefix_hashes(rows.symbols)
        self.inverse = powers(len(self.prefix))[1]

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension of the suffixes at a and b, at most a window."""
        lo, hi = np.zeros(len(a), np.int64), np.full(len(a), self.window)
        p, inv = self.prefix, self.inverse
        pa_, pb = p[a], p[b]
        ia, ib = inv[a], inv[b]
        for _ in range(int(self.window).bit_length()):
            mid = (lo + hi + 1) >> 1
            same = (p[a + mid] - pa_) * ia == (p[b + mid] - pb) * ib
            lo = np.where(same, mid, lo)
            hi = np.where(same, hi, mid - 1)
        return lo

    def order(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for suffix a before, equal to or after suffix b."""
        n = self.extension(a, b)
        whole = n >= self.window
        n = np.minimum(n, self.window - 1)
        return np.where(whole, 0, np.sign(self.raw[a + n].astype(np.int64) - self.raw[b + n].astype(np.int64)))

    def sort(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Indices that sort the suffixes within groups (groups ascending on input)."""
        idx = np.arange(len(starts))
        first = np.flatnonzero(np.diff(group, prepend=-1))
        size = np.diff(np.append(first, len(group)))
        base, count = np.repeat(first, size), np.repeat(size, size)
        place = idx - base
        width = 1
        while len(size) and width < size.max():
            live = np.flatnonzero(count > width)
            run = place[live] // width
            mine = starts[idx[live]]
            odd = run & 1
            pair = base[live] + (run - odd) * width  # where both runs of the pair begin
            other = np.where(odd == 1, pair, pair + width)
            end = base[live] + count[live]
            lo, hi = np.minimum(other, end), np.minimum(other + width, end)
            top = lo.copy()
            lo_at, hi_at = lo.copy(), hi
            while True:
                open_ = np.flatnonzero(lo_at < hi_at)
                if not len(open_):
                    break
                mid = (lo_at[open_] + hi_at[open_]) >> 1
                c = self.order(starts[idx[mid]], mine[open_])
                before = np.where(odd[open_] == 1, c <= 0, c < 0)  # equal suffixes keep the left run first
                lo_at[open_] = np.where(before, mid + 1, lo_at[open_])
                hi_at[open_] = np.where(before, hi_at[open_], mid)
            target = pair + (place[live] % width) + (lo_at - top)
            moved = idx.copy()
            moved[target] = idx[live]
            idx = moved
            width *= 2
        return idx

    def verified(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Byte by byte equality of windows."""
        out = np.zeros(len(a), bool)
        step = max(1, (1 << 22) // self.window)
        reach = np.arange(self.window)
        for lo in range(0, len(a), step):
            x, y = a[lo:lo + step], b[lo:lo + step]
            out[lo:lo + step] = (self.raw[x[:, None] + reach] == self.raw[y[:, None] + reach]).all(axis=1)
        return out


def sorted_classes(rows: Rows, window: int):
    """Classes of equal windows from the sorted suffixes of a block."""
    row, at, offset = window_classes_by_hash(rows, window)
    start = rows.begin[row] + at
    order = np.lexsort((offset, rows.group[row]))
    g, o = rows.group[row][order], offset[order]
    new = np.ones(len(order), bool)
    new[1:] = (g[1:] != g[:-1]) | (o[1:] != o[:-1])
    group = np.cumsum(new) - 1
    suffixes = Suffixes(rows, window)
    place = suffixes.sort(start[order], group)
    s = start[order][place]
    equal = np.zeros(len(s), bool)
    near = np.flatnonzero(group[1:] == group[:-1]) + 1
    near = near[suffixes.extension(s[near - 1], s[near]) >= window]
    equal[near[suffixes.verified(s[near - 1], s[near])]] = True
    label = np.empty(len(s), np.int64)
    label[order[place]] = np.cumsum(~equal) - 1
    return row, at, label


def byte_symbols(data: np.ndarray, offs: np.ndarray):
    return BYTE_VALUES[data], data, offs


RULE = Rule(WINDOW, GRAM, byte_symbols, np.uint8, sorted_classes, True)


def repeated_bytes(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of every document: spans are the maximal removed
    byte ranges, kept the remaining bytes."""
    joined = with_ranges(docs, rule)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
        for part in slices(batches, "text"):
            data, offs = text_bytes(column(part, "text"))
            gone = covered(column(part, "ranges"), offs)
            a, b = spans(gone, offs)
            cut = np.searchsorted(a, offs)
            doc = np.repeat(np.arange(part.num_rows), np.diff(cut))
            removed = np.concatenate([[0], np.cumsum(gone)])[offs]
            kept, at = data[~gone].tobytes(), (offs - removed).tolist()
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.array(np.diff(offs)), pa.array(np.diff(removed)),
                 pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays([pa.array(a - offs[doc]), pa.array(b - offs[doc])], fields=list(span))),
                 pa.array([kept[x:y] for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary())], ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return joined.mapInArrow(lean(run), f"doc_id {kind}, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary")


def digests(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    return repeated_bytes(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
