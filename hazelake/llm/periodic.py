"""Periodic runs of words (operator 12): suffix trees, constant-time LCE, Lyndon roots.

A run is a stretch of words of smallest period q that no neighbouring word extends; wanted are runs
of at least ``times`` periods and ``least`` words. Every such run has a Lyndon root, which is the
longest Lyndon word at its start in the order of words or in the reverse order. The longest
Lyndon words end where the next smaller (larger) suffix starts, so each position gives two candidates.
Ukkonen trees of the words and of their reversal, with an Euler tour and range minima over its depths,
tell how far a candidate's period extends to both sides.

Trees are built only over stretches that can hold a run: the words of a run after its first period have
all occurred at most q words before. Stretches of several documents share one tree, with a
separator of its own after each, so nothing crosses documents.

Defined cases: null and empty texts have no words and no runs; a text that is one word many times is
one run; rows with a null or repeated key are judged each by themselves; further columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazelake.llm.arrays import SPACE, column, owners, prepare, ranges, slices, spans, text_bytes

TREE_WORDS = 1 << 16  # stretches are gathered up to this size; a longer one has a tree of its own
WORD = r"([^\x20\x09-\x0D]+)"


def suffix_tree(s: list[int]) -> tuple[dict[int, int], list[int], list[int], int]:
    """Ukkonen's tree of ``s``, whose last symbol occurs once: (children by node * width + symbol,
    start and end of the edge into each node, width). Node 0 is the root."""
    n, width = len(s), max(s) + 1
    start, end, link = [0], [0], [0]
    child: dict[int, int] = {}
    node = edge = length = rest = 0
    for i, c in enumerate(s):
        rest += 1
        made = 0  # inner node that waits for its suffix link
        while rest:
            if not length:
                edge = i
            key = node * width + s[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                if made:
                    link[made] = node
                    made = 0
            else:
                a = start[below]
                size = end[below] - a
                if length >= size:
                    node, edge, length = below, edge + size, length - size
                    continue
                if s[a + length] == c:
                    length += 1
                    if made:
                        link[made] = node
                    break
                split = len(start)
                start += (a, i)
                end += (a + length, n)
                link += (0, 0)
                child[key] = split
                child[split * width + c] = split + 1
                start[below] = a + length
                child[split * width + s[a + length]] = below
                if made:
                    link[made] = split
                made = split
            rest -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - rest + 1
    return child, start, end, width


class Extensions:
    """Longest common extensions of the suffixes of ``s``, from the Euler tour of its suffix tree."""

    def __init__(self, s: list[int]):
        child, start, end, width = suffix_tree(s)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        to = np.fromiter(child.values(), np.int64, len(child))
        order = np.argsort(keys)
        parent, to = keys[order] // width, to[order]
        bounds = np.searchsorted(parent, np.arange(len(start) + 1)).tolist()
        kids, size = to.tolist(), (np.array(end) - np.array(start)).tolist()
        n = len(s)
        tour: list[int] = []  # string depths in the order of the tour
        first = [0] * n  # place of each suffix's leaf in the tour
        leaves: list[int] = []  # suffixes in lexicographic order
        at, deep = [0], [0]
        nxt = bounds[:-1].copy()
        while at:
            node, depth = at[-1], deep[-1]
            k = nxt[node]
            if k == bounds[node] == bounds[node + 1]:
                first[n - depth] = len(tour)
                leaves.append(n - depth)
            tour.append(depth)
            if k < bounds[node + 1]:
                nxt[node] = k + 1
                at.append(kids[k])
                deep.append(depth + size[kids[k]])
            else:
                at.pop()
                deep.pop()
        self.tour, self.first, self.order = np.array(tour, np.int32), np.array(first, np.int64), leaves

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes i and j (i != j): the depth of the leaves' lowest
        common ancestor, the least depth between them on the tour. The minima over stretches of 2**k
        tour places are made one k after the other."""
        a, b = self.first[i], self.first[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = np.log2(b - a + 1).astype(np.int64)
        out = np.zeros(len(a), np.int64)
        least = self.tour
        for k in range(int(level.max(initial=-1)) + 1):
            if k:
                least = np.minimum(least[:-(1 << k - 1)], least[1 << k - 1:])
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(least[a[at]], least[b[at] - (1 << k) + 1])
        return out


def lyndon_ends(order: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the next one that is smaller, and the next that is larger (n: none). These end the
    longest Lyndon words that start there, in the order of symbols and in the reverse order."""
    rank = [0] * n
    for r, i in enumerate(order):
        rank[i] = r
    out = []
    for sign in (1, -1):
        nxt, stack = [n] * n, []
        for i in range(n):
            r = sign * rank[i]
            while stack and sign * rank[stack[-1]] > r:
                nxt[stack.pop()] = i
            stack.append(i)
        out.append(np.array(nxt, np.int64))
    return out[0], out[1]


def runs_of(ids: np.ndarray, offs: np.ndarray, times: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs of several stretches laid end to end, by start and period."""
    many = len(offs) - 1
    at = np.arange(len(ids)) + np.repeat(np.arange(many), np.diff(offs))  # one separator after each stretch
    s = np.empty(len(ids) + many, np.int64)
    s[at] = ids + many
    s[offs[1:] + np.arange(many)] = np.arange(many)
    n = len(s)
    forward, backward = Extensions(s.tolist()), Extensions([*s[::-1].tolist(), int(s.max()) + 1])
    owner = np.cumsum(np.concatenate([[0], s[:-1] < many]))
    i = np.tile(np.arange(n), 2)
    j = np.concatenate(lyndon_ends(forward.order, n))
    q, near = j - i, np.minimum(j, n - 1)
    # a wanted run holds its root several times, so the word after the first root starts the next
    ok = (j < n) & (owner[i] == owner[near]) & (times * q <= np.diff(offs)[owner[i]]) & (s[i] == s[near]) & (s[i] >= many)
    i, j, q = i[ok], j[ok], q[ok]
    end = j + forward.of(i, j)
    start = i - backward.of(n - i, n - j)
    ok = end - start >= np.maximum(least, times * q)
    found = np.unique(np.stack([start[ok], q[ok], end[ok]], axis=1), axis=0)
    shift = owner[found[:, 0]] if len(found) else np.zeros(0, np.int64)
    return found[:, 0] - shift, found[:, 2] - shift, found[:, 1]


def stretches(ids: np.ndarray, offs: np.ndarray, times: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that can hold runs. For periods of q to 2q - 1 words, each word
    of a run after its first period has occurred at most 2q - 1 words before."""
    n = len(ids)
    owner = owners(offs, np.arange(n))
    order = np.lexsort((ids, owner))
    gap = np.full(n, n + 1, np.int64)
    same = (ids[order[1:]] == ids[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    gap[order[1:][same]] = order[1:][same] - order[:-1][same]
    cover = np.zeros(n + 1, np.int64)
    longest, q = int(np.diff(offs).max(initial=0)), 1
    while times * q <= longest:
        a, b = spans(gap < 2 * q, offs)
        ok = b - a >= max((times - 1) * q, least - 2 * q + 1)
        a, b = a[ok], b[ok]
        np.add.at(cover, np.maximum(offs[owner[a]], a - 2 * q + 1), 1)
        np.add.at(cover, b, -1)
        q *= 2
    return spans(np.cumsum(cover[:-1]) > 0, offs)


def find(ids: np.ndarray, offs: np.ndarray, times: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of all documents, by start and period."""
    starts, ends = stretches(ids, offs, times, least)
    out, lo = [], 0
    sizes = np.cumsum(ends - starts)
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + TREE_WORDS, side="right")))
        a, lens = starts[lo:hi], (ends - starts)[lo:hi]
        local = np.concatenate([[0], np.cumsum(lens)])
        symbols = np.unique(ids[ranges(a, lens)], return_inverse=True)[1]
        s, e, q = runs_of(symbols, local, times, least)
        shift = (a - local[:-1])[owners(local, s)]
        out.append((s + shift, e + shift, q))
        lo = hi
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def word_ids(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words (compared byte by byte)."""
    ends = np.concatenate([[0], np.cumsum(lens)])
    packed = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data[ranges(starts, lens)])])
    return packed.dictionary_encode().indices.to_numpy().astype(np.int64)


def joined(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, offs: np.ndarray) -> pa.Array:
    """Texts of words joined by one blank; ``offs`` counts each text's words."""
    raw = np.append(data, np.uint8(0x20))[ranges(starts, lens + 1)]
    ends = np.concatenate([[0], np.cumsum(lens + 1)])
    raw[ends[1:] - 1] = 0x20
    last = np.zeros(len(raw), bool)
    last[ends[offs[1:][offs[1:] > offs[:-1]]] - 1] = True  # no blank after a text's last word
    at = ends[offs] - np.concatenate([[0], np.cumsum(offs[1:] > offs[:-1])])
    return pa.Array.from_buffers(pa.large_string(), len(offs) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw[~last])]).cast(pa.string())


def collapse(docs: DataFrame, times: int = 4, least: int = 6, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, runs array<struct<start, length, period>> by start and period, collapsed): the runs of every
    whole text in words, and its words joined by one blank, without those that repeat a run's first period."""
    prepare(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for part in slices(batches, "text"):
            data, offs = text_bytes(column(part, "text"))
            a, b = spans(~SPACE[data], offs)
            lens, words = b - a, np.searchsorted(a, offs)
            s, e, q = find(word_ids(data, a, lens), words, times, least) if len(a) else (np.zeros(0, np.int64),) * 3
            gone = np.zeros(len(a) + 1, np.int64)
            np.add.at(gone, s + q, 1)
            np.add.at(gone, e, -1)
            keep = np.cumsum(gone[:-1]) == 0
            left = np.concatenate([[0], np.cumsum(keep)])[words]
            found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (s - words[owners(words, s)], e - s, q)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays([column(part, "key"), pa.ListArray.from_arrays(pa.array(np.searchsorted(s, words), pa.int32()), found),
                                              joined(data, a[keep], lens[keep], left)], ["key", "runs", "collapsed"])

    out = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"key {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return out.withColumnRenamed("key", key)


def with_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text): in one document of ten, chosen by the key's crc32, all words from one on repeat a stretch of words."""
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")).otherwise(F.col(text))
    changed = F.get(F.transform(F.array(F.regexp_extract_all(text, F.lit(WORD), 1)), repeated), F.lit(0))
    return docs.select(key, F.when(F.col(text).isNotNull() & (h % 10 == 0), changed).otherwise(F.col(text)).alias(text))


def digests(docs: DataFrame) -> DataFrame:
    """The query's columns, over the documents with their planted repeats."""
    out = collapse(with_repeats(docs))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("first"), (-r["period"]).alias("short"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    length, start, period = best["length"], -best["first"], -best["short"]
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
                      F.floor(1000 * length / period).cast("long").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
