"""Benchmark decontamination with a generalised suffix automaton (operator 3).

The automaton holds every word substring of the normalised test items. Document words stream
through it; the state and the length of the longest match ending at each word tell which windows
(13 item words, or a whole shorter item) end there and which items hold them. Words that no item
has reset the automaton, so only runs of known words that could hold a window are streamed; the
runs are found with numpy over whole texts.

Items are dealt into shards of a bounded number of bytes (``SHARD_BYTES``, checked by an
aggregate before anything is collected). A shard's automaton is built in the driver and
broadcast; more shards mean more passes over the documents, never a larger broadcast.

Defined cases: null or empty text has no words, no hits, ``contaminated`` false; items without
words have no window; equal items all count; repeated documents are judged each; an empty
benchmark hits nothing; null item ids are kept as the text '' in lists.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazelake.llm.arrays import (
    ALNUM,
    BYTE_VALUES,
    LOWER,
    column,
    lean,
    owners,
    prefix_hashes,
    prepare,
    slices,
    span_hashes,
    spans,
    text_bytes,
    unused,
)
from hazelake.session import materialize

WINDOW = 13
SHARD_BYTES = 512 << 10  # of item text in one automaton; a worker holds about 100 times that
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    """Normalised words: ASCII lower-cased; digits, ASCII letters and all other non-ASCII text."""
    return WORD.findall(text.encode().translate(bytes(LOWER))) if text else []


class Automaton:
    """Generalised suffix automaton over word ids of the items of one shard."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        holds: list[set[str]] = [set()]
        ends: list[tuple[int, int, str]] = []
        self.shortest = window
        for item, text in items:
            seq = [self.ids.setdefault(w, len(self.ids)) for w in words(text)]
            if not seq:
                continue
            self.shortest = min(self.shortest, len(seq))
            last = 0
            for w in seq:
                last = self._extend(last, w)
            while len(holds) < len(self.next):
                holds.append(set())
            state = 0
            for w in seq:
                state = self.next[state][w]
                holds[state].add(item)
            if len(seq) < window:
                ends.append((state, len(seq), item))
        order = sorted(range(1, len(self.next)), key=lambda s: -self.length[s])
        # items of the states that stand for exactly `window` words; smaller states are never asked
        self.items: dict[int, frozenset[str]] = {}
        for s in order:
            up = self.link[s]
            if self.length[s] >= window:
                if self.length[up] >= window:
                    holds[up] |= holds[s]
                else:
                    self.items[s] = frozenset(holds[s])
        own: dict[int, list[tuple[int, str]]] = {}
        for state, n, item in ends:
            own.setdefault(state, []).append((n, item))
        self.short: list[tuple[tuple[int, str], ...]] = [()] * len(self.next)
        for s in reversed(order):
            self.short[s] = (*own.get(s, ()), *self.short[self.link[s]])
        top = [-1] * len(self.next)
        for s in reversed(order):
            up = self.link[s]
            top[s] = top[up] if top[up] >= 0 else (s if self.length[s] >= window else -1)
        self.top = top
        data, offs = text_bytes(pa.array([b"".join(self.ids)], pa.binary()))
        lens = np.fromiter(map(len, self.ids), np.int64, len(self.ids))
        at = np.cumsum(lens) - lens
        self.known = np.sort(span_hashes(prefix_hashes(BYTE_VALUES[data]), at, at + lens))

    def _state(self, length: int, link: int, nxt: dict[int, int]) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def _split(self, p: int, q: int, w: int) -> int:
        half = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = half
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = half
            p = self.link[p]
        return half

    def stream(self, seq: list[bytes], hit: np.ndarray, found: set[str]) -> None:
        """Run a sequence of words; mark covered words in ``hit`` and add items to ``found``."""
        state = n = 0
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for i, word in enumerate(seq):
            w = self.ids.get(word, -1)
            while state and w not in nxt[state]:
                state = link[state]
                n = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                n += 1
            if n >= window:
                hit[i + 1 - window:i + 1] = True
                found |= self.items[self.top[state]]
            for size, item in self.short[state]:
                if size <= n:
                    hit[i + 1 - size:i + 1] = True
                    found.add(item)


def _known(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(hashes), bool)
    return table[np.minimum(np.searchsorted(table, hashes), len(table) - 1)] == hashes


def shards(benchmark: DataFrame, item: str, text: str, window: int, shard_bytes: int) -> Iterator[tuple[Automaton, bool]]:
    """One automaton per shard of items, and whether it is the last; their number follows the size."""
    b = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).cast("string").alias("text"))
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / shard_bytes))
    for k in range(n):
        part = b if n == 1 else b.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield Automaton([(r[0], r[1]) for r in part.collect()], window), k == n - 1


def find_hits(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text",
              window: int = WINDOW, shard_bytes: int = SHARD_BYTES, out: str = "decontam") -> DataFrame:
    """All columns of ``docs`` and a struct column ``out``: n_words, spans (maximal runs of hit
    words as byte ranges of the text, with their number of words) and items (ids, sorted as text);
    a column of that name is replaced."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop(out)
    kind = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("words", pa.int64())])
    schema = "n_words bigint, spans array<struct<start:bigint,stop:bigint,words:bigint>>, items array<string>"
    done = docs.withColumn(text, F.col(text).cast("string"))
    names, fields = done.columns, done.schema.fields
    for automaton, last in shards(benchmark, item, item_text, window, shard_bytes):
        shared = spark.sparkContext.broadcast(automaton)

        def run(batches, shared=shared):
            for part in slices(batches, text):
                before = column(part, out).to_pylist() if out in part.schema.names else None
                rows = _scan(shared.value, *text_bytes(column(part, text)), before)
                found = pa.StructArray.from_arrays(
                    [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.list_(kind)), pa.array(rows[2], pa.list_(pa.string()))],
                    ["n_words", "spans", "items"])
                yield pa.RecordBatch.from_arrays([*[column(part, c) for c in names], found], [*names, out])

        got = done.mapInArrow(lean(run), T.StructType([*fields, *T.StructType.fromDDL(f"`{out}` struct<{schema}>").fields]))
        # a second shard reads what the first found, written once: two automata never share a worker
        done = got if last else materialize(got, "decontam")
    return done


def _scan(automaton: Automaton, data: np.ndarray, offs: np.ndarray, before: list | None = None) -> tuple[list, list, list]:
    """n_words, spans and items of every document; ``before`` holds what earlier shards found."""
    n_docs = len(offs) - 1
    low = LOWER[data]
    start, stop = spans(ALNUM[low], offs)
    doc = owners(offs, start)
    n_words = np.bincount(doc, minlength=n_docs) if n_docs else np.zeros(0, np.int64)
    found_spans: list[list] = [[] for _ in range(n_docs)]
    found_items: list[list] = [[] for _ in range(n_docs)]
    if len(start):
        word_offs = np.concatenate([[0], np.cumsum(n_words)])
        hit = np.zeros(len(start), bool)
        items: dict[int, set[str]] = {}
        for d, old in enumerate(before or ()):
            if old["spans"]:
                items[d] = set(old["items"])
                for s in old["spans"]:
                    i = int(np.searchsorted(start, offs[d] + s["start"]))
                    hit[i:i + s["words"]] = True
        a, b = spans(_known(span_hashes(prefix_hashes(BYTE_VALUES[low]), start, stop), automaton.known), word_offs)
        long = b - a >= automaton.shortest
        raw = low.tobytes()
        for i, j in zip(a[long].tolist(), b[long].tolist(), strict=True):
            automaton.stream([raw[x:y] for x, y in zip(start[i:j].tolist(), stop[i:j].tolist(), strict=True)],
                             hit[i:j], items.setdefault(int(doc[i]), set()))
        for i, j in zip(*spans(hit, word_offs), strict=True):
            d = int(doc[i])
            found_spans[d].append({"start": int(start[i] - offs[d]), "stop": int(stop[j - 1] - offs[d]), "words": int(j - i)})
        for d, found in items.items():
            found_items[d] = sorted(found)
    return n_words.tolist(), found_spans, found_items


def _judged(docs: DataFrame, benchmark: DataFrame, **options):
    """``find_hits`` with names that are free in ``docs``, and the columns of its struct, the number of hit words and
    the contamination rule."""
    out, = unused(docs.columns, "decontam")
    got = find_hits(docs, benchmark, out=out, **options)
    hits = F.col(out)
    n_hit = F.aggregate(hits["spans"], F.lit(0).cast("long"), lambda n, s: n + s["words"])
    return got, hits, n_hit, (n_hit > 0) & (20 * n_hit >= hits["n_words"])


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", min_words: int = WINDOW, coverage: float = 0.05, **options) -> DataFrame:
    """Documents without their contaminated spans: in a document whose hit words reach ``coverage``
    of its words every span goes, otherwise spans of at least ``min_words`` words go."""
    names = docs.columns
    got, hits, n_hit, _ = _judged(docs, benchmark, text=text, **options)
    all_go = n_hit >= coverage * hits["n_words"]
    gone = F.filter(hits["spans"], lambda s: all_go | (s["words"] >= min_words))
    raw = F.col(text).cast("binary")
    kept = F.aggregate(
        gone, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").cast("binary").alias("kept")),
        lambda acc, s: F.struct(s["stop"].alias("at"), F.concat(acc["kept"], F.substring(raw, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))).alias("kept")))
    rest = F.concat(kept["kept"], F.substring(raw, (kept["at"] + 1).cast("int"), F.lit(2**31 - 1))).cast("string")
    return got.withColumn(text, F.when(F.size(gone) > 0, rest).otherwise(F.col(text))).select(*[F.col(f"`{c}`") for c in names])


def digests(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The query's columns."""
    got, hits, n_hit, contaminated = _judged(docs.select("doc_id", "text"), benchmark, **options)
    return got.select(
        "doc_id", hits["n_words"].alias("n_words"), n_hit.alias("n_hit"), F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"), contaminated.alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that the rule leaves, with their columns as they were."""
    names = docs.columns
    got, _, _, contaminated = _judged(docs, benchmark, **options)
    return got.where(~contaminated).select(*[F.col(f"`{c}`") for c in names])
