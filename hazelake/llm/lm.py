"""Language model scoring: interpolated modified Kneser-Ney bigrams (operator 5).

Words (ASCII lower-cased, white space separates, one end token per text) are counted in Spark.
The vocabulary is stored as sorted 64-bit word hashes with counts; a word's id is its place there.
Bigrams of ids are counted in ranges of contexts; each range becomes one file of sorted bigram
hashes (a bijection of the id pair, so no two bigrams share one) with their counts, and its
contexts with the numbers of bigrams seen once, twice and more. Workers map the files into
memory and look up only what a chunk of texts holds. Contexts with more than a quarter of a file's
tokens are spread over all files by their second word.

    p(w | v) = max(c(vw) - D(c), 0) / c(v) + g(v) p(w)
    p(w)     = max(k(w) - D'(k), 0) / K + g' / (V + 1)

k(w) is the number of different words before w, K the number of different bigrams, D and D' the
three discounts of modified Kneser-Ney, g the discounted mass. The first word's context is the
text's start. An unknown word gets g' / (V + 1); after an unknown word p(w) is used.

Files go below spark.checkpoint.dir by ``pyarrow.fs``; files of a local or mounted folder are
mapped where they are, others through a copy that is unlinked once it is mapped. Ids take 32
bits: more than 2**32 different words raise an error. Defined cases: null text is empty and holds
one end token; with nothing to learn from, N and V are 0 and every score is that of one unknown
word per token; a null doc_id is scored and not learned from; repeated rows count each.
"""

from __future__ import annotations

import math
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.llm.arrays import (
    LOWER,
    SPACE,
    column,
    crc_mod,
    lean,
    mix,
    owners,
    prepare,
    slices,
    spans,
    text_bytes,
    word_hashes,
)
from hazelake.session import materialize, scratch_path

END = np.uint64(0x00E4D0FF1CE00001)  # hash of the end token
FILE_TOKENS = 8_000_000
HELD_TOKENS = 3_000_000  # tokens whose counts a task holds before it emits them
PART_BITS = 3  # a file's bigrams are summed and sorted in so many parts, by the top bits of their hashes


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of all tokens, an end token after each text's words."""
    low = LOWER[data]
    start, stop = spans(~SPACE[low], offs)
    doc = owners(offs, start)
    n = np.bincount(doc, minlength=len(offs) - 1) if len(start) else np.zeros(len(offs) - 1, np.int64)
    ends = np.cumsum(n + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, END, np.uint64)
    if len(start):
        out[np.arange(len(start)) + doc] = word_hashes(low, start, stop)
    return out, np.concatenate([[0], ends]).astype(np.int64)


def _fs(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def write_array(folder: str, name: str, *arrays: np.ndarray) -> None:
    """Write arrays end to end under a name of its own, then rename: a repeated task replaces the same content."""
    import uuid
    store, path = _fs(folder)
    store.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(part) as f:
        for array in arrays:
            f.write(np.ascontiguousarray(array).tobytes())
    store.move(part, f"{path}/{name}")


_MAPPED: dict[tuple[str, str], np.ndarray] = {}


def read_array(folder: str, name: str, kind) -> np.ndarray:
    """Memory-mapped array of a file (kept open per process)."""
    if (folder, name) not in _MAPPED:
        if len(_MAPPED) > 4096:
            _MAPPED.clear()
        store, path = _fs(folder)
        full = f"{path}/{name}"
        if not store.get_file_info(full).size:
            _MAPPED[folder, name] = np.zeros(0, kind)
        elif store.type_name == "local":
            _MAPPED[folder, name] = np.memmap(full, kind, "r")
        else:
            with tempfile.NamedTemporaryFile() as local:
                with store.open_input_stream(full) as f:
                    while block := f.read(1 << 22):
                        local.write(block)
                local.flush()
                _MAPPED[folder, name] = np.memmap(local.name, kind, "r")
    return _MAPPED[folder, name]


def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of every key in a sorted array, or -1."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


class Vocabulary:
    """Sorted word hashes in files by their top bits; ids run through the files."""

    def __init__(self, folder: str, bits: int, sizes: list[int]):
        self.folder, self.bits, self.sizes = folder, bits, sizes
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    @property
    def n(self) -> int:
        return int(self.first[-1])

    def file_of(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of ascending hashes, -1 for unknown ones."""
        out = np.full(len(hashes), -1, np.int64)
        cut = np.searchsorted(self.file_of(hashes), np.arange(len(self.sizes) + 1))
        for f, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            if b > a and self.sizes[f]:
                at = find(read_array(self.folder, f"words-{f}", np.uint64), hashes[a:b])
                out[a:b] = np.where(at >= 0, at + self.first[f], -1)
        return out

    def take(self, name: str, kind, ids: np.ndarray) -> np.ndarray:
        """Values of a file set that is aligned with the ids; 0 for -1. Ids ascend but for -1."""
        out = np.zeros(len(ids), np.float64)
        ok = np.flatnonzero(ids >= 0)
        f = np.searchsorted(self.first, ids[ok], side="right") - 1
        for k in np.unique(f):
            mine = ok[f == k]
            out[mine] = read_array(self.folder, f"{name}-{k}", kind)[ids[mine] - self.first[k]]
        return out


def _gathered(batches, count, emit):
    """Sum counts of keys over batches, emitting whenever a task holds HELD_TOKENS."""
    keys, sums, held = [], [], 0
    for part in slices(batches, "text"):
        k, n = count(part)
        keys.append(k)
        sums.append(n)
        held += len(k)
        if held >= HELD_TOKENS:
            k, n = summed(np.concatenate(keys), np.concatenate(sums))
            if len(k) > HELD_TOKENS // 2:
                yield from emit(k, n)
                keys, sums, held = [], [], 0
            else:
                keys, sums, held = [k], [n], len(k)
    if keys:
        yield from emit(*summed(np.concatenate(keys), np.concatenate(sums)))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _bits(n_tokens: int) -> int:
    return max(0, math.ceil(math.log2(max(1, n_tokens / FILE_TOKENS))))


def _by_file(batches):
    """Tables of one file each from batches with a column ``file`` (a task holds whole files)."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    file = table.column("file").to_numpy()
    for f in np.unique(file):
        yield int(f), table.filter(pa.array(file == f)).combine_chunks()


def build_vocabulary(taught: DataFrame) -> tuple[Vocabulary, int]:
    """Vocabulary with counts, and the number of tokens."""
    spark = taught.sparkSession

    def count(part):
        return np.unique(tokens(*text_bytes(column(part, "text")))[0], return_counts=True)

    def emit(k, n):
        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], ["word", "n"])

    counted = materialize(taught.mapInArrow(lean(lambda b: _gathered(b, count, emit)), "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    total = counted.agg(F.sum("n"), F.count("*")).first()
    n_tokens, n_words = int(total[0] or 0), int(total[1])
    if n_words >= 1 << 32:
        raise ValueError("more than 2**32 different words")
    bits, folder = _bits(n_words * 8), scratch_path(spark, "lm-model")
    file = F.shiftrightunsigned("word", 64 - bits).cast("int") if bits else F.lit(0)

    def write(batches):
        for f, t in _by_file(batches):
            k = t.column("word").to_numpy().view(np.uint64)
            order = np.argsort(k)
            write_array(folder, f"words-{f}", k[order])
            write_array(folder, f"counts-{f}", t.column("n").to_numpy()[order])
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([len(k)], pa.int64())], ["file", "size"])

    sizes = dict(counted.withColumn("file", file).repartition(max(1, 1 << bits), "file").mapInArrow(lean(write), "file int, size bigint").collect())  # one row per file
    return Vocabulary(folder, bits, [sizes.get(f, 0) for f in range(1 << bits)]), n_tokens


class Bigrams:
    """Sorted bigram hashes in files dealt by context; the text's start is context V."""

    def __init__(self, vocabulary: Vocabulary, bits: int, hot: np.ndarray):
        self.v, self.bits, self.hot = vocabulary, bits, hot

    def file_of(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(context), np.int64)
        key = np.where(find(self.hot, context) >= 0, mix(word.astype(np.uint64) + np.uint64(1 << 40)), mix(context.astype(np.uint64)))
        return (key >> np.uint64(64 - self.bits)).astype(np.int64)


class FileOfBigrams:
    """The bigrams of one file as they come: codes (context and word) with counts, 12 bytes each. They are dealt to
    parts by the top bits of their hashes, and summed, sorted and written part by part."""

    def __init__(self):
        self.parts: list[list] = [[] for _ in range(1 << PART_BITS)]

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        part = (mix(codes) >> np.uint64(64 - PART_BITS)).astype(np.uint8)
        order = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[order], np.arange(len(self.parts) + 1))
        for held, a, b in zip(self.parts, cut[:-1], cut[1:], strict=True):
            if b > a:
                held.append((codes[order[a:b]], counts[order[a:b]].astype(np.uint32)))

    def summed(self):
        """(codes, counts) of every part, each code once; a part is let go as its turn comes."""
        for p in range(len(self.parts)):
            held, self.parts[p] = self.parts[p], []
            if held:
                codes, counts = (np.concatenate(x) for x in zip(*held, strict=True))
                del held
                yield summed(codes, counts.astype(np.int64))

    def written(self, folder: str, f: int, hot: np.ndarray) -> pa.RecordBatch:
        """Writes the arrays of file ``f``; its words with their numbers of contexts, and its statistics."""
        hashes, seen, often_at, often, contexts, kinds, words, before = ([] for _ in range(8))
        once, n_pairs = np.zeros(4, np.int64), 0
        for k, n in self.summed():
            h = mix(k)
            order = np.argsort(h)
            hashes.append(h[order])
            ordered = n[order]
            seen.append(np.minimum(ordered, 255).astype(np.uint8))
            big = np.flatnonzero(ordered > 254)
            often_at.append(big + n_pairs)
            often.append(ordered[big])
            del h, order, ordered
            context, word = (k >> np.uint64(32)).astype(np.int64), (k & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            first = np.flatnonzero(np.diff(context, prepend=-1))
            contexts.append(context[first])
            kinds.append(np.stack([np.add.reduceat(x, first, dtype=np.uint32) for x in (n == 1, n == 2, n > 2)], axis=1))
            w, c = np.unique(word, return_counts=True)
            words.append(w)
            before.append(c.astype(np.uint32))
            once += [int((n == x).sum()) for x in (1, 2, 3, 4)]
            n_pairs += len(n)
        write_array(folder, f"bigrams-{f}", *hashes)
        write_array(folder, f"seen-{f}", *seen)
        write_array(folder, f"often-at-{f}", *often_at)
        write_array(folder, f"often-{f}", *often)
        del hashes, seen
        mine = np.concatenate(contexts)
        order = np.argsort(mine, kind="stable")
        mine, kinds = mine[order], np.concatenate(kinds)[order]
        first = np.flatnonzero(np.diff(mine, prepend=-1))
        mine, kinds = mine[first], np.add.reduceat(kinds, first, axis=0, dtype=np.uint32)
        spread = find(hot, mine) >= 0
        write_array(folder, f"contexts-{f}", mine[~spread])
        write_array(folder, f"kinds-{f}", kinds[~spread])
        w, c = summed(np.concatenate(words), np.concatenate(before))
        stat = [*[(-1, int(x), *map(int, kd), 0) for x, kd in zip(mine[spread], kinds[spread], strict=True)],
                (-2, *map(int, once), n_pairs)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([w, [s[0] for s in stat]]).astype(np.int64)), pa.array(np.concatenate([c, [s[1] for s in stat]]).astype(np.int64)),
             *[pa.array(np.concatenate([np.zeros(len(w), np.int64), [s[i] for s in stat]]).astype(np.int64)) for i in (2, 3, 4, 5)]],
            ["id", "a", "b", "c", "d", "e"])


def codes_of(v: Vocabulary, data: np.ndarray, offs: np.ndarray):
    """Per token: unique index arrays for its word and the one before (V at the start, -1 unknown)."""
    h, ends = tokens(data, offs)
    uniq, inverse = np.unique(h, return_inverse=True)
    ids = v.ids(uniq)
    word = ids[inverse]
    context = np.empty(len(word), np.int64)
    context[1:] = word[:-1]
    context[ends[:-1]] = v.n
    return uniq, inverse, ids, word, context, ends


def build(docs: DataFrame, *, modulus: int = 7, held: int = 2) -> dict:
    """The model: file locations, sizes and discounts (a small dictionary)."""
    spark = docs.sparkSession
    prepare(spark)
    taught = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(crc_mod("doc_id", modulus) != held).select("text")
    v, n_tokens = build_vocabulary(taught)
    bits = _bits(n_tokens)
    n_docs = taught.count()
    limit = FILE_TOKENS // 4

    def heavy(batches):
        for batch in batches:
            for f in column(batch, "id").to_numpy():
                c = read_array(v.folder, f"counts-{f}", np.int64) if v.sizes[f] else np.zeros(0, np.int64)
                at = np.flatnonzero(c > limit)
                yield pa.RecordBatch.from_arrays([pa.array(at + v.first[f], pa.int64())], ["id"])

    # contexts above a quarter of a file: at most four times as many as there are files
    hot = [r[0] for r in spark.range(0, 1 << v.bits, 1, min(1 << v.bits, 64)).mapInArrow(heavy, "id bigint").collect()]
    bigrams = Bigrams(v, bits, np.array(sorted([*hot, *([v.n] if n_docs > limit else [])]), np.int64))

    def count(part):
        _, _, _, word, context, _ = codes_of(v, *text_bytes(column(part, "text")))
        return np.unique((context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64), return_counts=True)

    def emit(k, n):
        context, word = (k >> np.uint64(32)).astype(np.int64), (k & np.uint64(0xFFFFFFFF)).astype(np.int64)
        file = bigrams.file_of(context, word)
        order = np.argsort(file, kind="stable")
        cut = np.searchsorted(file[order], np.arange((1 << bits) + 1))
        for f, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            for lo in range(a, b, 1 << 18):
                at = order[lo:min(b, lo + (1 << 18))]
                # differences of ascending contexts and small counts compress well in the shuffle
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f], pa.int32()), pa.array([np.diff(context[at], prepend=0).astype(np.uint32).tobytes()], pa.binary()),
                     pa.array([word[at].astype(np.uint32).tobytes()], pa.binary()), pa.array([n[at].astype(np.uint32).tobytes()], pa.binary())],
                    ["file", "contexts", "words", "counts"])

    packed = taught.mapInArrow(lean(lambda b: _gathered(b, count, emit)), "file int, contexts binary, words binary, counts binary")

    def write(batches):
        file, held_ = None, None
        for batch in batches:  # ordered by file: a task holds one at a time
            for i in range(batch.num_rows):
                f, c, w, n = (column(batch, x)[i].as_py() for x in ("file", "contexts", "words", "counts"))
                if f != file:
                    if held_ is not None:
                        yield held_.written(v.folder, file, bigrams.hot)
                    file, held_ = f, FileOfBigrams()
                context = np.cumsum(np.frombuffer(c, np.uint32), dtype=np.uint64)
                held_.add((context << np.uint64(32)) | np.frombuffer(w, np.uint32), np.frombuffer(n, np.uint32))
        if held_ is not None:
            yield held_.written(v.folder, file, bigrams.hot)

    stats = materialize(packed.repartition(max(1, 1 << bits), "file").sortWithinPartitions("file").mapInArrow(lean(write), "id bigint, a bigint, b bigint, c bigint, d bigint, e bigint"), "lm-stats")
    few = stats.where("id < 0").collect()  # one row per file, and per file and hot context
    hot_kinds: dict[int, np.ndarray] = {}
    for r in few:
        if r[0] == -1:
            hot_kinds[r[1]] = hot_kinds.get(r[1], np.zeros(3)) + np.array([r[2], r[3], r[4]], float)
    pair_counts = [sum(r[i] for r in few if r[0] == -2) for i in (1, 2, 3, 4, 5)]
    before = materialize(stats.where("id >= 0").groupBy("id").agg(F.sum("a").alias("k")), "lm-before")
    c = before.agg(*[F.sum((F.col("k") == x).cast("long")) for x in (1, 2, 3, 4)], F.sum((F.col("k") > 2).cast("long"))).first()
    word_counts = [int(x or 0) for x in c]
    file = F.lit(0)
    for f in range(1, len(v.sizes)):
        file = file + (F.col("id") >= int(v.first[f])).cast("int")

    def align(batches):
        for f, t in _by_file(batches):
            out = np.zeros(v.sizes[f], np.uint32)
            out[t.column("id").to_numpy() - v.first[f]] = t.column("k").to_numpy()
            write_array(v.folder, f"before-{f}", out)
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32())], ["file"])

    done = {r[0] for r in before.withColumn("file", file).repartition(max(1, 1 << v.bits), "file").mapInArrow(lean(align), "file int").collect()}
    for f in range(len(v.sizes)):
        if f not in done:
            write_array(v.folder, f"before-{f}", np.zeros(v.sizes[f], np.uint32))
    d2, d1 = discounts(pair_counts[:4]), discounts(word_counts[:4])
    pairs = pair_counts[4]
    mass = (d1[0] * word_counts[0] + d1[1] * word_counts[1] + d1[2] * word_counts[4]) / pairs if pairs else 1.0
    return {"vocabulary": v, "bigrams": bigrams, "tokens": n_tokens, "docs": n_docs, "pairs": pairs, "d2": d2, "d1": d1, "mass": mass,
            "hot_kinds": {k: x.tolist() for k, x in hot_kinds.items()}}


def discounts(n: list[int]) -> list[float]:
    """The three discounts from the numbers of things seen once to four times."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(x, 0.05), limit) for x, limit in zip(raw, (0.99, 1.98, 2.97), strict=True)]


def discount(d: list[float], c: np.ndarray) -> np.ndarray:
    return np.where(c >= 3, d[2], np.where(c >= 2, d[1], np.where(c >= 1, d[0], 0.0)))


def probabilities(m: dict, uniq, inverse, ids, word, context) -> np.ndarray:
    """p of every token."""
    v, b = m["vocabulary"], m["bigrams"]
    k = v.take("before", np.uint32, ids) if m["pairs"] else np.zeros(len(ids))
    p1 = (np.maximum(k - discount(m["d1"], k), 0) / max(m["pairs"], 1) + m["mass"] / (v.n + 1))[inverse]
    p = p1.copy()
    known = np.flatnonzero((context >= 0) & (m["tokens"] > 0))
    if not len(known):
        return p
    ctx = np.unique(context[known])
    seen = np.zeros(len(ctx))
    own = ctx < v.n
    seen[own] = v.take("counts", np.int64, ctx[own])
    seen[~own] = m["docs"]
    kinds = np.zeros((len(ctx), 3))
    for c, x in m["hot_kinds"].items():
        at = np.searchsorted(ctx, c)
        if at < len(ctx) and ctx[at] == c:
            kinds[at] = x
    file = b.file_of(ctx, np.zeros(len(ctx), np.int64))
    cold = find(b.hot, ctx) < 0
    for f in np.unique(file[cold]):
        mine = np.flatnonzero(cold & (file == f))
        at = find(read_array(v.folder, f"contexts-{f}", np.int64), ctx[mine])
        ok = at >= 0
        kinds[mine[ok]] = read_array(v.folder, f"kinds-{f}", np.uint32).reshape(-1, 3)[at[ok]]
    back = np.where(seen > 0, kinds @ np.array(m["d2"]) / np.maximum(seen, 1), 1.0)
    place = np.searchsorted(ctx, context[known])
    p[known] = back[place] * p1[known]
    both = np.flatnonzero((context >= 0) & (word >= 0))
    code, at = np.unique((context[both].astype(np.uint64) << np.uint64(32)) | word[both].astype(np.uint64), return_inverse=True)
    n = np.zeros(len(code))
    file = b.file_of((code >> np.uint64(32)).astype(np.int64), (code & np.uint64(0xFFFFFFFF)).astype(np.int64))
    h = mix(code)
    for f in np.unique(file):
        mine = np.flatnonzero(file == f)
        mine = mine[np.argsort(h[mine])]  # ascending look-ups touch each page of the file once
        where = find(read_array(v.folder, f"bigrams-{f}", np.uint64), h[mine])
        ok = where >= 0
        got = read_array(v.folder, f"seen-{f}", np.uint8)[where[ok]].astype(float)
        often = np.flatnonzero(got == 255)
        if len(often):
            got[often] = read_array(v.folder, f"often-{f}", np.int64)[np.searchsorted(read_array(v.folder, f"often-at-{f}", np.int64), where[ok][often])]
        n[mine[ok]] = got
    n = n[at]
    p[both] += np.maximum(n - discount(m["d2"], n), 0) / np.maximum(seen[np.searchsorted(ctx, context[both])], 1)
    return p


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score, perplexity) of every whole text."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        v = m["vocabulary"]
        base = math.log10(m["tokens"] + 1 * (v.n + 1))
        for part in slices(batches, "text"):
            uniq, inverse, ids, word, context, ends = codes_of(v, *text_bytes(column(part, "text")))
            counts = v.take("counts", np.int64, ids)
            doc = np.repeat(np.arange(part.num_rows), np.diff(ends))
            sums = lambda x: np.bincount(doc, x, part.num_rows)  # noqa: E731, B023
            total = sums(np.log10(probabilities(m, uniq, inverse, ids, word, context)))
            n = np.diff(ends)
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.array(n), pa.array(sums((counts > 0)[inverse].astype(float)).astype(np.int64)),
                 pa.array(sums((np.log10(counts + 1) - base)[inverse])), pa.array(total), pa.array(10 ** np.minimum(-total / n, 300))],
                ["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        lean(run), f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double, perplexity double")


def digests(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    model = build(docs)
    return score(docs, model).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
