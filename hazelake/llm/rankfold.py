"""Byte-level BPE by rank files: higher-order functions fold the merges over distinct words
(operator 13).

A task cuts its texts into pieces and hands over, for every chunk of about 16 MB, the chunk's
distinct pieces ("words") and each document's piece numbers; no shuffle is needed. Spark
functions do the rest. A word is a string of symbols, its bytes at first, with one character for
each symbol (the symbol's rank plus an offset); beside it stand the ranks of the merges that can
occur in it, ascending. ``aggregate`` folds them over the word: each one joins its pair of symbols
wherever it stands, from the left. A literal array maps a rank to its pair, another to its symbol.

Why one pass is exact: a token that comes out of merges comes from the same last two parts in every
text, those it is merged from when it stands alone, since until then no merge crosses its ends. If both
have lower ranks than the token (``ascending``; so in every trained vocabulary), a merge makes
no pair of a lower rank than its own, and "the leftmost pair of lowest rank, again and again" is "rank by
rank, from the left". For other vocabularies ``aggregate`` looks for the lowest rank at every step and merges
its leftmost pair. Merges listed for a word that do not take place (a part went elsewhere) find no pair.

A piece that is a token as a whole is that token. A piece longer than any token is cut before the
fold wherever no token of the vocabulary can lie across the cut, which changes no merge; what is
still longer than ``LONG`` bytes (one character repeated, say) is merged by a heap and enters as its
finished tokens.

The vocabulary file is opened by its path in the driver; literals and broadcast are bounded by it.
Defined cases: null text encodes as the empty text; the empty text has no ids; a null key and
repeated rows are encoded like any other; further columns do not matter.
"""

from __future__ import annotations

import base64
import heapq
import json
import unicodedata
from collections import defaultdict

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazelake.llm.arrays import column, lean, prepare, slices
from hazelake.llm.bpe import PATTERN, char_classes, piece_starts

CHUNK = 16 << 20  # bytes of text that share a dictionary of words
SLICE = 1 << 18  # characters of text cut, or bytes of words whose merges are looked for, at once
LONG = 1024
FIRST = 0x100  # character of rank 0


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (lines of base64 and a number)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def last_parts(ranks: dict[bytes, int]) -> dict[bytes, bytes]:
    """Token -> left one of the two parts it is last merged from when it stands alone; tokens that merges do not lead to
    have none."""
    out = {}
    for token in ranks:
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            found = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                break
            i = min(found)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) == 2:
            out[token] = parts[0]
    return out


def ascending(ranks: dict[bytes, int], lefts: dict[bytes, bytes]) -> bool:
    """Whether every merged part of a token has a lower rank than the token."""
    return all(len(part) == 1 or ranks[part] < ranks[token] for token, left in lefts.items() for part in (left, token[len(left):]))


def newer_characters(pattern: str) -> str:
    """Letters and numbers of this Unicode version that the library's version does not know yet. It is asked with a
    vocabulary that joins a character's last byte to the letter or digit behind it, if both are one piece."""
    import tiktoken
    tails = {bytes([b]) + c: 256 + 64 * k + b - 0x80 for k, c in enumerate((b"a", b"1")) for b in range(0x80, 0xC0)}
    library = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)} | tails, special_tokens={})
    every = "".join(chr(c) for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn")
    out = []
    for kind, behind in ((r"\p{L}", "a"), (r"\p{N}", "1")):
        found = regex.findall(kind, every)
        out += [c for c, ids in zip(found, library.encode_ordinary_batch([c + behind for c in found], num_threads=1), strict=True) if ids[-1] < 256]
    return "".join(out)


class Splitter:
    """Cuts texts into pieces, and long pieces into words the fold can take. ``newer`` are characters that count as
    neither letter nor number; ``lefts`` are the tokens' ``last_parts``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, newer: str = "", lefts: dict[bytes, bytes] | None = None):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.newer = {ord(c): "\ue000" for c in newer}   # to a character that is neither letter, number nor blank in any version
        self.leads = sorted({c.encode()[:2] for c in newer})
        self.longest = max(map(len, ranks), default=1)
        self.symbols = np.array([ord(symbol(ranks[bytes([b])])) for b in range(256)], np.uint32)
        self.pairs = np.zeros(1 << 16, bool)
        triples = set()
        for token in ranks:
            if len(token) == 2:
                self.pairs[token[0] << 8 | token[1]] = True
            triples.update(token[i:i + 3] for i in range(len(token) - 2))
        self.triples = np.unique(np.array([-1, *(t[0] << 16 | t[1] << 8 | t[2] for t in triples)], np.int64))
        self.prefixes(last_parts(ranks) if lefts is None else lefts)
        self.classes = None
        if pattern == PATTERN:
            self.classes = char_classes()
            self.classes[list(self.newer)] = 3

    def pieces(self, text: str) -> list[str]:
        if not self.newer or text.isascii():
            return self.pattern.findall(text)
        raw = text.encode()
        plain = text.translate(self.newer) if any(lead in raw for lead in self.leads) else text
        if plain == text:
            return self.pattern.findall(text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(plain)]

    def cut(self, texts: list[str]) -> tuple[list[bytes], np.ndarray]:
        """(pieces of all texts, how many each has); by character classes where the pattern is the known one."""
        n = np.array([len(t) for t in texts], np.int64)
        if self.classes is None or n.sum() > 16 * SLICE:  # one very long text
            found = [self.pieces(t) for t in texts]
            return [p.encode() for x in found for p in x], np.array([len(x) for x in found], np.int64)
        text = "".join(texts)
        if not text:
            return [], n
        raw, cps = text.encode(), np.frombuffer(text.encode("utf-32-le"), np.uint32)
        offs = np.concatenate([[0], np.cumsum(n)])
        ends = np.zeros(len(cps) + 1, bool)
        ends[offs] = True
        at = np.flatnonzero(piece_starts(cps, self.classes[cps], ends))
        counts = np.diff(np.searchsorted(at, offs))
        if len(raw) > len(cps):
            width = (cps >= 0x80).astype(np.int64) + (cps >= 0x800) + (cps >= 0x10000) + 1
            at = (np.cumsum(width) - width)[at]
        at = at.tolist()
        return [raw[a:b] for a, b in zip(at, [*at[1:], len(raw)], strict=True)], counts

    def cuts(self, word: bytes) -> list[int]:
        """Offsets that no token can lie across: it would be the pair around the offset, or hold one
        of the two triples around it."""
        b = np.frombuffer(word, np.uint8).astype(np.int64)
        crossed = self.pairs[b[:-1] << 8 | b[1:]]
        triple = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
        held = self.triples[np.minimum(np.searchsorted(self.triples, triple), len(self.triples) - 1)] == triple
        crossed[:-1] |= held
        crossed[1:] |= held
        return (np.flatnonzero(~crossed) + 1).tolist()

    def merged(self, word: bytes) -> list[bytes]:
        """Tokens of a long word: always the leftmost pair of lowest rank, from a heap."""
        n, ranks = len(word), self.ranks
        end, before = list(range(1, n + 1)), list(range(-1, n))  # a symbol starts at i and ends at end[i]
        heap = [(ranks[word[i:i + 2]], i, i + 2) for i in range(n - 1) if word[i:i + 2] in ranks]
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] == n or end[end[i]] != stop:
                continue  # one of the two symbols has been merged since
            alive[end[i]] = 0
            end[i] = stop
            if stop < n:
                before[stop] = i
            for a in (i, before[i]):
                if a >= 0 and end[a] < n:
                    rank = ranks.get(word[a:end[end[a]]])
                    if rank is not None:
                        heapq.heappush(heap, (rank, a, end[end[a]]))
        return [word[i:end[i]] for i in range(n) if alive[i]]

    def prefixes(self, tokens) -> None:
        """A tree of tokens: nodes below 256 are first bytes, ``edges`` are sorted (node, next byte), leading to the
        nodes ``below``, and ``rank`` is a node's token or -1."""
        edges: dict[int, int] = {}
        ends = []
        for token in tokens:
            node = token[0]
            for b in token[1:]:
                node = edges.setdefault(node << 8 | b, 256 + len(edges))
            ends.append(node)
        self.edges, self.below = np.array(sorted(edges.items()) or [(-1, 0)], np.int64).T.copy()
        self.rank = np.full(256 + len(edges), -1, np.int64)
        self.rank[ends] = [self.ranks[token] for token in tokens]

    def merges(self, raw: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ascending ranks of the tokens that each word holds and merges may make, words end to end; how many each has).
        ``raw`` holds the words' bytes end to end."""
        owner = np.repeat(np.arange(len(lens)), lens)
        stop = np.cumsum(lens)[owner]
        at, node, n, found = np.arange(len(raw)), raw.astype(np.int64), 1, [np.zeros(0, np.int64)]
        while len(at):
            inside = np.flatnonzero(at + n < stop[at])
            at, key = at[inside], node[inside] << 8 | raw[at[inside] + n]
            edge = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            known = np.flatnonzero(self.edges[edge] == key)
            at, node, n = at[known], self.below[edge[known]], n + 1
            token = np.flatnonzero(self.rank[node] >= 0)
            found.append(owner[at[token]] << 32 | self.rank[node[token]])
        every = np.sort(np.concatenate(found))
        every = every[np.diff(every, prepend=-1) > 0]
        return (every & 0xFFFFFFFF).astype(np.int32), np.bincount(every >> 32, minlength=len(lens))

    def states(self, words: list[bytes | int]) -> pa.StructArray:
        """The fold's start, word by word: symbols, and ranks of the merges to fold. A number is a finished token."""
        lens = np.array([1 if isinstance(w, int) else len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join([b"\0" if isinstance(w, int) else w for w in words]), np.uint8)
        done = np.array([i for i, w in enumerate(words) if isinstance(w, int)], np.int64)
        ends = np.cumsum(lens)
        codes = self.symbols[raw]
        codes[ends[done] - 1] = [ord(symbol(words[i])) for i in done]
        size = np.concatenate([[0], np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))[ends - 1]])
        text = codes.tobytes().decode("utf-32-le").encode()
        ranks, counts, lo = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
        while lo < len(words):
            begin = ends[lo] - lens[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, begin + SLICE, side="right")))
            found = self.merges(raw[begin:ends[hi - 1]], lens[lo:hi])
            ranks.append(found[0])
            counts.append(found[1])
            lo = hi
        offs = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        return pa.StructArray.from_arrays([
            pa.StringArray.from_buffers(len(words), pa.py_buffer(size.astype(np.int32)), pa.py_buffer(text)),
            pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(np.concatenate(ranks), pa.int32()))], ["sym", "merges"])

    def words(self, piece: bytes) -> list[bytes | int]:
        """One piece, cut into words the fold can take; finished tokens by their rank."""
        rank = self.ranks.get(piece)
        if rank is not None:
            return [rank]
        if len(piece) <= self.longest:
            return [piece]
        out: list[bytes | int] = []
        at = [0, *self.cuts(piece), len(piece)]
        for a, b in zip(at[:-1], at[1:], strict=True):
            if b - a <= LONG:
                out.append(piece[a:b])
            else:
                out += [self.ranks[t] for t in self.merged(piece[a:b])]
        return out

    def chunk(self, texts: list[str]):
        """(words, word numbers of all texts end to end, their offsets)."""
        pieces: defaultdict[bytes, int] = defaultdict()
        pieces.default_factory = pieces.__len__  # a new piece gets the next number
        numbers, counts, lo = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
        ends = np.cumsum([len(t) for t in texts])
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE, side="right")))
            found, each = self.cut(texts[lo:hi])
            numbers.append(np.fromiter(map(pieces.__getitem__, found), np.int32, len(found)))
            counts.append(each)
            lo = hi
        idx, offs = np.concatenate(numbers), np.cumsum(np.concatenate(counts))
        slots: dict[bytes | int, int] = {}
        parts = [[slots.setdefault(w, len(slots)) for w in self.words(p)] for p in pieces]
        counts = np.array([len(p) for p in parts], np.int32)
        flat = np.array([s for p in parts for s in p], np.int32)
        del parts, pieces, numbers
        if len(flat) == len(counts):  # each piece is one word
            return list(slots), flat[idx], offs
        begin, n = np.cumsum(counts, dtype=np.int32) - counts, counts[idx]
        done = np.concatenate([np.zeros(1, np.int32), np.cumsum(n, dtype=np.int32)])  # below 2**31, as in the batch
        at = np.repeat(begin[idx] - done[:-1], n)
        at += np.arange(done[-1], dtype=np.int32)
        return list(slots), flat[at], done[offs]


def symbol(rank: int) -> str:
    """The character that stands for a token; surrogates are left out."""
    code = FIRST + rank
    return chr(code if code < 0xD800 else code + 0x800)


def rank_of_symbol(c: Column, top: int) -> Column:
    """The rank a character stands for, of a vocabulary whose ranks end at ``top``."""
    code = F.ascii(c)
    if FIRST + top < 0xD800:
        return code - FIRST
    return F.when(code < 0xD800, code - FIRST).otherwise(code - (FIRST + 0x800))


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pieces_literal(values: dict[int, str]) -> Column:
    """Constant array with ``values[id]`` at place id."""
    return F.from_json(F.lit(json.dumps([values.get(i) for i in range(max(values, default=-1) + 1)])), "array<string>")


def fold(pairs: Column, symbols: Column, word: Column, single: bool, top: int) -> Column:
    """array<int>: the ids of one word, its merges folded over its symbols by rank. ``single``: one pass
    will do, see above."""
    def join(sym, rank):
        return F.replace(sym, F.get(pairs, rank), F.get(symbols, rank))

    def lowest(sym, _):
        def merge(rank):
            p = F.instr(sym, F.get(pairs, rank))
            return F.when(rank.isNull(), sym).otherwise(
                F.concat(F.substring(sym, F.lit(1), p - 1), F.get(symbols, rank), F.substring(sym, p + 2, F.lit(1 << 30))))
        return bind(F.get(F.filter(word["merges"], lambda r: F.instr(sym, F.get(pairs, r)) > 0), F.lit(0)), merge)

    steps = word["merges"] if single else F.array_repeat(F.lit(0), F.length(word["sym"]) - 1)
    return F.transform(F.split(F.aggregate(steps, word["sym"], join if single else lowest), ""), lambda c: rank_of_symbol(c, top))


def encode(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every whole text."""
    spark = docs.sparkSession
    prepare(spark)
    ranks = load_ranks(vocabulary or default_vocabulary())
    lefts = last_parts(ranks)
    pairs = pieces_literal({ranks[t]: symbol(ranks[left]) + symbol(ranks[t[len(left):]]) for t, left in lefts.items()})
    symbols = pieces_literal({ranks[t]: symbol(ranks[t]) for t in lefts})
    single, top = ascending(ranks, lefts), max(ranks.values(), default=0)
    pattern = pattern or default_pattern()
    shared = spark.sparkContext.broadcast(Splitter(ranks, pattern, newer_characters(pattern), lefts))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"words array<struct<sym:string,merges:array<int>>>, docs array<struct<key:{kind},words:array<int>>>"

    def chunks(batches):
        splitter = shared.value
        keys, texts, held = [], [], 0

        def flush():
            words, idx, offs = splitter.chunk(texts)
            rows = pa.StructArray.from_arrays([pa.concat_arrays(keys), pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(idx, pa.int32()))], ["key", "words"])
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (splitter.states(words), rows)], ["words", "docs"])

        for part in slices(batches, "text", CHUNK):
            if texts and held + part.nbytes > CHUNK:
                out = flush()
                keys, texts, held = [], [], 0
                yield out
                del out
            keys.append(column(part, "key"))
            texts += [t or "" for t in column(part, "text").to_pylist()]
            held += part.nbytes
        if texts:
            yield flush()

    cut = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(lean(chunks), schema)
    ids = F.transform("words", lambda w: fold(pairs, symbols, w, single, top))
    rows = bind(ids, lambda e: F.transform("docs", lambda d: F.struct(
        d["key"].alias("key"), F.flatten(F.transform(d["words"], lambda i: F.get(e, i))).alias("ids"))))
    return cut.select(F.explode(rows).alias("row")).select(F.col("row")["key"].alias(key), F.col("row")["ids"].alias("ids"))


def decode(encoded: DataFrame, vocabulary: str | None = None, out: str = "decoded") -> DataFrame:
    """Adds the bytes that ``ids`` stand for, their pieces joined. An id outside of the vocabulary stands for none."""
    pieces = pieces_literal({rank: token.decode("latin-1") for token, rank in load_ranks(vocabulary or default_vocabulary()).items()})
    return encoded.withColumn(out, F.encode(F.array_join(F.transform("ids", lambda i: F.get(pieces, i)), ""), "ISO-8859-1"))


def packed(ids: Column, size: int) -> Column:
    """Ids below ``size`` as little-endian unsigned 32-bit integers."""
    hexes = pieces_literal({i: i.to_bytes(4, "little").hex() for i in range(size)})
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(hexes, i)), ""))


def digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The query's columns: token count and digests of ids and decoded bytes."""
    size = 1 + max(load_ranks(vocabulary or default_vocabulary()).values())
    out = decode(encode(docs, vocabulary), vocabulary)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(packed(F.col("ids"), size), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
