"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks (operator 8).

Every pre-token is a row of symbols. A segment tree holds, at leaf p, the rank of the pair that
starts at symbol p (with p in the low bits), so its root is the leftmost pair of lowest rank.
A merge changes three leaves (the pair itself, the one before, the one swallowed) and their
ancestors, so it costs logarithmic time; merging stops when the root holds no pair. Many rows of
one padded width are merged at once as numpy arrays; very long rows use the same tree on lists.

The vocabulary file is opened by the path given, in the driver, and broadcast (its size is fixed
by the vocabulary, about 2 MB). Defined cases: null text encodes as the empty text; the empty
text has no ids; added tokens in a text (``<|endoftext|>``) become their own id; repeated rows
are encoded each.
"""

from __future__ import annotations

import json
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.llm.arrays import (
    column,
    lean,
    prepare,
    ranges,
    slices,
    text_bytes,
    word_hashes,
)

#: The split pattern of this vocabulary (fixed value, as its README gives it).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NONE = np.int64(1 << 62)
POS_BITS = 24
WIDE = 128  # pre-tokens with more bytes use the tree on lists
CACHE_WORDS = 250_000  # pre-tokens kept within a task, about 100 bytes each


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[int, str]:
    """Byte -> printable character: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = {}, 0x100
    for b in range(256):
        out[b] = chr(b if b in own else extra)
        extra += b not in own
    return out


def load_vocabulary(path: str) -> dict:
    """Arrays of a byte-level BPE file: sorted pair keys with rank and result, and each id's bytes."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, alphabet = spec["model"], byte_alphabet()
    back = {c: b for b, c in alphabet.items()}
    vocab: dict[str, int] = model["vocab"]
    added = {a["content"]: a["id"] for a in spec["added_tokens"]}
    size = max([*vocab.values(), *added.values()]) + 1
    token = [b""] * size
    for text, i in vocab.items():
        token[i] = bytes(back[c] for c in text)
    for text, i in added.items():
        token[i] = text.encode()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
    order = np.argsort(keys, kind="stable")
    return {"size": size, "added": added, "single": np.array([vocab[alphabet[b]] for b in range(256)], np.int64),
            "keys": keys[order], "ranks": order.astype(np.int64),
            "result": np.array([vocab[a + b] for a, b in pairs], np.int64),
            "bytes": np.frombuffer(b"".join(token), np.uint8), "ends": np.cumsum([len(t) for t in token])}


def char_classes() -> np.ndarray:
    """Class of every code point: 0 white space, 1 letter, 2 number, 3 other."""
    import regex
    out = np.full(0x110000, 3, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind, pattern in ((0, r"\s"), (1, r"\p{L}"), (2, r"\p{N}")):
        out[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return out


def piece_starts(cps: np.ndarray, cls: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Mask of the code points at which PATTERN starts a piece. ``cut`` marks where texts start."""
    n = len(cps)
    first = cut[:n].copy()
    first[1:] |= cls[1:] != cls[:-1]
    start = first.copy()
    # a run of white space before other text gives its last character away: a blank joins the next piece
    after = np.flatnonzero(first[1:] & ~cut[1:n] & (cls[:-1] == 0)) + 1
    start[after - 1] = True
    start[after[cps[after - 1] == 0x20]] = False
    # an apostrophe that starts a piece takes a contraction's letters with it
    at = np.flatnonzero((cps == 0x27) & start)
    at = at[(at + 1 < n)]
    at = at[~cut[at + 1] & (cls[at + 1] == 1)]
    c1 = cps[at + 1]
    nxt = np.minimum(at + 2, n - 1)
    c2 = np.where((at + 2 < n) & ~cut[nxt], cps[nxt], 0)
    took = np.where(np.isin(c1, [ord(c) for c in "stmd"]), 1, 0)
    for pair in ("re", "ve", "ll"):
        took = np.where((c1 == ord(pair[0])) & (c2 == ord(pair[1])), 2, took)
    at, took = at[took > 0], took[took > 0]
    start[at + 1] = False
    rest = at + 1 + took
    rest = rest[rest < n]
    rest = rest[~cut[rest] & (cls[rest] == 1)]
    start[rest] = True
    return start


class Codec:
    """Encoder and decoder of one vocabulary, with a bounded cache of encoded pre-tokens. Within a
    chunk and the cache a pre-token is known by its 64-bit hash."""

    def __init__(self, vocabulary: dict):
        self.v = vocabulary
        self.classes = char_classes()
        added = sorted(vocabulary["added"], key=len, reverse=True)
        self.added = re.compile(b"|".join(re.escape(a.encode()) for a in added)) if added else None
        lens = np.diff(vocabulary["ends"], prepend=0)
        self.token_start, self.token_len = vocabulary["ends"] - lens, lens
        self.clear()

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        ids = sorted(self.v["added"].values())
        self.added_slot = {i: k for k, i in enumerate(ids)}
        self.flat = np.array(ids, np.int32)
        self.counts = np.ones(len(ids), np.int64)

    def pair_leaves(self, left, right, pos):
        """Leaf values of the pairs (left, right) at pos; NONE where they cannot merge."""
        v = self.v
        key = left * v["size"] + right
        at = np.minimum(np.searchsorted(v["keys"], key), len(v["keys"]) - 1)
        ok = (left >= 0) & (right >= 0) & (v["keys"][at] == key)
        return np.where(ok, (v["ranks"][at] << POS_BITS) | pos, NONE)

    def merge_rows(self, sym: np.ndarray) -> np.ndarray:
        """Merge rows of symbols (-1: none), all of one power-of-two width; dead symbols become -1."""
        n, width = sym.shape
        pos = np.arange(width, dtype=np.int64)
        nxt = np.tile(pos + 1, (n, 1))
        prv = np.tile(pos - 1, (n, 1))
        right = np.concatenate([sym[:, 1:], np.full((n, 1), -1)], axis=1)
        tree = np.full((n, 2 * width), NONE)
        tree[:, width:] = self.pair_leaves(sym, right, pos)
        half = width
        while half > 1:
            half //= 2
            tree[:, half:2 * half] = np.minimum(tree[:, 2 * half:4 * half:2], tree[:, 2 * half + 1:4 * half:2])
        sym = np.concatenate([sym, np.full((n, 1), -1)], axis=1)  # column ``width``: past the end
        rows = np.flatnonzero(tree[:, 1] != NONE)
        while len(rows):
            root = tree[rows, 1]
            p, rank = root & ((1 << POS_BITS) - 1), root >> POS_BITS
            sym[rows, p] = self.v["result"][rank]
            q = nxt[rows, p]
            after = np.where(q < width, nxt[rows, np.minimum(q, width - 1)], width)
            nxt[rows, p] = after
            ok = after < width
            prv[rows[ok], after[ok]] = p[ok]
            sym[rows, q] = -1
            before = prv[rows, p]
            has = before >= 0
            left = np.maximum(before, 0)
            tree[rows, width + q] = NONE
            tree[rows, width + p] = self.pair_leaves(sym[rows, p], sym[rows, after], p)
            tree[rows[has], width + left[has]] = self.pair_leaves(sym[rows[has], left[has]], sym[rows[has], p[has]], left[has])
            for leaf in (q, p, np.where(has, left, p)):
                node = (width + leaf) >> 1
                while node[0] >= 1:
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                    node = node >> 1
            rows = rows[tree[rows, 1] != NONE]
        return sym[:, :width]

    def merge_long(self, word: np.ndarray) -> np.ndarray:
        """The same tree on lists, for one long pre-token."""
        if not hasattr(self, "pairs"):
            self.pairs = dict(zip(self.v["keys"].tolist(), self.v["ranks"].tolist(), strict=True))
        size, rank_of, result = self.v["size"], self.pairs, self.v["result"]
        sym = self.v["single"][word].tolist()
        n = len(sym)
        width = 1 << max(1, (n - 1).bit_length())
        none = int(NONE)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * width)

        def leaf(p, q):
            r = rank_of.get(sym[p] * size + sym[q])
            return none if r is None else (r << 40) | p
        for p in range(n - 1):
            tree[width + p] = leaf(p, p + 1)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] != none:
            p, rank = tree[1] & ((1 << 40) - 1), tree[1] >> 40
            q = nxt[p]
            r = nxt[q]
            sym[p], sym[q], nxt[p] = int(result[rank]), -1, r
            if r < n:
                prv[r] = p
            changed = [(q, none), (p, leaf(p, r) if r < n else none)]
            if prv[p] >= 0:
                changed.append((prv[p], leaf(prv[p], p)))
            for at, value in changed:
                node = width + at
                tree[node] = value
                while node > 1:
                    node >>= 1
                    tree[node] = min(tree[2 * node], tree[2 * node + 1])
        return np.array([s for s in sym if s >= 0], np.int32)

    def learn(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray, keys: list[int]) -> None:
        """Encode pre-tokens (byte spans of data) that are not in the cache yet."""
        width = np.where(lens > WIDE, 0, 1 << np.ceil(np.log2(np.maximum(lens, 2))).astype(np.int64))
        base, flat, counts = len(self.counts), [self.flat], [self.counts]
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            step = max(1, (1 << 18) // int(w)) if w else 1  # bounded work arrays
            for lo in range(0, len(at), step):
                part = at[lo:lo + step]
                if w:
                    n = lens[part]
                    sym = np.full((len(part), int(w)), -1, np.int64)
                    sym[np.repeat(np.arange(len(part)), n), ranges(np.zeros(len(part)), n)] = self.v["single"][data[ranges(starts[part], n)]]
                    sym = self.merge_rows(sym)
                    keep = sym >= 0
                    flat.append(sym[keep].astype(np.int32))
                    counts.append(keep.sum(axis=1))
                else:
                    i = part[0]
                    flat.append(self.merge_long(data[starts[i]:starts[i] + lens[i]]))
                    counts.append(np.array([len(flat[-1])], np.int64))
                self.slot.update(zip([keys[i] for i in part], range(base, base + len(part)), strict=True))
                base += len(part)
        self.flat, self.counts = np.concatenate(flat), np.concatenate(counts)

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and their offsets. The texts are UTF-8, end to end."""
        if len(self.counts) > CACHE_WORDS:
            self.clear()
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
        raw = data.tobytes()
        cps = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        width = 1 + (cps >= 0x80).astype(np.int64) + (cps >= 0x800) + (cps >= 0x10000)
        byte_at = np.concatenate([[0], np.cumsum(width)])
        special = [(m.start(), m.end(), self.v["added"][m[0].decode()]) for a, b in zip(offs[:-1], offs[1:], strict=True)
                   for m in self.added.finditer(raw, a, b)] if self.added and self.added.search(raw) else []
        cut = np.zeros(len(cps) + 1, bool)
        cut[np.searchsorted(byte_at, np.concatenate([offs, *([x[0], x[1]] for x in special)]).astype(np.int64))] = True
        start = piece_starts(cps, self.classes[cps], cut)
        for a, b, _ in special:
            lo, hi = np.searchsorted(byte_at, [a, b])
            start[lo + 1:hi] = False
        at = byte_at[np.flatnonzero(start)]
        ends = np.append(at[1:], len(data))
        hashes = word_hashes(data, at, ends)
        uniq, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        keys = uniq.tolist()
        slots = np.fromiter(map(self.slot.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(slots < 0)
        if len(new):
            self.learn(data, at[where[new]], (ends - at)[where[new]], [keys[i] for i in new])
            slots[new] = np.fromiter((self.slot[keys[i]] for i in new), np.int64, len(new))
        words = slots[inverse]
        for a, _, i in special:
            words[np.searchsorted(at, a)] = self.added_slot[i]
        begin = np.cumsum(self.counts) - self.counts
        n = self.counts[words]
        ids = self.flat[ranges(begin[words], n)]
        done = np.concatenate([[0], np.cumsum(n)])
        return ids, done[np.searchsorted(at, offs)]

    def decode(self, ids: np.ndarray, offs: np.ndarray) -> list[str]:
        """Texts of id sequences laid end to end; bytes that are not UTF-8 become U+FFFD."""
        lens = self.token_len[ids]
        data = self.v["bytes"][ranges(self.token_start[ids], lens)].tobytes()
        at = np.concatenate([[0], np.cumsum(lens)])[offs].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)]


_CODECS: dict[int, Codec] = {}


def codec(shared) -> Codec:
    """One codec per worker process and broadcast vocabulary."""
    key = id(shared.value)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(shared.value)
    return _CODECS[key]


def encode_decode(docs: DataFrame, vocabulary: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>, decoded string) of every whole text; ``decoded`` is decoded from ``ids``."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(load_vocabulary(vocabulary or default_vocabulary()))

    def run(batches):
        c = codec(shared)
        for part in slices(batches, "text", 1 << 20):
            ids, offs = c.encode(*text_bytes(column(part, "text")))
            yield pa.RecordBatch.from_arrays(
                [column(part, "key"), pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(ids, pa.int32())),
                 pa.array(c.decode(ids, offs), pa.string())], ["key", "ids", "decoded"])
        c.clear()   # a reused worker keeps nothing but the vocabulary

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        lean(run), f"key {kind}, ids array<int>, decoded string").withColumnRenamed("key", key)


def digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The query's columns: token count and digests of ids and decoded text."""
    out = encode_decode(docs, vocabulary)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.concat_ws(",", "ids"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
