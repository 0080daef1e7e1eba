"""Language identification by segmentation-marginalised unigrams (operator 9).

Every language has a probability for each piece of a fixed public vocabulary (a SentencePiece
model, opened by its path in the driver). A word (a blank and the characters between white space,
as UTF-8) can be cut into pieces in many ways; the forward algorithm sums the products of piece
probabilities over all of them. Single bytes are pieces too, so every word has a segmentation.
A text's score for a language is the log prior plus the sum over its words. The probabilities
come from expectation-maximisation (forward-backward) on words counted in Spark.

Learning uses about ``SAMPLE_DOCS`` documents per language (all if there are fewer), those whose
hash is below a threshold from the language's count; whole texts, a documented bound. Prediction
covers every text. Defined cases: null text, or text without a letter, is ``und`` with score 0;
with nothing to learn from all are ``und``; null lang is not learned from; repeated documents
count each; ties go to the language that sorts first.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.llm.arrays import (
    BYTE_VALUES,
    LOWER,
    SPACE,
    column,
    crc_mod,
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

SAMPLE_DOCS = 1000
ROUNDS = 3
SMOOTH = 0.5
CACHE_WORDS = 1_000_000
SLOT_SHIFT, MAYBE_MASK = np.uint64(44), np.uint64((1 << 22) - 1)
LONG = 24  # words of more bytes are cut into stretches of this many


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def pieces_of(path: str) -> list[bytes]:
    """The vocabulary's pieces as bytes, word-start mark as a blank, with all single bytes."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            p = model.id_to_piece(i)
            if "▁" not in p[1:]:
                out.add(p.replace("▁", " ").lower().encode())
    return sorted(x for x in out if x)


class Pieces:
    """Look-up of byte substrings in the vocabulary, and forward-backward over many words."""

    def __init__(self, vocabulary: list[bytes]):
        lens = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))
        data = np.frombuffer(b"".join(vocabulary), np.uint8)
        at = np.cumsum(lens) - lens
        h = span_hashes(prefix_hashes(BYTE_VALUES[data]), at, at + lens)
        self.lengths = [int(n) for n in np.unique(lens) if n <= LONG]
        order = np.argsort(h)
        self.hash, self.id = h[order], order.astype(np.int64)
        self.first = np.searchsorted(self.hash >> SLOT_SHIFT, np.arange(1 << 20, dtype=np.uint64))
        self.most = int(np.bincount((self.hash >> SLOT_SHIFT).astype(np.int64)).max())
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(h & MAYBE_MASK).astype(np.int64)] = True
        self.n = len(vocabulary)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where, piece number) of the hashes that are pieces."""
        where = np.flatnonzero(self.maybe[(h & MAYBE_MASK).astype(np.int64)])
        h = h[where]
        at = self.first[(h >> SLOT_SHIFT).astype(np.int64)]
        out = np.full(len(h), -1, np.int64)
        for k in range(self.most):
            i = np.minimum(at + k, self.n - 1)
            out = np.where(self.hash[i] == h, self.id[i], out)
        ok = out >= 0
        return where[ok], out[ok]

    def lattice(self, low, start, stop, first):
        """All places of pieces in the words. Word w has a node before each byte and one at its end;
        returns (first node, last node, from, to, piece, cuts), edges ordered by (offset in the
        word, size), so that edges between two cuts end at different nodes."""
        size = stop - start + first
        text = np.full(int(size.sum()), 0x20, np.uint8)
        begin = np.cumsum(size) - size
        text[ranges(begin + first, stop - start)] = low[ranges(start, stop - start)]
        word = np.repeat(np.arange(len(size)), size)
        prefix = prefix_hashes(BYTE_VALUES[text])
        inverse = powers(len(prefix))[1]
        offset = np.arange(len(text)) - begin[word]
        left = size[word] - offset  # bytes to the end of the word
        parts = []
        for k, n in enumerate(self.lengths):
            at = np.flatnonzero(left >= n)
            if not len(at):
                break
            where, piece = self.find(mix((prefix[at + n] - prefix[at]) * inverse[at]))
            at = at[where]
            parts.append((at + word[at], piece, np.full(len(at), n), ((offset[at] + n) * 32 + k).astype(np.uint16)))
        source, piece, n, key = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 4
        order = np.argsort(key, kind="stable")
        source, piece, n, key = source[order], piece[order], n[order], key[order]
        node = begin + np.arange(len(size))
        cuts = np.concatenate([np.flatnonzero(np.diff(key.astype(np.int64), prepend=-1)), [len(key)]]).tolist()
        return node, node + size, source, source + n, piece, cuts

    def forward(self, lattice, prob: np.ndarray) -> np.ndarray:
        """Sums over segmentations at every node; prob is [edges x languages]."""
        node, last, source, to, _, cuts = lattice
        alpha = np.zeros((int(last[-1]) + 1 if len(last) else 0, prob.shape[1]))
        alpha[node] = 1
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            alpha[to[a:b]] += alpha[source[a:b]] * prob[a:b]
        return alpha


def chunk_words(data: np.ndarray, offs: np.ndarray):
    """Words as byte spans with their document; long words are cut into stretches of LONG bytes."""
    low = LOWER[data]
    start, stop = spans(~SPACE[low], offs)
    n = stop - start
    if len(n) and n.max() > LONG:
        parts = -(-n // LONG)
        begin = ranges(np.zeros(len(n)), parts) * LONG + np.repeat(start, parts)
        stop = np.minimum(begin + LONG, np.repeat(stop, parts))
        first = ranges(np.zeros(len(n)), parts) == 0
        start = begin
    else:
        first = np.ones(len(start), bool)
    return low, start, stop, first, owners(offs, start)


def word_rows(low: np.ndarray, start: np.ndarray, stop: np.ndarray, first: np.ndarray):
    """Word keys: hashes of the bytes, another for stretches that do not start a word."""
    h = span_hashes(prefix_hashes(BYTE_VALUES[low]), start, stop)
    return np.where(first, h, ~h)


class Model:
    """Languages, their log priors and piece probabilities."""

    def __init__(self, languages: list[str], prior: np.ndarray, prob: np.ndarray, pieces: Pieces):
        self.languages, self.prior, self.prob, self.pieces = languages, prior, prob, pieces
        self.clear()

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.table = np.zeros((0, len(self.languages)))

    def __getstate__(self):
        return {"languages": self.languages, "prior": self.prior, "prob": self.prob, "pieces": self.pieces}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.clear()

    def log_probability(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """[documents x languages], without the prior."""
        if len(self.table) > CACHE_WORDS:
            self.clear()
        n_docs = len(offs) - 1
        low, start, stop, first, doc = chunk_words(data, offs)
        if not len(start):
            return np.zeros((n_docs, len(self.languages)))
        key, where, inverse = np.unique(word_rows(low, start, stop, first), return_index=True, return_inverse=True)
        names = key.tolist()
        slots = np.fromiter(map(self.slot.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(slots < 0)
        if len(new):
            w = where[new]
            found = self.pieces.lattice(low, start[w], stop[w], first[w])
            fresh = np.log(self.pieces.forward(found, self.prob[found[4]])[found[1]])
            slots[new] = len(self.table) + np.arange(len(new))
            self.slot.update(zip([names[i] for i in new], slots[new].tolist(), strict=True))
            self.table = np.concatenate([self.table, fresh])
        per_word = self.table[slots][inverse]
        return np.stack([np.bincount(doc, per_word[:, k], n_docs) for k in range(len(self.languages))], axis=1)

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        data, offs = text_bytes(texts)
        total = self.log_probability(data, offs) + self.prior
        best = total.argmax(axis=1)
        p = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        letters = has_letter(data, offs)
        return ([self.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)],
                [float(x) if ok else 0.0 for x, ok in zip(p, letters, strict=True)])


def has_letter(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    low = LOWER[data]
    ascii_ = np.concatenate([[0], np.cumsum((low >= 0x61) & (low <= 0x7A))])
    out = ascii_[offs[1:]] > ascii_[offs[:-1]]
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in data[offs[i]:offs[i + 1]].tobytes().decode("utf-8"))
    return out


def fit(docs: DataFrame, *, modulus: int = 4, held: int = 2, vocabulary: str | None = None, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS) -> Model:
    """Model learned from documents outside the held-out fold."""
    spark = docs.sparkSession
    prepare(spark)
    pieces = Pieces(pieces_of(vocabulary or default_vocabulary()))
    taught = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod("doc_id", modulus) != held))
    counts = sorted((r[0], r[1]) for r in taught.groupBy("lang").count().collect())  # one row per language
    languages = [c[0] for c in counts]
    if not languages:
        return Model([], np.zeros(0), np.zeros((pieces.n, 0)), pieces)
    share = F.create_map(*[F.lit(x) for lang, n in counts for x in (lang, min(1.0, sample_docs / n))])
    # a hash of the id and the text in [0, 1): the same documents whatever the partitions
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = taught.where(place < share[F.col("lang")])

    def words(batches):
        for part in slices(batches, "text"):
            low, start, stop, first, doc = chunk_words(*text_bytes(column(part, "text")))
            names = column(part, "lang").to_pylist()
            lang = np.array([languages.index(x) for x in names], np.int64)[doc] if len(doc) else doc
            key = mix(word_rows(low, start, stop, first) + lang.astype(np.uint64))
            _, at, count = np.unique(key, return_index=True, return_counts=True)
            raw = low.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang[at], pa.int32()), pa.array(first[at]), pa.array([raw[start[i]:stop[i]] for i in at], pa.binary()), pa.array(count, pa.int64())],
                ["lang", "first", "word", "n"])

    counted = materialize(sample.mapInArrow(words, "lang int, first boolean, word binary, n bigint")
                          .groupBy("lang", "first", "word").agg(F.sum("n").alias("n")), "langid")
    prob = np.full((pieces.n, len(languages)), 1 / pieces.n)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((pieces, prob))

        def expect(batches, shared=shared):
            known, now = shared.value
            total = np.zeros(now.shape)
            for batch in batches:
                low, offs = text_bytes(column(batch, "word"))
                first = column(batch, "first").to_numpy(zero_copy_only=False)
                lang, n = column(batch, "lang").to_numpy(), column(batch, "n").to_numpy()
                found = known.lattice(low, offs[:-1], offs[1:], first)
                node, last, source, to, piece, cuts = found
                word = np.searchsorted(node, source, side="right") - 1
                p = now[piece, lang[word]]
                alpha = known.forward(found, p[:, None])[:, 0]
                beta = np.zeros(len(alpha))
                beta[last] = n / alpha[last]
                for a, b in zip(cuts[-2::-1], cuts[:0:-1], strict=True):  # from the ends back
                    np.add.at(beta, source[a:b], p[a:b] * beta[to[a:b]])
                np.add.at(total, (piece, lang[word]), alpha[source] * p * beta[to])
            piece, k = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(k, pa.int32()), pa.array(total[piece, k])], ["piece", "lang", "n"])

        got = counted.mapInArrow(expect, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow()
        soft = np.full((pieces.n, len(languages)), SMOOTH)
        soft[got["piece"].to_numpy(), got["lang"].to_numpy()] += got["n"].to_numpy()
        prob = soft / soft.sum(axis=0)
    prior = np.log(np.array([c[1] for c in counts], float) / sum(c[1] for c in counts))
    return Model(languages, prior, prob, pieces)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in slices(batches, "text", 1 << 20):
            lang, score = shared.value.predict(column(part, "text"))
            yield pa.RecordBatch.from_arrays([column(part, "doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def digests(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    return predict(docs, fit(docs)).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
