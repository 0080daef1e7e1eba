"""Quality classifier: a factorisation machine (operator 2).

Inputs of a score are hashed words (shares of the text, ``BUCKETS`` of them), structure
statistics of the text (``STATS``) and the metadata column n_chars if there is one; never labels,
lang, source or doc_id. A score takes time linear in the inputs: the pairwise part is
``1/2 * sum_f((sum_j v_jf x_j)**2 - sum_j v_jf**2 x_j**2)``.

Learning uses at most ``SAMPLE_ROWS`` labelled rows (those with the smallest hash of doc_id, a
documented bound; 4096 buckets bound the size of a row as well); every row is scored over its
whole text. Defined cases: null text is empty and scored from its statistics; null labels are
not learned from; a label row without document, or a document without label, teaches nothing;
with labels of one class only, or none, every score is the smoothed share of label 1; repeated
documents are scored each, and learned from once.
"""

from __future__ import annotations

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

BUCKETS = 4096
SAMPLE_ROWS = 6000
RANK = 8
EPOCHS = 12
STATS = ("log_bytes", "log_words", "mean_word", "upper", "digits", "symbols", "non_ascii", "distinct", "top_share", "same_as_next",
         "end_symbol", "long_words", "log_lines", "distinct_lines", "mean_line", "no_text", "log_n_chars", "no_n_chars")

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_PROSE = np.zeros(256, bool)
_PROSE[[ord(c) for c in ".,;:'\"()-!?"]] = True


def _per_doc(at: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, minlength=n).astype(np.float64)


def features(data: np.ndarray, offs: np.ndarray, n_chars: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Statistics [documents x STATS]; and the hashed words as (document, bucket, value)."""
    n = len(offs) - 1
    size = np.diff(offs).astype(np.float64)
    safe = np.maximum(size, 1)

    def share(table):
        total = np.concatenate([[0], np.cumsum(table[data])])
        return (total[offs[1:]] - total[offs[:-1]]) / safe
    start, stop = spans(~SPACE[data], offs)
    doc = owners(offs, start)
    words = _per_doc(doc, n)
    many = np.maximum(words, 1)
    hashes = span_hashes(prefix_hashes(BYTE_VALUES[LOWER[data]]), start, stop)
    bucket = (hashes % np.uint64(BUCKETS)).astype(np.int64)
    pair, count = np.unique(doc * BUCKETS + bucket, return_counts=True)
    row, word = pair // BUCKETS, pair % BUCKETS
    top = np.zeros(n)
    np.maximum.at(top, row, count)
    same = np.zeros(len(start), bool)
    if len(start) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    last = data[stop - 1] if len(stop) else np.zeros(0, np.uint8)
    odd_end = _SYMBOL[last] & ~_PROSE[last]
    line_start, line_stop = spans(data != 0x0A, offs)
    line_doc = owners(offs, line_start)
    lines = _per_doc(line_doc, n)
    line_hash = span_hashes(prefix_hashes(BYTE_VALUES[data]), line_start, line_stop)
    order = np.lexsort((line_hash, line_doc))
    fresh = np.ones(len(order), bool)
    if len(order):
        fresh[1:] = (line_hash[order][1:] != line_hash[order][:-1]) | (line_doc[order][1:] != line_doc[order][:-1])
    n_chars = np.full(n, np.nan) if n_chars is None else n_chars
    stats = np.stack([
        np.log1p(size), np.log1p(words), size / many, share(_UPPER), share(_DIGIT), share(_SYMBOL & ~_PROSE), share(np.arange(256) >= 0x80),
        _per_doc(row, n) / many, top / many, _per_doc(doc[same], n) / many, _per_doc(doc[odd_end], n) / many, _per_doc(doc[stop - start > 20], n) / many,
        np.log1p(lines), _per_doc(line_doc[order][fresh], n) / np.maximum(lines, 1), np.log1p(size / np.maximum(lines, 1)), (words == 0).astype(float),
        np.log1p(np.maximum(np.nan_to_num(n_chars), 0)), np.isnan(n_chars).astype(float)], axis=1)
    return stats, row, word, np.sqrt(count / many[row])


class Machine:
    """Factorisation machine over [STATS, hashed words]; fitted with Adam on the logistic loss."""

    def __init__(self, prior: float = 0.5):
        d = len(STATS) + BUCKETS
        rng = np.random.default_rng(7)
        self.bias = float(np.log(prior / (1 - prior)))
        self.weight = np.zeros(d)
        self.factor = rng.normal(0, 0.02, (d, RANK))
        self.centre, self.scale = np.zeros(len(STATS)), np.ones(len(STATS))
        self.fitted = False

    def inputs(self, stats, row, word, value):
        """Sparse inputs (row, column, value), rows ascending."""
        n = len(stats)
        z = np.clip((stats - self.centre) / self.scale, -6, 6)
        r = np.concatenate([np.repeat(np.arange(n), len(STATS)), row])
        c = np.concatenate([np.tile(np.arange(len(STATS)), n), word + len(STATS)])
        x = np.concatenate([z.ravel(), value])
        order = np.argsort(r, kind="stable")
        return r[order], c[order], x[order]

    def raw(self, r, c, x):
        """Margin of every row, and the factor sums that the gradient needs. Every row has inputs."""
        first = np.flatnonzero(np.diff(r, prepend=-1))
        vx = self.factor[c] * x[:, None]
        sums = np.add.reduceat(vx, first, axis=0)
        pairs = 0.5 * (sums ** 2 - np.add.reduceat(vx ** 2, first, axis=0)).sum(axis=1)
        return self.bias + np.add.reduceat(self.weight[c] * x, first) + pairs, sums, vx

    def score(self, stats, row, word, value) -> np.ndarray:
        if not len(stats):
            return np.zeros(0)
        margin = self.raw(*self.inputs(stats, row, word, value))[0] if self.fitted else np.full(len(stats), self.bias)
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))

    def fit(self, stats, row, word, value, label) -> Machine:
        self.centre, self.scale = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6)
        r, c, x = self.inputs(stats, row, word, value)
        bounds = np.searchsorted(r, np.arange(len(label) + 1))
        rng = np.random.default_rng(11)
        moments = [np.zeros_like(a) for a in (self.weight, self.weight, self.factor, self.factor)]
        step, self.fitted = 0, True
        for _ in range(EPOCHS):
            order = rng.permutation(len(label))
            for lo in range(0, len(order), 128):
                take = np.sort(order[lo:lo + 128])
                at = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in take])
                rr, cc, xx = np.searchsorted(take, r[at]), c[at], x[at]
                margin, sums, vx = self.raw(rr, cc, xx)
                err = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - label[take]) / len(take)
                gx = err[rr] * xx
                gw = np.bincount(cc, gx, len(self.weight)) + 1e-4 * self.weight
                gv = 1e-4 * self.factor
                np.add.at(gv, cc, gx[:, None] * (sums[rr] - vx))
                step += 1
                self.bias -= 0.02 * err.sum()
                for par, g, k in ((self.weight, gw, 0), (self.factor, gv, 2)):
                    m, v = moments[k], moments[k + 1]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    par -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        return self


def _n_chars(part) -> np.ndarray | None:
    if "n_chars" not in part.schema.names:
        return None
    col = column(part, "n_chars")
    if not (pa.types.is_integer(col.type) or pa.types.is_floating(col.type)):
        return None
    return col.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)


def fit(docs: DataFrame, labels: DataFrame, *, modulus: int = 3, held: int = 1, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Machine fitted on a bounded sample of the labelled documents outside the held-out fold."""
    prepare(docs.sparkSession)
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (crc_mod("doc_id", modulus) != held))
            .select("doc_id", F.col("quality").cast("double").alias("label"))
            .groupBy("doc_id").agg(F.max("label").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    meta = ["n_chars"] if "n_chars" in docs.columns else []
    taught = docs.select("doc_id", F.col("text").cast("string").alias("text"), *meta).join(F.broadcast(rows), "doc_id")

    def run(batches):
        for part in slices(batches, "text"):
            stats, row, word, value = features(*text_bytes(column(part, "text")), _n_chars(part))
            ends = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), column(part, "label"), pa.array(list(stats), pa.list_(pa.float64())),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(word, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(value, pa.float32()))], ["doc_id", "label", "stats", "words", "shares"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = taught.mapInArrow(lean(run), f"doc_id {kind}, label double, stats array<double>, words array<int>, shares array<float>")
    table = got.toArrow().to_pylist()
    one = {str(r["doc_id"]): r for r in sorted(table, key=lambda r: (str(r["doc_id"]), r["stats"]))}
    table = [one[k] for k in sorted(one)]
    label = np.array([r["label"] for r in table])
    machine = Machine((label.sum() + 1) / (len(label) + 2) if len(label) else 0.5)
    if len(set(label.tolist())) < 2:
        return machine
    n = [len(r["words"]) for r in table]
    return machine.fit(np.array([r["stats"] for r in table]), np.repeat(np.arange(len(table)), n),
                       np.concatenate([r["words"] for r in table]).astype(np.int64), np.concatenate([r["shares"] for r in table]), label)


def score(docs: DataFrame, machine: Machine, out: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` and the score ``out`` (0 to 1); a column of that name is replaced."""
    prepare(docs.sparkSession)
    docs = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    names = docs.columns

    def run(batches):
        for part in slices(batches, "text"):
            s = shared.value.score(*features(*text_bytes(column(part, "text")), _n_chars(part)))
            yield pa.RecordBatch.from_arrays([*[column(part, c) for c in names], pa.array(s, pa.float64())], [*names, out])

    from pyspark.sql import types as T
    return docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def digests(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's columns."""
    meta = ["n_chars"] if "n_chars" in docs.columns else []
    got = score(docs.select("doc_id", "text", *meta), fit(docs, labels))
    return got.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), F.col("quality_score").alias("score"),
                      (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


def drop_low(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with their columns as they were."""
    out, = unused(docs.columns, "quality_score")
    return score(docs, fit(docs, labels), out).where(F.col(out) >= 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])
