"""Substring deduplication over words by seed and extend (operator 7).

Seeds are winnowed anchors: documents meet on the hash of the smallest 8-word gram in each window
of 50 words. From a seed the match is extended word by word to both sides, for all occurrences of
the seed together: after t steps two occurrences are in one class if their t words on that side
agree. A window around the seed repeats where both its left and its right class agree with an
occurrence in a smaller document; runs of such windows are the maximal repeats over the length
threshold. Occurrences that agree on the whole segment are settled by its hash beforehand (see
``anchors``). Words are compared by 64-bit hashes.

Result: every word covered by a window of 50 words whose words also start in a document with a
smaller doc_id goes. Defined cases: null text has no words; texts shorter than a window lose
nothing; repeats within one document, or between rows of one doc_id, stay, also where those rows
differ in text; rows with a null doc_id are kept whole and match nothing (no id is smaller).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.llm.anchors import Rows, Rule, covered, window_classes_by_hash, with_ranges
from hazelake.llm.arrays import (
    SPACE,
    column,
    lean,
    owners,
    ranges,
    slices,
    spans,
    text_bytes,
    word_hashes,
)

WINDOW = 50
GRAM = 8


def word_spans(data: np.ndarray, offs: np.ndarray):
    start, stop = spans(~SPACE[data], offs)
    count = np.bincount(owners(offs, start), minlength=len(offs) - 1) if len(start) else np.zeros(len(offs) - 1, np.int64)
    return start, stop, np.concatenate([[0], np.cumsum(count)])


def word_symbols(data: np.ndarray, offs: np.ndarray):
    start, stop, by_doc = word_spans(data, offs)
    h = word_hashes(data, start, stop) | np.uint64(1)
    return h, h, by_doc


def _refined(label: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Classes of equal (label, word)."""
    _, word = np.unique(word, return_inverse=True)
    _, out = np.unique(label * (word.max() + 1 if len(word) else 1) + word, return_inverse=True)
    return out


def extended_classes(rows: Rows, window: int, gram: int = GRAM):
    """Classes of equal windows, by extending all seeds of a block to both sides."""
    n_rows = len(rows.n)
    reach = window - gram
    left = np.full((reach + 1, n_rows), -1, np.int64)
    right = np.full((reach + 1, n_rows), -1, np.int64)
    left[0] = right[0] = rows.group
    for t in range(1, reach + 1):
        has = np.flatnonzero(rows.anchor >= t)
        left[t, has] = _refined(left[t - 1, has], rows.symbols[rows.begin[has] + rows.anchor[has] - t])
        has = np.flatnonzero(rows.anchor + gram + t <= rows.size)
        right[t, has] = _refined(right[t - 1, has], rows.symbols[rows.begin[has] + rows.anchor[has] + gram + t - 1])
    row, at, offset = window_classes_by_hash(rows, window)
    key = (left[offset, row] * (n_rows + 1) + right[reach - offset, row]) * (reach + 1) + offset
    _, label = np.unique(key, return_inverse=True)
    return row, at, label


RULE = Rule(WINDOW, GRAM, word_symbols, np.uint64, extended_classes, False)


def repeated_words(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) of every document: spans are the maximal removed
    word ranges, kept the remaining words joined by single blanks."""
    joined = with_ranges(docs, rule)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
        for part in slices(batches, "text"):
            data, offs = text_bytes(column(part, "text"))
            start, stop, by_doc = word_spans(data, offs)
            gone = covered(column(part, "ranges"), by_doc)
            a, b = spans(gone, by_doc)
            cut = np.searchsorted(a, by_doc)
            doc = np.repeat(np.arange(part.num_rows), np.diff(cut))
            removed = np.concatenate([[0], np.cumsum(gone)])[by_doc]
            # kept words with a blank after each; the last blank of a document is left out below
            s, n = start[~gone], (stop - start)[~gone]
            body = np.full(int(n.sum()) + len(n), 0x20, np.uint8)
            body[ranges(np.cumsum(n + 1) - (n + 1), n)] = data[ranges(s, n)]
            body = body.tobytes()
            at = np.concatenate([[0], np.cumsum(n + 1)])[by_doc - removed].tolist()
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.array(np.diff(by_doc)), pa.array(np.diff(removed)),
                 pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays([pa.array(a - by_doc[doc]), pa.array(b - by_doc[doc])], fields=list(span))),
                 pa.array([body[x:max(x, y - 1)].decode() for x, y in zip(at[:-1], at[1:], strict=True)], pa.string())], ["doc_id", "n_words", "n_removed", "spans", "kept"])

    return joined.mapInArrow(lean(run), f"doc_id {kind}, n_words bigint, n_removed bigint, spans array<struct<start:bigint,stop:bigint>>, kept string")


def digests(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    return repeated_words(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
