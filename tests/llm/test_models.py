import math
import random
import tracemalloc

import numpy as np
from llm import helpers as H

from hazelake.llm import ann, langid, lm, quality


def prose(rnd, junk=False):
    words = [rnd.choice("the of and stone river light under walks home green".split()) for _ in range(rnd.randint(20, 90))]
    return " ".join(w + "###" for w in words) if junk else " ".join(words)


def test_quality_held_out_accuracy_and_cases(spark):
    rnd = random.Random(2)
    rows = [(i, prose(rnd, i % 5 == 0), None, None, None, i, None) for i in range(500)] + [(900, None, None, None, None, None, None), (901, "", None, None, 0, None, None)]
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(500)] + [(None, 1), (7777, 1)], "doc_id long, quality int")
    got = H.by_id(quality.digests(H.frame(spark, rows), labels))
    assert len(got) == len(rows)
    held = [r for i, r in got.items() if i < 500 and r.held_out]
    assert held and all(r.held_out == (H.crc(i, 3) == 1) for i, r in got.items())
    assert sum(r.predicted == int(r.doc_id % 5 != 0) for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    kept = quality.drop_low(H.frame(spark, rows), labels)
    assert kept.columns == H.frame(spark, rows).columns
    assert quality.digests(spark.createDataFrame([], H.SCHEMA), labels).count() == 0
    none = quality.digests(H.frame(spark, rows[:3]), labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}


def test_machine_uses_the_sum_of_squares_identity():
    rng = np.random.default_rng(3)
    m = quality.Machine()
    m.weight, m.factor = rng.normal(size=m.weight.shape), rng.normal(size=m.factor.shape)
    c, x = np.array([0, 5, 40, 200]), rng.normal(size=4)
    pairs = sum(m.factor[c[i]] @ m.factor[c[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert np.isclose(m.raw(np.zeros(4, int), c, x)[0][0], m.bias + m.weight[c] @ x + pairs)


def test_kneser_ney_matches_plain_python(spark, monkeypatch):
    rows = H.docs()
    want, total = H.kneser_ney(rows)
    assert math.isclose(total, 1, rel_tol=1e-9)
    for size in (8_000_000, 3000):  # one file, and many files with spread contexts
        monkeypatch.setattr(lm, "FILE_TOKENS", size)
        got = H.by_id(lm.digests(H.frame(spark, rows)))
        assert set(got) == set(want)
        for i, r in got.items():
            assert (r.n_tokens, r.n_known, r.train_tokens) == want[i][:3] and r.held_out == (H.crc(i, 7) == 2)
            assert math.isclose(r.base_score, want[i][3], rel_tol=1e-9) and math.isclose(r.score, want[i][4], rel_tol=1e-9)


def test_file_of_bigrams_is_exact_and_bounded(tmp_path):
    """A file of bigrams, in pieces with repeats: the arrays are those of one sum, and the work takes little beside the bigrams."""
    rng = np.random.default_rng(7)
    n = 1_500_000
    codes = rng.integers(0, 40_000, n, np.uint64) << np.uint64(32) | rng.integers(0, 400_000, n, np.uint64)
    codes[:900] = codes[0]
    counts = rng.integers(1, 5, n).astype(np.uint32)
    hot = np.array([int(codes[0] >> np.uint64(32))])
    pieces = [np.sort(x) for x in np.array_split(codes, 12)]
    tracemalloc.start()
    held = lm.FileOfBigrams()
    for c, k in zip(pieces, np.array_split(counts, 12), strict=True):
        held.add(c, k)
    got = held.written(str(tmp_path), 0, hot)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 * n   # all at once took 89 bytes a bigram
    k, c = lm.summed(np.concatenate(pieces), counts.astype(np.int64))
    h = lm.mix(k)
    order = np.argsort(h)
    read = lambda name, kind: np.fromfile(tmp_path / f"{name}-0", kind)
    assert (read("bigrams", np.uint64) == h[order]).all() and (read("seen", np.uint8) == np.minimum(c[order], 255)).all()
    big = read("often-at", np.int64)
    assert len(big) and (big == np.flatnonzero(c[order] > 254)).all() and (read("often", np.int64) == c[order][big]).all()
    context = (k >> np.uint64(32)).astype(np.int64)
    each, place = np.unique(context, return_inverse=True)
    kinds = np.stack([np.bincount(place, x) for x in (c == 1, c == 2, c > 2)], axis=1)
    assert (read("contexts", np.int64) == each[each != hot[0]]).all() and (read("kinds", np.uint32).reshape(-1, 3) == kinds[each != hot[0]]).all()
    rows = [[x.as_py() for x in r] for r in zip(*got.columns, strict=True)]
    w, before = np.unique(k & np.uint64(0xFFFFFFFF), return_counts=True)
    assert [r[:2] for r in rows if r[0] >= 0] == [[int(x), int(y)] for x, y in zip(w, before, strict=True)]
    assert rows[-2:] == [[-1, int(hot[0]), *kinds[each == hot[0]][0].astype(int).tolist(), 0], [-2, *[int((c == x).sum()) for x in (1, 2, 3, 4)], len(c)]]


def test_kneser_ney_without_training_rows(spark):
    assert lm.digests(spark.createDataFrame([], H.SCHEMA)).count() == 0
    held = next(i for i in range(99) if H.crc(i, 7) == 2)
    r = lm.digests(H.frame(spark, [(held, "a b", None, None, None, None, None)])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_language_forward_sums_all_segmentations():
    pieces = langid.Pieces([bytes([b]) for b in range(256)] + [b"ab", b"abc", b" a", b"bc"])
    rng = np.random.default_rng(4)
    prob = rng.random((pieces.n, 2))
    model = langid.Model(["x", "y"], np.zeros(2), prob, pieces)
    table = {p: i for i, p in enumerate([bytes([b]) for b in range(256)] + [b"ab", b"abc", b" a", b"bc"])}

    def brute(w, k):
        return 1.0 if not w else sum(prob[table[w[:n]], k] * brute(w[n:], k) for n in range(1, 4) if w[:n] in table and n <= len(w))
    got = model.log_probability(np.frombuffer(b"abcab cb", np.uint8), np.array([0, 8]))[0]
    assert np.allclose(got, [np.log(brute(b" abcab", k)) + np.log(brute(b" cb", k)) for k in (0, 1)])


def test_language_held_out_accuracy_and_cases(spark):
    rnd = random.Random(5)
    voc = {"en": "the of and with that from which there this have".split(), "de": "der und nicht eine auch sich werden über schön größe".split()}
    rows = [(i, " ".join(rnd.choice(voc[("en", "de")[i % 2]]) for _ in range(12)), ("en", "de")[i % 2], None, None, None, None) for i in range(300)]
    rows += [(400, None, "en", None, None, None, None), (401, "123 --- 45", "en", None, None, None, None), (402, "", None, None, None, None, None), (403, "the " * 5000, None, None, None, None, None)]
    got = H.by_id(langid.digests(H.frame(spark, rows)))
    assert [got[i].lang_pred for i in (400, 401, 402, 403)] == ["und", "und", "und", "en"]
    assert all(got[i].lang_pred == ("en", "de")[i % 2] and 0 <= got[i].score <= 1 and got[i].held_out == (H.crc(i, 4) == 2) for i in range(300))
    assert langid.digests(spark.createDataFrame([], H.SCHEMA)).count() == 0


def vectors(spark, x, extra=()):
    return spark.createDataFrame([(i, [float(y) for y in v], "c") for i, v in enumerate(x)] + list(extra), "vec_id long, embedding array<float>, v string").repartition(4)


def check_search(got, x, k=20, least=0.9):
    x = x.astype(np.float32).astype(float)
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q in range(0, len(x), 20):
        s = x @ x[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:k]
        rows = sorted(found[q])
        assert [r[0] for r in rows] == list(range(1, len(order) + 1)) and q not in [r[1] for r in rows]
        assert all(abs(s[i] - y) < 1e-9 for _, i, y in rows)
        assert [(-y, i) for _, i, y in rows] == sorted((-y, i) for _, i, y in rows)
        hits += len(set(order) & {r[1] for r in rows})
        total += len(order)
    assert hits / total >= least
    return found


def test_search_recall_copies_and_cases(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 900)] + 0.3 * rng.normal(size=(900, 16))
    x[100:400] = x[100]  # a group of copies
    bad = [(5000, None, "c"), (5020, [0.0] * 16, "c"), (5040, [float("nan")] + [1.0] * 15, "c"), (5060, [None] + [1.0] * 15, "c"),
           (5080, [float("inf")] * 16, "c"), (None, [1.0] * 16, "c"), (5100, [1.0, 2.0], "c")]
    found = check_search(ann.search(vectors(spark, x, bad), part_rows=40, sample=400).collect(), x)
    assert set(found) == set(range(0, 900, 20))


def test_search_breaks_ties_by_id(spark):
    """199 different vectors with one product to the query, and more with another."""
    x = np.zeros((300, 320))
    x[:, 0] = 1
    x[np.arange(1, 200), np.arange(1, 200)] = 2.0
    x[200:, 0] = 0.5
    x[np.arange(200, 300), np.arange(200, 300)] = 2.0
    got = sorted((r["rank"], r.vec_id) for r in ann.search(vectors(spark, x)).where("query_id = 0").collect())
    assert got == [(i, i) for i in range(1, 21)]


def test_search_small_and_empty(spark):
    x = np.eye(4)
    check_search(ann.search(vectors(spark, x)).collect(), x, least=1.0)
    assert ann.search(vectors(spark, np.ones((1, 4)))).count() == 0
    assert ann.search(vectors(spark, np.zeros((0, 4)))).count() == 0


def test_balanced_parts_are_balanced():
    x = np.random.default_rng(1).normal(size=(203, 8))
    sizes = np.bincount(ann.balanced_parts(x, ann.nearest(x, 5), 8))
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 1
