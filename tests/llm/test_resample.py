import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from llm import helpers as H

from hazelake.llm import resample

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def feats(text):
    w = WORDS.findall((text or "").translate(H.LOW))
    return len(w), [zlib.crc32(x.encode()) % 10000 for x in [*w, *map(" ".join, zip(w, w[1:], strict=False))]]


def brute(rows, items):
    """(n_features, weight, score, rank) of rows with an id, in their order."""
    own = [feats(t) for _, t, *_ in rows]
    s = collections.Counter(b for _, f in own for b in f)
    t = collections.Counter(b for x in items for b in feats(x)[1])
    big, small = sum(s.values()) + 10000.0, sum(t.values()) + 10000.0
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * big / ((s[b] + 1.0) * small))) for b in range(10000)]
    out = []
    for (i, *_), (n, f) in zip(rows, own, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, n])
    may = sorted((r for r in out if r[5] >= 20 and r[3] is not None), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(may[:len(may) * 25 // 100]):
        r[4] = k + 1
    return sorted((tuple(-1 if x is None else x for x in r[:5]) for r in out))


ITEMS = ["one two three", "Ünïcode 中文", None, "", "a b c a b c a b c", "x" * 100]


@pytest.mark.parametrize("target", [ITEMS, []])
def test_query_matches_brute_force(spark, target):
    rows = H.docs()
    rows[5:5] = [(900 + i, "word " * n, None, None, None, None, None) for i, n in enumerate((19, 20, 300, 70000))]
    bench = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    got = sorted(tuple(-1 if x is None else x for x in r) for r in resample.digests(H.frame(spark, rows), bench).collect())
    assert got == brute(rows, target)
    assert resample.digests(H.frame(spark, rows).where("false"), bench).count() == 0


def test_sql_gives_the_same(spark):
    rows = [r for r in H.docs() if r[1] != H.docs()[3][1] or r[0] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", list(enumerate(ITEMS)))
    assert sorted(tuple(-1 if x is None else x for x in r) for r in con.execute(resample.ORACLE_SQL).fetchall()) == brute(rows, ITEMS)


def test_bit_planes_sum_exactly():
    rnd = np.random.default_rng(5)
    for buckets in (10, 64, 1000):
        gain = rnd.integers(-20000, 20000, buckets)
        docs = np.sort(rnd.integers(0, 7, 900))
        bucket = rnd.integers(0, buckets, 900) // rnd.integers(1, 9, 900)
        want = np.bincount(docs, weights=gain[bucket], minlength=8).astype(np.int64)
        assert resample.sums(docs, bucket, 8, *resample.gain_planes(gain), buckets).tolist() == want.tolist()
    assert resample.sums(docs[:0], bucket[:0], 3, *resample.gain_planes(gain), buckets).tolist() == [0, 0, 0]


def test_hashes_of_any_length():
    rnd = random.Random(6)
    texts = [b"".join(bytes([rnd.choice(b"abz019\xc3\xa9")]) for _ in range(rnd.choice([1, 2, 47, 48, 49, 900]))) for _ in range(80)]
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    data = np.frombuffer(b"".join(texts), np.uint8)
    got = resample.crc_on(np.full(len(texts), 0xFFFFFFFF, np.uint32), data, offs[:-1], np.diff(offs)) ^ np.uint32(0xFFFFFFFF)
    assert got.tolist() == [zlib.crc32(t) for t in texts]


def test_ranks_prefer_the_target_and_other_keys_work(spark):
    rows = [(f"k{i}", "target words only here " * 8 if i % 10 == 0 else "something else entirely now " * 8) for i in range(400)]
    out = resample.resample(spark.createDataFrame(rows, "weight string, score string"), spark.createDataFrame([("target words only here",)], "q string"),
                            key="weight", text="score", target_text="q", percent=10)
    drawn = [r[0] for r in out.collect() if r["rank"] is not None]
    assert len(drawn) == 40 and sum(int(k[1:]) % 10 == 0 for k in drawn) > 20
