"""Words whose polynomial hashes collide by form, and texts that make patterns recurse."""

import pytest
from llm import helpers as H

from hazelake.llm import bpe, lm, neardup, pii, repeats


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


@pytest.fixture(scope="module")
def rows():
    pairs = [(thue_morse(n), thue_morse(n, "b", "a")) for n in (1024, 2048, 65536)]
    fill = [f"w{i}" for i in range(60)]
    out = []
    for k, pair in enumerate(pairs):
        for x in pair:
            out.append((len(out), " ".join(x if i % 7 == 3 else f"{w}k{k}" for i, w in enumerate(fill)), None, None, None, None, None))
    return out


def test_near_duplicates_and_repeats(spark, rows):
    got = H.by_id(neardup.near_duplicates(H.frame(spark, rows)))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == H.near_duplicates(rows)
    assert H.by_row(repeats.digests(H.frame(spark, rows)), "n_words", "n_removed", "kept_sha256") == H.repeated_words(rows)


def test_language_model(spark, rows):
    got = H.by_id(lm.digests(H.frame(spark, rows)))
    want, _ = H.kneser_ney(rows)
    for i, r in got.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[i][:3]
        assert abs(r.base_score - want[i][3]) < 1e-6 and abs(r.score - want[i][4]) < 1e-6


def test_bpe(spark, rows):
    got = {r.doc_id: r for r in bpe.encode_decode(H.frame(spark, rows)).collect()}
    assert all(got[i].decoded == t for i, t, *_ in rows)


WORST = ["a@" + "b." * 50000 + "com", "a@" + "bb." * 50000 + "com", "x" * 100000 + "@a.com", "token=" + "a." * 50000, "1." * 50000, "1-" * 50000, "+1" + " 22" * 30000,
         "AKIA" * 25000, "Mr " + "A." * 20000, "Mr " + "von der " * 10000]


def test_worst_texts_of_every_kind_do_not_recurse(spark):
    df = spark.createDataFrame(list(enumerate(WORST)), "doc_id long, text string").repartition(4)
    out = {r.doc_id: r.text for r in pii.replace(df).collect()}
    assert len(out) == len(WORST) and all(out[i] for i in out)
