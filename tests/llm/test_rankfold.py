import base64
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from llm import helpers as H

from hazelake.llm import rankfold


@pytest.fixture(scope="module")
def ranks():
    return rankfold.load_ranks(rankfold.default_vocabulary())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rnd = random.Random(1)
    out = ["don't I'LL 's's we'llx", "a<|endoftext|>b", "\x1c\x1d \x85 x\u3000y", "12 \u00b2\u2462\u0663", "a" * 5000, " \n\n x  ", " " * 3000 + "x", "ab" * 4000]
    out += ["".join(rnd.choice("ab c\n\t'\u2019\u00e9\u4e2d\U0001f600\u0300\x00\xa0\u200b12,.S") for _ in range(60)) for _ in range(60)]
    out += ["".join(rnd.choice("ABCDEFabcdef0123456789+/") for _ in range(n)) for n in (34, 500, 6000)]
    out += ["\u0e20\u0e32\u0e29\u0e32\u0e44\u0e17\u0e22" * 40, "\u4e2d\u6587\u5206\u8bcd\u6d4b\u8bd5" * 50, "donaudampfschifffahrtsgesellschaftskapit\u00e4n" * 9]
    return out


def test_matches_the_library(spark, library):
    rows = H.docs() + [(1000 + i, x, None, None, None, None, None) for i, x in enumerate(odd_texts())]
    got = H.by_id(rankfold.digests(H.frame(spark, rows)))
    for i, text, *_ in rows:
        if i is not None:
            ids = library.encode_ordinary(text or "")
            want = (len(ids), H.sha(np.array(ids, "<u4").tobytes()), H.sha(library.decode_bytes(ids)))
            assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want, repr(text)[:80]


def test_defined_cases(spark):
    df = H.frame(spark, [(1, None, None, None, None, 1, "x"), (2, "", None, None, None, 2, "x"), (None, "a b", None, None, None, 3, "x"), (None, "a b", None, None, None, 3, "x")])
    out = rankfold.decode(rankfold.encode(df)).collect()
    assert sorted((r.doc_id or 0, len(r.ids), bytes(r.decoded)) for r in out) == [(0, 2, b"a b"), (0, 2, b"a b"), (1, 0, b""), (2, 0, b"")]
    assert rankfold.digests(df.where("false")).count() == 0
    other = rankfold.encode(df.selectExpr("concat('k', node) AS ids", "text AS words"), key="ids", text="words")
    assert other.columns[0] == "ids" and {r[0] for r in other.collect()} == {"k1", "k2", "k3"}


def test_pattern_on_all_code_points(ranks, library):
    """Every code point between letters, digits and blanks, cut as the library cuts them (its Unicode version may be older)."""
    pattern = rankfold.default_pattern()
    splitter = rankfold.Splitter(ranks, pattern, rankfold.newer_characters(pattern))
    tails = {bytes([b]) + c: 256 + 64 * k + b - 0x80 for k, c in enumerate((b"a", b"1", b".", b" ")) for b in range(0x80, 0xC0)}
    joins = {bytes([b]): b for b in range(256)} | tails
    seen = tiktoken.Encoding("joins", pat_str=public_tokenizers.PATTERN, mergeable_ranks=joins, special_tokens={})
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(every), 1 << 14):
        text = "".join(f"a{c}1{c} {c}a{c}.{c}{c} " for c in every[lo:lo + (1 << 14)])
        assert [t for p in splitter.pieces(text) for t in seen._encode_single_piece(p.encode())] == seen.encode_ordinary(text), hex(lo)


def test_cuts_and_heap_merge_like_the_library(ranks, library):
    splitter = rankfold.Splitter(ranks, rankfold.default_pattern())
    rnd = random.Random(2)
    for _ in range(200):
        word = bytes(rnd.choice(b"aabcdeXYZ019 \xc3\xa9\xe4\xb8\xad") for _ in range(rnd.randint(2, 90)))
        whole = [ranks[t] for t in splitter.merged(word)]
        at = [0, *splitter.cuts(word), len(word)]
        assert whole == [ranks[t] for a, b in zip(at[:-1], at[1:], strict=True) for t in splitter.merged(word[a:b])]
        if word not in ranks:
            assert whole == library._encode_single_piece(word)


def test_no_python_below_the_chunks(spark, library):
    """The merges run in Spark expressions, and no shuffle is needed."""
    plan = rankfold.digests(H.frame(spark, [(1, "a", None, None, None, None, None)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "from_json" not in plan and "aggregate(" in plan


def test_a_step_of_the_fold_is_one_replacement(spark):
    """Each step joins one pair in the whole word; no step looks for the lowest rank of all pairs."""
    plan = rankfold.digests(H.frame(spark, [(1, "a", None, None, None, None, None)]))._jdf.queryExecution().executedPlan().toString()
    assert "replace(" in plan and "array_min(" not in plan


def test_listed_merges_give_the_heap_s_tokens(ranks):
    splitter = rankfold.Splitter(ranks, rankfold.default_pattern())
    lefts = rankfold.last_parts(ranks)
    tokens = {r: t for t, r in ranks.items()}
    rnd = random.Random(3)
    words = [bytes(rnd.choice(b"aabcdeinrst \xc3\xa9\xe4\xb8\xad") for _ in range(rnd.randint(1, 60))) for _ in range(300)]
    for word, state in zip([*words, b" the"], splitter.states([*words, ranks[b" the"]]).to_pylist(), strict=True):
        sym = state["sym"]
        assert state["merges"] == sorted(set(state["merges"]))
        for r in state["merges"]:
            left = lefts[tokens[r]]
            sym = sym.replace(rankfold.symbol(ranks[left]) + rankfold.symbol(ranks[tokens[r][len(left):]]), rankfold.symbol(r))
        assert sym == "".join(rankfold.symbol(ranks[t]) for t in splitter.merged(word))


@pytest.mark.parametrize("trained", [True, False])
def test_other_vocabularies(spark, tmp_path, trained):
    """One whose merges ascend, and one whose tokens have lower ranks than their parts, or cannot be merged at all."""
    rnd = random.Random(4)
    tokens = sorted({bytes(rnd.choice(b"abc") for _ in range(rnd.randint(2, 6))) for _ in range(60)}, key=lambda t: (len(t), t) if trained else rnd.random())
    ranks = {bytes([b]): b for b in range(256)} | {t: 256 + 3 * i for i, t in enumerate(tokens)}  # ranks with gaps
    assert rankfold.ascending(ranks, rankfold.last_parts(ranks)) == trained
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    texts = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 40))) + rnd.choice(["", " ab", "\u00e9c"]) for _ in range(200)]
    own = tiktoken.Encoding("other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.ids for r in rankfold.encode(df, str(path)).collect()} == {i: own.encode_ordinary(t) for i, t in enumerate(texts)}


def test_classes_cut_like_the_pattern(ranks):
    pattern = rankfold.default_pattern()
    newer = rankfold.newer_characters(pattern)
    splitter = rankfold.Splitter(ranks, pattern, newer)
    rnd = random.Random(5)
    some = "abstmdrevl  c\n\t'\u2019\u00e9\u4e2d\U0001f600\u0300\x00\xa0\u200b12,.S\x1c\x85\u3000 \u00b2" + newer[::4000]
    texts = ["".join(rnd.choice(some) for _ in range(rnd.randint(0, 40))) for _ in range(5000)] + ["", "x" * 10]
    texts += ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}a" for c in range(lo, lo + 4096) if not 0xD800 <= c < 0xE000) for lo in range(0, 0x110000, 4096)]
    for lo in range(0, len(texts), 500):
        found, counts = splitter.cut(texts[lo:lo + 500])
        want = [[p.encode() for p in splitter.pieces(t)] for t in texts[lo:lo + 500]]
        assert found == [p for x in want for p in x] and counts.tolist() == [len(x) for x in want]
