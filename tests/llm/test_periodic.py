import random
import zlib

import numpy as np
import pytest
from llm import helpers as H

from hazelake.llm import periodic


def brute(w, times=4, least=6):
    """Runs by definition: every period, every maximal stretch, no smaller period."""
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q) and not any(all(w[k] == w[k + p] for k in range(i, j + q - p)) for p in range(1, q)):
                out.append((i, j + q - i, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def planted(i, w):
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]


def test_common_extensions_and_lyndon_words():
    rnd = random.Random(4)
    for _ in range(60):
        s = [rnd.randrange(1, 3) for _ in range(rnd.randint(1, 40))] + [0]
        e = periodic.Extensions(s)
        assert e.order == sorted(range(len(s)), key=lambda i: s[i:])
        i, j = (np.array(x) for x in zip(*[(a, b) for a in range(len(s)) for b in range(len(s)) if a != b], strict=True))
        want = [next(k for k in range(len(s)) if s[a + k] != s[b + k]) for a, b in zip(i, j, strict=True)]
        assert e.of(i, j).tolist() == want
        smaller, larger = periodic.lyndon_ends(e.order, len(s))
        for a in range(len(s)):
            assert smaller[a] == next((b for b in range(a + 1, len(s)) if s[b:] < s[a:]), len(s))
            assert larger[a] == next((b for b in range(a + 1, len(s)) if s[b:] > s[a:]), len(s))


@pytest.mark.parametrize("seed", range(4))
def test_runs_match_brute_force(seed, monkeypatch):
    monkeypatch.setattr(periodic, "TREE_WORDS", [1, 40, 1 << 16, 300][seed])
    rnd = random.Random(seed)
    for _ in range(60):
        docs = []
        for _ in range(rnd.randint(1, 6)):
            w = []
            while len(w) < rnd.randint(0, 60):
                part = [rnd.randrange(rnd.choice([2, 3, 30])) for _ in range(rnd.randint(1, 7))]
                w += part * rnd.choice([1, 1, 3, 4, 6]) + part[:rnd.randint(0, len(part))]
            docs.append(w)
        offs = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        s, e, q = periodic.find(np.array([x for d in docs for x in d], np.int64), offs, 4, 6)
        want = [(int(o) + a, int(o) + a + n, p) for o, d in zip(offs, docs, strict=False) for a, n, p in brute(d)]
        assert list(zip(s.tolist(), e.tolist(), q.tolist(), strict=True)) == want


def test_query_matches_brute_force(spark):
    rnd = random.Random(9)
    rows = [r for r in H.docs() if len(r[1] or "") < 20000] + [(2000 + i, t, None, None, None, None, None) for i, t in enumerate(
        ["a a a a a a", "a a a a a", "a b a b a b a b", "x " * 50 + "y " * 50, " ".join("p q r".split() * 20 + ["z"] + "p q r".split() * 20), "\ta\n a\x0ba a\x1ca a a a ",
         " ".join(rnd.choice("ab") for _ in range(150)), "é é é é é é 中 中 中 中 中 中 中"])]
    got = H.by_id(periodic.digests(H.frame(spark, rows)))
    for i, text, *_ in rows:
        if i is None:
            continue
        w = planted(i, H.words(text))
        runs = brute(w)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want = (len(runs), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4),
                H.sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), H.sha(" ".join(kept(w, runs)).encode()))
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == want, i


def test_long_and_empty(spark):
    rows = [(1, "ab " * 60000, None, None, None, None, None), (2, None, None, None, None, None, None), (3, " ", None, None, None, None, None),
            (None, "a a a a a a b", None, None, None, None, None), (4, " ".join(map(str, range(30000))) + " u v" * 30000, None, None, None, None, None)]
    got = {r.doc_id: r for r in periodic.collapse(H.frame(spark, rows)).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 60000, 1)] and got[1].collapsed == "ab"
    assert got[2].runs == [] and got[2].collapsed == "" == got[3].collapsed and got[None].collapsed == "a b"
    assert [tuple(r) for r in got[4].runs] == [(30000, 60000, 2)] and got[4].collapsed.endswith(" 29999 u v")
    assert periodic.digests(H.frame(spark, rows).where("false")).count() == 0
    other = periodic.collapse(H.frame(spark, rows).selectExpr("concat('k', doc_id) AS runs", "text AS collapsed"), key="runs", text="collapsed")
    assert other.columns[0] == "runs" and other.count() == 5
