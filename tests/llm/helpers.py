"""Small documents with awkward cases, and plain Python versions of the contracts."""

import collections
import hashlib
import math
import random
import re
import zlib

WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, n_words string"


def docs(n=60, seed=1, vocabulary=400):
    """Rows (doc_id, text, lang, source, n_chars, and two columns whose names clash)."""
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzéñß") for _ in range(rnd.randint(1, 9))) for _ in range(vocabulary)]
    passage = " ".join(rnd.choice(vocab) for _ in range(70))
    texts = []
    for i in range(n):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([3, 40, 120]))]
        if i % 4 == 0:
            at = rnd.randint(0, len(words))
            words[at:at] = passage.split()
        texts.append(" ".join(words))
    texts[7] = texts[3]
    near = texts[4].split()
    near[len(near) // 2] = "changed"
    texts[8] = " ".join(near)
    texts[9] = texts[4] + " more"
    texts += [None, "", "  \n\t ", "one", "two words", "IN CAPS Ünïcode 中文 😀", " ".join(rnd.choice(vocab) for _ in range(20000)), "x" * 30000, "ab " * 900]
    rows = [(i, t, ("en", "de", None)[i % 3], "src0", None if t is None else len(t), i, "clash") for i, t in enumerate(texts)]
    rows.append(rows[5])  # a repeated row
    rows.append((None, texts[3], "en", None, None, None, None))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def by_row(df, *columns):
    """Rows as (doc_id, columns), null ids and repeated rows included, sorted."""
    return sorted(((r["doc_id"], *(r[c] for c in columns)) for r in df.collect()), key=str)


def awkward():
    """Documents with ids that are missing or shared by rows with different texts."""
    rows = docs()
    shared = [(3, rows[4][1] + " other end", None, None, None, None, None), (12, rows[0][1], None, None, None, None, None), (12, rows[1][1], None, None, None, None, None),
              (None, rows[10][1], None, None, None, None, None), (None, rows[10][1], None, None, None, None, None), (None, "", None, None, None, None, None),
              (None, None, None, None, None, None, None), (70000, "only here " + " ".join(f"u{i}" for i in range(90)), None, None, None, None, None)]
    return rows + shared + [(None, shared[-1][1], None, None, None, None, None)]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}


def sha(b):
    return hashlib.sha256(b).hexdigest()


def words(text):
    return WORD.findall(text or "")


def crc(i, m):
    return zlib.crc32(str(i).encode()) % m


def repeated_bytes(rows, width=200):
    """Rows (doc_id, bytes, removed, spans, digest), sorted."""
    rows = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = collections.Counter(b[j:j + width] for _, b in rows for j in range(len(b) - width + 1))
    out = []
    for i, b in rows:
        m = bytearray(len(b))
        for j in range(len(b) - width + 1):
            if seen[b[j:j + width]] > 1:
                m[j:j + width] = b"\1" * width
        out.append((i, len(b), sum(m), len(re.findall(b"\1+", bytes(m))), sha(bytes(x for x, y in zip(b, m, strict=True) if not y))))
    return sorted(out, key=str)


def repeated_words(rows, width=50):
    """Rows (doc_id, words, removed, digest), sorted; a null id is smaller than none and has none that is smaller."""
    rows = [(i, words(t)) for i, t, *_ in rows]
    first = {}
    for i, w in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for j in range(len(w) - width + 1):
            first.setdefault(tuple(w[j:j + width]), i)
    out = []
    for i, w in rows:
        m = [0] * len(w)
        for j in range(len(w) - width + 1):
            if i is not None and first[tuple(w[j:j + width])] < i:
                m[j:j + width] = [1] * width
        out.append((i, len(w), sum(m), sha(" ".join(x for x, y in zip(w, m, strict=True) if not y).encode())))
    return sorted(out, key=str)


def near_duplicates(rows, size=3, percent=85):
    sets = {}
    for i, t, *_ in rows:
        w = words((t or "").translate(LOW))
        if i is not None:
            sets[i] = {tuple(w[j:j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def kneser_ney(rows):
    """Scores of all texts, and the sum of probabilities after the text's start."""
    tokens = [(i, [*words((t or "").translate(LOW)), "\0end"]) for i, t, *_ in rows]
    taught = [w for i, w in tokens if i is not None and crc(i, 7) != 2]
    count = collections.Counter(x for w in taught for x in w)
    total, size = sum(count.values()), len(count)
    pair = collections.Counter(p for w in taught for p in zip(["\0start", *w[:-1]], w, strict=True))
    before = collections.Counter(w for _, w in pair)
    context, kinds = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
    for (a, _), n in pair.items():
        context[a] += n
        kinds[a][min(n, 3) - 1] += 1

    def discounts(values):
        n = [sum(v == j for v in values) for j in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        raw = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1] if n[1] else 1.0, 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
        return [min(max(x, 0.05), top) for x, top in zip(raw, (0.99, 1.98, 2.97), strict=True)]
    d2, d1 = discounts(list(pair.values())), discounts(list(before.values()))
    off = lambda d, n: d[min(n, 3) - 1] if n else 0
    mass = sum(off(d1, k) for k in before.values()) / len(pair)
    p1 = lambda w: max(before[w] - off(d1, before[w]), 0) / len(pair) + mass / (size + 1)

    def p(a, w):
        if not context[a]:
            return p1(w)
        n = pair[a, w]
        return max(n - off(d2, n), 0) / context[a] + sum(x * y for x, y in zip(kinds[a], d2, strict=True)) / context[a] * p1(w)
    out = {i: (len(w), sum(count[x] > 0 for x in w), total, sum(math.log10((count[x] + 1) / (total + size + 1)) for x in w),
               sum(math.log10(p(a, x)) for a, x in zip(["\0start", *w[:-1]], w, strict=True))) for i, w in tokens if i is not None}
    return out, sum(p("\0start", w) for w in count) + p("\0start", "\0unknown")
