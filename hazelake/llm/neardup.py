"""Near-duplicate documents by min-max hashing (operator 4).

A document's set are its distinct word shingles, as 64-bit hashes. Under every permutation both
the smallest and the largest hash are kept, so a signature takes half as many hash evaluations as
it has values; each value agrees between two sets with probability equal to their similarity.
Bands of several values are buckets. Their size and number follow from the threshold
(``layout``), so that a pair at the threshold shares no bucket with a probability below ``MISS``.

Documents with equal sets are one node from the start. In every bucket all nodes are compared
with the bucket's first node, its head, on their full sets (a star, not all pairs). Then, among
the nodes of a head that still lie in several components, links are found through what differs
from the head: with D the symmetric difference of a node's set and the head's,
``|x ^ y| = |D_x| + |D_y| - 2 |D_x & D_y|``, so counting common elements of the small sets D gives
the exact similarity. The nodes outside the head's component are looked up against the head's
other nodes in cells of bounded size, which give links only, never all pairs. Nothing is capped.

Defined cases: null or empty text, or text of white space, has an empty set and is linked with
nothing; fewer words than a shingle make one shingle of all words; a null doc_id is linked with
nothing and stays; repeated rows are one document (rows that share a doc_id are expected to share
their text); an empty table gives an empty result; further columns do not matter, whatever their
names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.llm.arrays import (
    LOWER,
    SPACE,
    column,
    lean,
    mix,
    owners,
    prefix_hashes,
    prepare,
    ranges,
    slices,
    span_hashes,
    spans,
    text_bytes,
    unused,
    word_hashes,
)
from hazelake.llm.graph import components
from hazelake.session import materialize

SHINGLE = 3
PERCENT = 85
AGREE = 0.325  # a pair at the threshold agrees in a band with this probability or more
MISS = 1e-6
CHUNK = 256 << 10  # bytes of text sketched at once; the work arrays take about a hundred times as much
BITS = 1 << 26  # of the broadcast marks of ids, 8 MB
CELL = 1024  # nodes of a head that are compared in one call


def layout(percent: int) -> tuple[int, int]:
    """(values in a band, bands) for a threshold in percent; their product is even."""
    s = min(max(percent, 1), 99) / 100
    rows = max(1, min(8, int(math.log(AGREE) / math.log(s))))
    bands = math.ceil(math.log(MISS) / math.log1p(-s ** rows))
    return rows, bands + (rows * bands) % 2


def multipliers(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of all distinct shingles, ordered by both."""
    low = LOWER[data]
    start, stop = spans(~SPACE[low], offs)
    doc = owners(offs, start)
    words = word_hashes(low, start, stop) | np.uint64(1)
    n = np.bincount(doc, minlength=len(offs) - 1) if len(doc) else np.zeros(len(offs) - 1, np.int64)
    first = np.cumsum(n) - n
    prefix = prefix_hashes(words)
    at = np.arange(len(words))
    full = at[at + size <= (first + n)[doc]] if len(doc) else at
    short = np.flatnonzero((n > 0) & (n < size))
    begin = np.concatenate([full, first[short]])
    end = np.concatenate([full + size, (first + n)[short]])
    who = np.concatenate([doc[full], short]) if len(doc) else np.zeros(0, np.int64)
    h = mix(span_hashes(prefix, begin, end) + (end - begin).astype(np.uint64))
    order = np.lexsort((h, who))
    who, h = who[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (who[1:] != who[:-1])
    return who[keep], h[keep]


def signatures(who: np.ndarray, h: np.ndarray, permutations: int) -> np.ndarray:
    """[sets x 2 * permutations]: smallest and largest value under every permutation. Every set has hashes."""
    first = np.flatnonzero(np.diff(who, prepend=-1))
    out = np.empty((len(first), 2 * permutations), np.uint32)
    for p, factor in enumerate(multipliers(permutations)):
        v = ((h * factor) >> np.uint64(32)).astype(np.uint32)
        out[:, 2 * p] = np.minimum.reduceat(v, first) if len(first) else 0
        out[:, 2 * p + 1] = np.maximum.reduceat(v, first) if len(first) else 0
    return out


def buckets_of(signature: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """[sets x bands] bucket keys."""
    part = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    key = np.tile(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(signature), 1))
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + part[:, :, r])
    return key.view(np.int64)


def _sketch(size: int, percent: int):
    rows, bands = layout(percent)

    def run(batches):
        for part in slices(batches, "text", CHUNK):
            who, h = shingle_sets(*text_bytes(column(part, "text")), size)
            n = np.bincount(who, minlength=part.num_rows)
            has = np.flatnonzero(n)
            d1, d2 = np.zeros(part.num_rows, np.uint64), np.zeros(part.num_rows, np.uint64)
            lists = pa.array([None] * part.num_rows, pa.list_(pa.int64()))
            if len(h):
                first = np.flatnonzero(np.diff(who, prepend=-1))
                d1[has] = np.add.reduceat(mix(h), first)
                d2[has] = np.add.reduceat(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first)
                ends = np.cumsum(np.where(n > 0, bands, 0))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(buckets_of(signatures(who, h, rows * bands // 2), rows, bands).ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.array(n, pa.int64()), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), lists],
                ["doc_id", "n_shingles", "d1", "d2", "bands"])
    return run


def _sets(size: int):
    def run(batches):
        for part in slices(batches, "text", CHUNK):
            who, h = shingle_sets(*text_bytes(column(part, "text")), size)
            ends = np.searchsorted(who, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h.view(np.int64))), column(part, "member"), column(part, "leads")],
                ["node", "hashes", "member", "leads"])
    return run


def _compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) of a member and its head, with the sizes of intersection and union of their sets. The side that is
    the same in many pairs (b) is joined last, so that only single sets are shuffled, and only those of that side."""
    got = pairs.join(sets.where("member").select(F.col("node").alias("a"), F.col("hashes").alias("__a")), "a").join(
        sets.where("leads").select(F.col("node").alias("b"), F.col("hashes").alias("__b")), "b")
    common = F.size(F.array_intersect("__a", "__b")).cast("long")
    return got.select("a", "b", common.alias("common"), (F.size("__a") + F.size("__b") - common).alias("total"))


def _links(percent: int):
    """Links between nodes outside their head's component and other nodes of the head, from the
    sizes of their sets and of what differs from the head's."""
    def run(asking: pa.Table, asked: pa.Table) -> pa.Table:
        none = pa.table({"a": asked.column("node").slice(0, 0), "b": asked.column("node").slice(0, 0)})
        if not asking.num_rows or not asked.num_rows:
            return none
        read = lambda t: (t.column("n").to_numpy(), t.column("component").to_numpy(), t.column("__d").combine_chunks())
        (an, ac, ad), (bn, bc, bd) = read(asking), read(asked)
        b_size = np.diff(np.asarray(bd.offsets))
        element = bd.flatten().to_numpy()
        order = np.argsort(element, kind="stable")
        element, holder = element[order], np.repeat(np.arange(len(bn)), b_size)[order]
        left, right = [], []
        for i in range(len(an)):  # one look-up of a whole cell per asking node
            mine = ad[i].values.to_numpy()
            lo, hi = np.searchsorted(element, mine), np.searchsorted(element, mine, side="right")
            common = np.bincount(holder[ranges(lo, hi - lo)], minlength=len(bn))
            apart = len(mine) + b_size - 2 * common
            size = an[i] + bn
            ok = np.flatnonzero((100 * (size - apart) >= percent * (size + apart)) & (bc != ac[i]))
            left.append(np.full(len(ok), i))
            right.append(ok)
        return pa.table({"a": asking.column("node").take(pa.array(np.concatenate(left))), "b": asked.column("node").take(pa.array(np.concatenate(right)))})
    return run


def marked(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """docs with a boolean column ``name`` that is true for every doc_id among ``ids`` (one column, stored) and false for
    nearly all others, so that what follows shuffles few texts in vain. The mark is a bit of the id's hash, in a table that is
    broadcast and stays at most ``BITS`` bits at any size; beyond that more are marked in vain."""
    bits = max(1 << 15, min(BITS, 1 << (64 * ids.count()).bit_length()))
    place, group, held = unused([*docs.columns, name], "place", "group", "held")
    hashed = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    parts = ids.select(hashed(ids.columns[0]).alias(place)).select(F.shiftright(place, 15).alias(group), F.col(place).bitwiseAND(0x7FFF).alias(place))
    table = parts.repartition(group).groupBy(group).agg(F.bitmap_construct_agg(place).alias(held))
    at = F.col(place).bitwiseAND(0x7FFF)
    byte = F.conv(F.hex(F.substring(held, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    got = docs.withColumn(place, hashed("doc_id")).withColumn(group, F.shiftright(place, 15)).join(F.broadcast(table), group, "left")
    bit = F.coalesce(F.getbit(byte, at.bitwiseAND(7).cast("int")) == 1, F.lit(False))
    return got.select(*[F.col(f"`{c}`") for c in docs.columns], bit.alias(name))


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    sketch = materialize(texts.mapInArrow(lean(_sketch(shingle, percent)), f"doc_id {kind}, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>"), "minmax")
    same = ["n_shingles", "d1", "d2"]
    full = sketch.where("n_shingles > 0 and doc_id is not null")
    nodes = materialize(full.groupBy(*same).agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")), "minmax-nodes")

    # dealt by bucket once, for the heads and for the join with them
    buckets = nodes.select("node", F.explode("bands").alias("bucket")).repartition("bucket")
    first = buckets.groupBy("bucket").agg(F.min("node").alias("head"), F.count("*").alias("__c")).where("__c > 1").drop("__c")
    hits = materialize(buckets.join(first, "bucket"), "minmax-hits")
    star = materialize(hits.where("node != head").select("node", "head").distinct(), "minmax-star")
    head = F.col("node") == F.col("head")
    wanted = materialize(hits.groupBy("node").agg(F.max(~head).alias("member"), F.max(head).alias("leads")), "minmax-wanted")
    # one plan at every size: a broadcast of the ids would stop fitting as the corpus grows. Repeated rows go while the
    # texts still lie by doc_id, so that the sets need no shuffle
    ids = marked(texts, wanted.select("node"), "maybe").where("maybe").join(wanted.hint("merge"), F.col("doc_id") == F.col("node"))
    ids = ids.dropDuplicates(["doc_id"]).select("doc_id", "text", "member", "leads")
    sets = materialize(ids.mapInArrow(lean(_sets(shingle)), f"node {kind}, hashes array<bigint>, member boolean, leads boolean"), "minmax-sets")
    linked = lambda t: t.where(100 * F.col("common") >= percent * F.col("total"))
    compared = materialize(_compare(star.select(F.col("node").alias("a"), F.col("head").alias("b")), sets), "minmax-compared")
    links = linked(compared).select("a", "b")
    comp = materialize(components(links), "minmax-components")

    # the rest: heads whose nodes lie in several components
    own = lambda t: F.coalesce(F.col(t), F.col("node"))
    component = comp.select("node", "component")
    star = star.join(component, "node", "left").withColumn("component", own("component")).join(
        component.select(F.col("node").alias("head"), F.col("component").alias("head_component")), "head", "left").withColumn(
        "head_component", F.coalesce("head_component", "head"))
    star = materialize(star, "minmax-placed")
    outside = F.col("component") != F.col("head_component")
    cells = star.groupBy("head").agg(F.ceil(F.count("*") / CELL).cast("int").alias("__all"), F.ceil(F.sum(outside.cast("int")) / CELL).cast("int").alias("__out"))
    rest = star.join(cells.where("__out > 0"), "head")
    far = rest.join(sets.where("member").select("node", F.col("hashes").alias("__x")), "node").join(sets.where("leads").select(F.col("node").alias("head"), F.col("hashes").alias("__h")), "head")
    far = far.withColumn("__d", F.array_union(F.array_except("__x", "__h"), F.array_except("__h", "__x")))
    dealt = materialize(far.select("head", "node", F.size("__x").cast("long").alias("n"), "component", outside.alias("outside"), "__d", "__all", "__out"), "minmax-far")
    cell = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = dealt.where("outside").withColumn("x", cell("__out")).withColumn("y", each("__all"))
    asked = dealt.toDF(*dealt.columns).withColumn("y", cell("__all")).withColumn("x", each("__out"))
    columns = ["head", "x", "y", "node", "n", "component", "outside", "__d"]
    more = asking.select(*columns).groupBy("head", "x", "y").cogroup(asked.select(*columns).groupBy("head", "x", "y")).applyInArrow(
        _links(percent), f"a {kind}, b {kind}").distinct()
    more = materialize(more, "minmax-rest")
    if not more.isEmpty():
        comp = materialize(components(links.unionByName(more)), "minmax-components")

    named = nodes.select(*same, "node").join(comp, "node", "left").select(*same, own("component").alias("component_id"))
    keyed = sketch.select("doc_id", *same)
    cond = [F.when(F.col("doc_id").isNotNull(), F.col(c)) if c == "n_shingles" else F.col(c) for c in same]
    got = keyed.withColumn("__n", cond[0]).join(
        named.select(F.col("n_shingles").alias("__n"), "d1", "d2", "component_id"), ["__n", "d1", "d2"], "left")
    got = got.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return got.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One document of each group, with the columns as they were; repeated rows stay once."""
    judged = materialize(near_duplicates(docs, **options), "minmax-judged")
    out, again, maybe = unused(docs.columns, "gone", "twice", "maybe")
    gone = materialize(judged.where("not kept").select(F.col("doc_id").alias(out)).distinct(), "minmax-gone")
    dealt = marked(docs, gone, maybe)
    left = dealt.where(~F.col(maybe)).drop(maybe).unionByName(
        dealt.where(maybe).join(gone.hint("merge"), F.col("doc_id") == F.col(out), "left_anti").drop(maybe))
    twice = materialize(judged.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(again)), "minmax-twice")
    if twice.isEmpty():
        return left
    on = F.col("doc_id") == F.col(again)
    return left.join(twice, on, "left_anti").unionByName(left.join(twice, on, "left_semi").dropDuplicates(["doc_id"]))
