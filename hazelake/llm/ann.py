"""Approximate nearest neighbours by learned partitions (operator 6).

A neighbour graph over a bounded sample of the vectors (``SAMPLE``, a documented bound) is cut into
partitions of equal size by recursive bisection along its slowest mode of diffusion. A small
classifier (one hidden layer) learns each sample vector's partition, softened by the partitions
of its neighbours. Every row is indexed in its most probable partition; a query goes to its
several most probable partitions, and all rows there are reranked by the exact inner product in
double precision. How many partitions a query visits is measured: the smallest number that finds
``TARGET`` of the true neighbours of a quarter of the sample that the classifier has not seen.
Clustered vectors need few; vectors without structure need most partitions for the same recall.

Equal vectors are indexed once with their smallest ids (as many as a result can hold, so none is
lost), which settles groups of copies of any size; small partitions share a shard, large ones are
cut into cells. Queries that find fewer rows than there are candidates for visit all partitions.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part,
nor do those of another length than most; one vector has no neighbours; ties go to the smaller
id; a null id takes no part; repeated rows of one id count once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazelake.llm.arrays import column, prepare
from hazelake.session import materialize

SAMPLE = 8192
PART_ROWS = 800
MAX_PARTS = 256
NEIGHBOURS = 10
CELL_ROWS = 8192
CELL_QUERIES = 1024
PAIRS = 65_536  # pairs reranked at once
TARGET = 0.95


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    ok = vectors.where("vec_id is not null and embedding is not null").select("vec_id", v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = ok.where((F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0)).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    sizes = ok.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return ok.where(F.size("v") == (sizes[0][0] if sizes else 0)).groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(col) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def nearest(x: np.ndarray, k: int) -> np.ndarray:
    """[rows x k] nearest others by inner product."""
    out = np.empty((len(x), k), np.int64)
    for lo in range(0, len(x), 1024):
        s = x[lo:lo + 1024] @ x.T
        s[np.arange(len(s)), lo + np.arange(len(s))] = -np.inf
        out[lo:lo + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Partition number of every vertex; sizes differ by one at most. ``parts`` is a power of two."""
    label = np.zeros(len(x), np.int64)
    rng = np.random.default_rng(5)
    a, b = np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()
    src, dst = np.concatenate([a, b]), np.concatenate([b, a])
    for _ in range(parts.bit_length() - 1):
        new = label * 2
        for p in np.unique(label):
            at = np.flatnonzero(label == p)
            local = np.full(len(x), -1)
            local[at] = np.arange(len(at))
            mine = (local[src] >= 0) & (local[dst] >= 0)
            s, d = local[src[mine]], local[dst[mine]]
            degree = np.bincount(s, minlength=len(at)) + 1.0
            mode = x[at] @ rng.normal(size=x.shape[1]) + 1e-9 * rng.normal(size=len(at))
            for _ in range(60):  # diffusion, with the constant mode taken out
                mode = (mode + np.bincount(s, mode[d], len(at))) / degree
                mode -= (mode * degree).sum() / degree.sum()
                mode /= max(np.abs(mode).max(), 1e-300)
            new[at[np.argsort(mode, kind="stable")[len(at) // 2:]]] += 1
        label = new
    return label


class Router:
    """Classifier of partitions: unit vector -> one hidden layer -> softmax."""

    def __init__(self, x: np.ndarray, target: np.ndarray, hidden: int = 64, epochs: int = 15):
        rng = np.random.default_rng(9)
        d, k = x.shape[1], target.shape[1]
        p = [rng.normal(0, (2 / d) ** 0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, (hidden, k)), np.zeros(k)]
        self.p = p
        if k == 1:
            return
        x = self.unit(x)
        m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), 256):
                at = order[lo:lo + 256]
                h = np.maximum(x[at] @ p[0] + p[1], 0)
                z = h @ p[2] + p[3]
                e = np.exp(z - z.max(axis=1, keepdims=True))
                g = (e / e.sum(axis=1, keepdims=True) - target[at]) / len(at)
                gh = (g @ p[2].T) * (h > 0)
                step += 1
                for i, grad in enumerate((x[at].T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                    m[i] += 0.1 * (grad - m[i])
                    v[i] += 0.001 * (grad ** 2 - v[i])
                    p[i] -= 0.005 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Partitions of every row, most probable first."""
        z = np.maximum(self.unit(x) @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3]
        return np.argsort(-z, axis=1, kind="stable")


def learn(distinct: DataFrame, parts: int, sample: int = SAMPLE) -> tuple[Router, int]:
    """Router and the number of partitions that a query visits."""
    table = distinct.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    x = matrix(table.column("v"))
    if parts < 2 or len(x) <= 2 * NEIGHBOURS:
        return Router(x if len(x) else np.ones((1, 1)), np.ones((max(len(x), 1), 1))), 1
    graph = nearest(x, NEIGHBOURS)
    seen = len(x) - len(x) // 4  # the rest measures the recall
    known = nearest(x[:seen], NEIGHBOURS)
    label = balanced_parts(x[:seen], known, parts)
    near = label[known]
    target = np.zeros((seen, parts))
    target[np.arange(seen), label] = 0.5
    np.add.at(target, (np.repeat(np.arange(seen), NEIGHBOURS), near.ravel()), 0.5 / NEIGHBOURS)
    router = Router(x[:seen], target)
    ranked = router.ranked(x)
    place = np.empty_like(ranked)
    np.put_along_axis(place, ranked, np.arange(parts)[None, :], axis=1)
    visit = np.sort(np.take_along_axis(place[seen:], ranked[graph[seen:], 0], axis=1).ravel())  # rank of each neighbour's partition
    return router, min(parts, int(visit[int(TARGET * (len(visit) - 1))]) + 1)


def _top(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"q": [], "vec_id": [], "rank_score": [], "ids": []}
        if rows.num_rows and queries.num_rows:
            x, q = matrix(rows.column("v")), matrix(queries.column("v"))
            keep = min(k, len(x))
            # what the order of summation can change in a product
            slack = 4e-16 * (x.shape[1] + 2) * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
            ids, qid = rows.column("vec_id").to_numpy(), queries.column("q").to_numpy()
            lists = rows.column("ids").combine_chunks()
            part = rows.column("part").to_numpy()
            wanted = queries.column("parts").combine_chunks()
            asks = np.zeros((len(q), int(part.max()) + 1), bool)
            who, what = np.repeat(np.arange(len(q)), np.diff(np.asarray(wanted.offsets))), wanted.flatten().to_numpy()
            inside = what <= part.max()
            asks[who[inside], what[inside]] = True
            for lo in range(0, len(q), 256):
                s = np.where(asks[lo:lo + 256][:, part], q[lo:lo + 256] @ x.T, -np.inf)
                # every row that may be among the k nearest: equal products are told apart by their ids below
                least = -np.partition(-s, keep - 1, axis=1)[:, keep - 1] - 2 * slack[lo:lo + 256]
                who, near = np.nonzero((s >= least[:, None]) & np.isfinite(s))
                # one order of summation for every pair, so that the score depends on the pair alone
                exact = np.concatenate([np.zeros(0), *[(q[lo + who[i:i + PAIRS]] * x[near[i:i + PAIRS]]).sum(axis=1) for i in range(0, len(who), PAIRS)]])
                order = np.lexsort((ids[near], -exact, who))
                who, near, exact = who[order], near[order], exact[order]
                first = np.searchsorted(who, np.arange(len(s)))
                top = np.arange(len(who)) - first[who] < k
                out["q"].append(qid[lo + who[top]])
                out["vec_id"].append(ids[near[top]])
                out["rank_score"].append(exact[top])
                out["ids"].append(near[top])
        cat = lambda c, kind: np.concatenate(out[c]) if out[c] else np.zeros(0, kind)
        at = cat("ids", np.int64)
        picked = lists.take(pa.array(at)) if len(at) else pa.array([], pa.list_(pa.int64()))
        return pa.table({"q": pa.array(cat("q", np.int64), pa.int64()), "vec_id": pa.array(cat("vec_id", np.int64), pa.int64()),
                         "score": pa.array(cat("rank_score", float), pa.float64()), "ids": picked})
    return run


def search(vectors: DataFrame, *, k: int = 20, every: int = 20, part_rows: int = PART_ROWS, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query (ids divisible by ``every``)."""
    spark = vectors.sparkSession
    prepare(spark)
    every_row = materialize(usable(vectors).withColumn("vec_id", F.col("vec_id").cast("long")), "ann-vectors")
    copies = Window.partitionBy("v").orderBy("vec_id")
    few = every_row.withColumn("__r", F.row_number().over(copies)).where(F.col("__r") <= k + 1)
    distinct = materialize(few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("vec_id", F.get("ids", F.lit(0))), "ann-distinct")
    total, n_rows = distinct.count(), every_row.count()
    parts = 1
    while parts < MAX_PARTS and parts * 2 * part_rows <= total:
        parts *= 2
    router, visits = learn(distinct, parts, sample)
    shared = spark.sparkContext.broadcast(router)
    # queries of one vector are one search; q is their smallest id
    asked = every_row.where(F.col("vec_id") % every == 0)
    heads = asked.groupBy("v").agg(F.min("vec_id").alias("q"))
    members = materialize(asked.join(heads, "v").select("q", F.col("vec_id").alias("query_id")), "ann-queries")
    heads = materialize(heads, "ann-heads")

    def place(count):
        def run(batches):
            for part in batches:
                if part.num_rows:
                    ranked = shared.value.ranked(matrix(column(part, "v")))[:, :count]
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(ranked.astype(np.int32)), pa.list_(pa.int32()))], [*part.schema.names, "parts"])
        return run

    index = distinct.mapInArrow(place(1), "v array<double>, ids array<bigint>, vec_id bigint, parts array<int>").withColumn("part", F.get("parts", F.lit(0))).drop("parts")
    index = materialize(index, "ann-index")
    sizes = {r[0]: r[1] for r in index.groupBy("part").count().collect()}  # one row per partition
    # small partitions share a shard, so that a query gets few partial results; large ones have cells
    shard, held = [0] * parts, 0
    for p in range(parts):
        full = held and held + sizes.get(p, 0) > CELL_ROWS
        shard[p] = (shard[p - 1] if p else 0) + bool(full)
        held = sizes.get(p, 0) + (0 if full else held)
    n_cells = [max(1, -(-sum(n for p, n in sizes.items() if shard[p] == k) // CELL_ROWS)) for k in range(shard[-1] + 1)]
    numbers = lambda values: F.array(*[F.lit(int(x)) for x in values])
    cells = F.get(numbers(n_cells), F.col("shard"))
    index = index.withColumn("shard", F.get(numbers(shard), F.col("part")))
    of = np.array(shard)

    def route(count):
        def run(batches):
            for part in batches:
                if not part.num_rows:
                    continue
                visited = np.sort(shared.value.ranked(matrix(column(part, "v")))[:, :count], axis=1)  # shards ascend with partitions
                who = np.repeat(np.arange(len(visited)), visited.shape[1])
                flat = visited.ravel()
                first = np.flatnonzero(np.diff(who * parts + of[flat], prepend=-1))
                yield pa.RecordBatch.from_arrays(
                    [column(part, "v").take(pa.array(who[first])), column(part, "q").take(pa.array(who[first])), pa.array(of[flat[first]].astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.append(first, len(flat)), pa.int32()), pa.array(flat.astype(np.int32)))], ["v", "q", "shard", "parts"])
        return run

    def found(heads: DataFrame, count: int) -> DataFrame:
        routed = heads.mapInArrow(route(count), "v array<double>, q bigint, shard int, parts array<int>")
        per = {r[0]: r[1] for r in routed.groupBy("shard").count().collect()}
        blocks = F.get(numbers([max(1, -(-per.get(k, 1) // CELL_QUERIES)) for k in range(len(n_cells))]), F.col("shard"))
        rows = index.withColumn("cell", F.pmod(F.xxhash64("vec_id"), cells).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        ask = routed.withColumn("block", F.pmod(F.xxhash64("q"), blocks).cast("int")).withColumn("cell", F.explode(F.sequence(F.lit(0), cells - 1)))
        keys = ["shard", "cell", "block"]
        got = rows.groupBy(*keys).cogroup(ask.groupBy(*keys)).applyInArrow(_top(k + 1), "q bigint, vec_id bigint, score double, ids array<bigint>")
        best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        got = got.withColumn("__r", F.row_number().over(best)).where(F.col("__r") <= k + 1)
        return materialize(got.select("q", "score", F.explode("ids").alias("vec_id")), "ann-found")

    got = found(heads, visits)
    if visits < parts:
        enough = got.groupBy("q").count().where(F.col("count") >= min(k + 1, n_rows)).select("q")
        short = materialize(heads.join(enough, "q", "left_anti").select("v", "q"), "ann-short")
        if not short.isEmpty():
            got = got.join(enough, "q", "left_semi").unionByName(found(short, parts))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return members.join(got, "q").where("query_id != vec_id").withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
