import pytest
from llm import helpers as H

from hazelake.llm import anchors, graph, neardup, repeats, suffixes


@pytest.mark.parametrize("hot", [1, 1000])
def test_suffix_dedup_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(anchors, "HOT", hot)
    rows = H.awkward()
    assert H.by_row(suffixes.digests(H.frame(spark, rows)), "n_bytes", "n_removed", "n_spans", "kept_sha256") == H.repeated_bytes(rows)


@pytest.mark.parametrize("hot", [1, 1000])
def test_seed_extend_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(anchors, "HOT", hot)
    rows = H.awkward()
    assert H.by_row(repeats.digests(H.frame(spark, rows)), "n_words", "n_removed", "kept_sha256") == H.repeated_words(rows)


def test_seed_extend_removes_every_occurrence_of_a_hot_window(spark, monkeypatch):
    """Passages twice in document 2 with one context, and in document 1 with another: in other tasks."""
    monkeypatch.setattr(anchors, "HOT", 1)
    part = lambda name, i: " ".join(f"{name}{i}x{j}" for j in range(60))
    texts = {1: " ".join(f"{part('a', i)} {part('p', i)} {part('b', i)}" for i in range(12)),
             2: " ".join(f"{part('x', i)} {part('p', i)} {part('y', i)}" for i in [*range(12), *range(12)])}
    rows = [(i, t, None, None, None, None, None) for i, t in texts.items()]
    want = H.repeated_words(rows)
    assert want[1][2] == 2 * 12 * 60
    assert H.by_row(repeats.digests(H.frame(spark, rows)), "n_words", "n_removed", "kept_sha256") == want


def test_minmax_matches_brute_force(spark):
    rows = H.docs()
    got = {i: (r.n_shingles, r.component_id, r.kept) for i, r in H.by_id(neardup.near_duplicates(H.frame(spark, rows))).items()}
    assert got == H.near_duplicates(rows)


def test_minmax_links_through_chains_outside_the_first_node(spark):
    """Documents that are near the next one only: every link of the chain is found."""
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(12):
        text = list(base)
        for j in range(6 * i, 6 * i + 6):
            base[j] = f"c{i}x{j}"
        rows.append((i, " ".join(text), None, None, None, None, None))
    got = {i: r.component_id for i, r in H.by_id(neardup.near_duplicates(H.frame(spark, rows))).items()}
    assert got == {i: x[1] for i, x in H.near_duplicates(rows).items()}


def test_keep_first_keeps_columns_and_one_of_each_group(spark):
    rows = H.docs()
    df = H.frame(spark, rows)
    left = neardup.keep_first(df)
    want = H.near_duplicates(rows)
    ids = [r.doc_id for r in left.collect()]
    assert left.columns == df.columns
    assert sorted(i for i in ids if i is not None) == sorted(i for i in want if want[i][2])
    assert ids.count(None) == 1


def test_empty_tables(spark):
    empty = spark.createDataFrame([], H.SCHEMA)
    for f in (suffixes.digests, repeats.digests, neardup.near_duplicates):
        assert f(empty).count() == 0


def test_components_of_a_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 600)], "a long, b long")
    assert {r.node: r.component for r in graph.components(df).collect()} == {**{i: 0 for i in range(101)}, 500: 500, 600: 500}


def test_near_duplicate_sets_are_not_shuffled_again(spark, monkeypatch):
    """The sets come out of the join by doc_id, each row once, marked by the sides on which they are compared."""
    plans, real = {}, neardup.materialize

    def kept(df, name="stage"):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return plans.setdefault(f"{name}-table", real(df, name))
    monkeypatch.setattr(neardup, "materialize", kept)
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{text} {'x' * (i % 3)}", None, None, None, None, None) for i in (5, 6, 7, 6)] + [(9, "alone in this table", None, None, None, None, None)]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(H.frame(spark, rows)).collect()}
    assert got == {5: 5, 6: 5, 7: 5, 9: 9}
    before_sets = plans["minmax-sets"].split("MapInArrow")[0]
    assert "Exchange" not in before_sets
    sets = plans["minmax-sets-table"].collect()
    assert sorted((r.node, r.member, r.leads) for r in sets) == [(5, False, True), (6, True, True), (7, True, False)]


def test_near_duplicates_shuffle_few_texts_and_each_bucket_once(spark, monkeypatch):
    """Texts that no comparison needs, and kept ones, are not shuffled; the table of buckets is dealt once."""
    plans, real = {}, neardup.materialize

    def kept(df, name="stage"):
        out = real(df, name)
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(neardup, "materialize", kept)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = H.docs()
        left = neardup.keep_first(H.frame(spark, rows))
        want = H.near_duplicates(rows)
        assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(i for i in want if want[i][2])
        ids = spark.createDataFrame([(i,) for i in range(0, 3000, 100)], "node long")
        docs = spark.createDataFrame([(i, "x", i) for i in range(3000)] + [(None, "x", -1)], "doc_id long, held string, place long")
        seen = neardup.marked(docs, ids, "maybe")
        assert seen.columns == ["doc_id", "held", "place", "maybe"] and seen.count() == 3001
        true = {r.place for r in seen.where("maybe").collect()}
        assert {r.node for r in ids.collect()} <= true and len(true) < 130
        assert neardup.marked(docs, ids.where("false"), "maybe").where("maybe").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "REPARTITION_BY_COL" in plans["minmax-hits"] and "ENSURE_REQUIREMENTS" not in plans["minmax-hits"]   # alike on both sides: run once
    assert "BroadcastHashJoin" in plans["minmax-sets"]
