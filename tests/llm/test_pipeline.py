import os

import pytest
from llm import helpers as H
from pyspark.sql import functions as F

from hazelake.llm import quality

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decide(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= before, name
        if name == "neardup":
            want = H.near_duplicates([tuple(r) for r in docs.select("doc_id", "text").collect()], 5, 80)
            assert set(ids) == {i for i in want if want[i][2]}
        docs, before = out, set(ids)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in last.select("doc_id").collect()} == before


CLASH = ["quality_score", "decontam", "gone", "twice", "text_id", "surrogate_of", "name_words", "text_parts", "replaced", "n_hit", "ids", "bands"]


def written(spark, folder, rows):
    """Tables of the pipeline; documents have further columns named like those of the stages."""
    docs = H.frame(spark, rows)
    for c in CLASH:
        docs = docs.withColumn(c, F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(60)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    text = next((t for i, t, *_ in rows if i == 1), "")
    spark.createDataFrame([("b1", text)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), docs


def test_stages_on_awkward_rows_and_clashing_names(spark, tmp_path, monkeypatch):
    import corpus_pipeline
    rows = H.docs()
    rows.append((900, "write to jane.doe@mail.test now", "en", "s", 31, None, None))
    folder, docs = written(spark, tmp_path / "full", rows)
    monkeypatch.setattr(quality, "fit", lambda *a, **k: quality.Machine(0.9))   # rejects nothing
    want = H.near_duplicates(rows, 5, 80)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for r in got for c in CLASH), name
        ids = sorted(r.doc_id for r in got if r.doc_id is not None)
        if name == "neardup":
            assert ids == sorted(i for i in want if want[i][2]) and len(got) == len(ids) + 1
        if name == "decontamination":
            assert 1 not in ids and 900 in ids
        if name == "pii":
            assert next(r.text for r in got if r.doc_id == 900).startswith("write to ") and "jane.doe" not in str(got)
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert len(last) == len(got) and {r.doc_id: r.text for r in last} == {r.doc_id: r.text or "" for r in got}


def test_run_whole_and_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline
    folder, docs = written(spark, tmp_path / "full", H.docs())
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "n_tokens", "ids", "text"] and 0 < out.count() <= docs.count()
    folder, _ = written(spark, tmp_path / "none", [])
    assert corpus_pipeline.run(spark, folder).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_registered_queries(spark):
    import __spark_entry__ as E
    names = [q for q in E.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))
    assert "pipeline" in E.queries()
    assert E.queries()["op3_decontaminate"](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
