"""A training-data pipeline over ``documents``: every stage works on all that the one before kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read again as the next one's docs. All but the last return the columns
of documents. Defined cases: null texts go through the quality stage like empty ones and are
judged by it; an empty table stays empty; further columns pass unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazelake.llm import bpe, decontam, neardup, pii, quality
from hazelake.llm.arrays import table, unused
from hazelake.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject."""
    return quality.drop_low(docs, table(spark, sf_dir, "labels"))


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (shingles of five words, similarity of 0.8)."""
    return neardup.keep_first(docs, shingle=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than one word in twenty comes from a benchmark window."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates for personal data; n_chars follows a changed text."""
    if "n_chars" not in docs.columns:
        return pii.replace(docs)
    kind = docs.schema["n_chars"].dataType
    count, = unused(docs.columns, "replaced")
    out = pii.replace(docs, out_count=count)
    changed = (F.col(count) > 0) & F.col("n_chars").isNotNull()
    return out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))).select(*[F.col(f"`{c}`") for c in docs.columns])


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the text decoded from them."""
    return bpe.encode_decode(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [("quality", quality_stage), ("neardup", neardup_stage), ("decontamination", decontamination_stage),
          ("pii", pii_stage), ("bpe", bpe_stage)]

#: No SQL: the classifier is trained, so the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
