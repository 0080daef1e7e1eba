"""Recipient lists (S13) with e-mail checks (P14) and order-preserving de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.functions.text import email_valid


def email_column(columns: list[str]) -> str:
    """First column whose name mentions mail, else the first column (decided at plan time)."""
    for c in columns:
        if "mail" in c.lower():
            return c
    return columns[0]


def read_recipients_csv(spark, path: str, order_col: str | None = None) -> DataFrame:
    df = spark.read.option("header", True).csv(path)
    col = email_column([c for c in df.columns if c != order_col])
    pos = F.col(order_col).cast("long") if order_col else F.monotonically_increasing_id()
    return df.select(pos.alias("pos"), F.col(col).alias("raw"))


def read_recipients_text(spark, path: str) -> DataFrame:
    """Text form: one or more comma-separated addresses per line, '#' starts a comment line."""
    df = spark.read.text(path).select(F.monotonically_increasing_id().alias("pos"), F.col("value").alias("raw"))
    return df.where(~F.trim(F.col("raw")).startswith("#"))


def clean_recipients(raw: DataFrame) -> DataFrame:
    """Split, trim, keep valid addresses, keep the first occurrence (position order)."""
    parts = raw.select("pos", F.posexplode(F.split(F.col("raw"), ",")).alias("part", "email"))
    parts = parts.select("pos", "part", F.trim(F.col("email")).alias("email")).where(email_valid("email"))
    return (parts.groupBy("email")
                 .agg(F.min(F.struct("pos", "part")).alias("first"))
                 .select("email", F.col("first.pos").alias("pos"), F.col("first.part").alias("part")))
