"""Counts that describe a sample table or a scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("is_vulnerable").agg(F.count(F.lit(1)).alias("n"))


def class_imbalance(df: DataFrame) -> DataFrame:
    vulnerable = F.coalesce(F.sum("is_vulnerable"), F.lit(0))
    return df.agg(vulnerable.alias("vulnerable"),
                  (F.count(F.lit(1)) - vulnerable).alias("safe"))


def language_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("language").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "language")


def cwe_distribution(df: DataFrame, split: bool = False) -> DataFrame:
    """CWEs of vulnerable samples, most frequent first.

    A sample with several CWEs counts as a category of its own; ``split`` counts
    it once for each instead.
    """
    vulnerable = df.filter(F.col("is_vulnerable") == 1).select("cwe_id")
    if split:
        vulnerable = vulnerable.select(F.explode(F.split("cwe_id", ";")).alias("cwe_id"))
    return vulnerable.groupBy("cwe_id").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "cwe_id")


def source_stats(df: DataFrame) -> DataFrame:
    """Files kept and files vulnerable per repository."""
    return df.groupBy("source").agg(
        F.count(F.lit(1)).alias("files"), F.sum("is_vulnerable").alias("vulnerable_files")
    )
