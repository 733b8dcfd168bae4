"""A code corpus over the given tables.

The tables hold prose. Each document gets one of the sample snippets as its first
lines, so that rules, labels and languages have something to find, and the whole
document text follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift.sources.synthetic import with_snippet


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_code(documents: DataFrame) -> DataFrame:
    """``doc_id, code, snippet, is_vulnerable, cwe_id, source, language, cve_id``."""
    return with_snippet(documents, F.col("doc_id")).select(
        "doc_id", F.concat("snippet", F.lit("\n"), "text").alias("code"), "snippet",
        "is_vulnerable", "cwe_id", "source", "language", "cve_id",
    )
