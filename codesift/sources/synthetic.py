"""Synthetic samples: rows drawn from the snippet table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift import fixed_values as fixed
from codesift.operators.samples import from_knowledge_base
from codesift.sources.tables import known_weaknesses, snippet_table


def with_snippet(df: DataFrame, draw: Column) -> DataFrame:
    """Give every row the snippet its draw points at.

    ``draw`` is any whole number; it is taken modulo the snippet count. The
    snippet table is fixed and tiny, so it is broadcast.
    """
    snippets = snippet_table(df.sparkSession)
    total = (
        len(fixed.VULNERABLE_SNIPPETS) + len(fixed.SAFE_SNIPPETS) + len(fixed.KNOWN_WEAKNESSES)
    )
    drawn = df.withColumn("snippet_id", F.pmod(draw, F.lit(total)).cast("int"))
    return drawn.join(F.broadcast(snippets), "snippet_id")


def drawn(rows: DataFrame, row_id: str, vulnerable: Column, seed: int = fixed.SEED) -> DataFrame:
    """``rows`` with ``code, is_vulnerable, cwe_id``, drawn by id with replacement.

    Rows where ``vulnerable`` holds get one of the vulnerable snippets, others a safe one.
    """
    bad, good = len(fixed.VULNERABLE_SNIPPETS), len(fixed.SAFE_SNIPPETS)
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string"))), 1, 8)
    number = F.conv(digits, 16, 10).cast("long")
    draw = F.when(vulnerable, number % bad).otherwise(bad + number % good)
    return with_snippet(rows, draw).select(
        *rows.columns, F.col("snippet").alias("code"), "is_vulnerable", "cwe_id")


def synthetic_samples(spark: SparkSession, num_samples: int = 100,
                      seed: int = fixed.SEED) -> DataFrame:
    """Half vulnerable, half safe, drawn with replacement, plus the knowledge base.

    An odd ``num_samples`` gives one row less. The rows come in random order.
    """
    half = num_samples // 2
    rows = drawn(spark.range(2 * half), "id", F.col("id") < half, seed).drop("id")
    return rows.unionByName(from_knowledge_base(known_weaknesses(spark))).orderBy(F.rand(seed))
