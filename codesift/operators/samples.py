"""Labelled sample tables: adapters, union, deduplication, balancing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesift import fixed_values as fixed
from codesift.functions.text import truthy
from codesift.operators.ranking import sample_exactly

CANONICAL = ["code", "is_vulnerable", "cwe_id"]


def canonical(df: DataFrame) -> DataFrame:
    """The three sample columns; a missing ``cwe_id`` becomes "None"."""
    if "cwe_id" not in df.columns:
        df = df.withColumn("cwe_id", F.lit(fixed.NO_CWE))
    return df.select(*CANONICAL)


def from_function_table(df: DataFrame) -> DataFrame | None:
    """External functions with a text verdict; None if the columns are not there."""
    if not {"functionSource", "vulnerability"} <= set(df.columns):
        return None
    return df.select(
        F.col("functionSource").alias("code"), truthy(F.col("vulnerability")).alias("is_vulnerable"),
        F.lit(fixed.NOT_AVAILABLE).alias("cwe_id"),
    )


def from_patch_table(df: DataFrame) -> DataFrame | None:
    """External patches, all vulnerable; None if no column holds code."""
    code = next((c for c in fixed.PATCH_CODE_COLUMNS if c in df.columns), None)
    if code is None:
        return None
    cwe = F.col("cwe") if "cwe" in df.columns else F.lit(fixed.UNKNOWN_CWE)
    return df.select(F.col(code).alias("code"), F.lit(1).alias("is_vulnerable"),
                     cwe.alias("cwe_id"))


def from_knowledge_base(df: DataFrame) -> DataFrame:
    return df.select("code", "is_vulnerable", F.lit(fixed.KNOWLEDGE_BASE_CWE).alias("cwe_id"))


def union_by_rank(parts: list[DataFrame]) -> DataFrame:
    """Union by column name; ``source_rank`` keeps which part came first."""
    ranked = [p.withColumn("source_rank", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


def deduplicated(df: DataFrame, order: list[str], on: str = "code") -> DataFrame:
    """First row per code, by ``order`` (source rank, then row id).

    A minimum, not a window: copies fold before the shuffle, so a text that makes
    up a third of all rows does not meet in one task. Rows are grouped by digest, so
    that texts with a long common beginning are not compared byte by byte. What
    ``order`` leaves open goes by the other columns.
    """
    others = [c for c in df.columns if c != on and c not in order]
    first = df.groupBy(F.sha2(F.col(on).cast("binary"), 256).alias("_digest")).agg(
        F.min(F.struct(*order, *others, on)).alias("_first"))
    return first.select(*[F.col(f"_first.{c}").alias(c) for c in df.columns])


def dropped_duplicates(df: DataFrame, on: str = "code") -> DataFrame:
    """One row: rows in, rows kept, rows dropped."""
    per_code = df.groupBy(F.sha2(F.col(on).cast("binary"), 256)).agg(F.count(F.lit(1)).alias("copies"))
    return per_code.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_in"), F.count(F.lit(1)).alias("kept")
    ).withColumn("dropped", F.col("rows_in") - F.col("kept"))


def safe_rows_kept(safe: Column, total: Column) -> Column:
    """How many safe rows balancing keeps."""
    vulnerable = total - safe
    target = F.floor(vulnerable * F.lit(fixed.BALANCE_RATIO))
    return F.when(safe > vulnerable * F.lit(fixed.BALANCE_TRIGGER), target).otherwise(safe)


def balanced(df: DataFrame, row_id: str, label: str = "is_vulnerable",
             seed: int = fixed.SEED) -> DataFrame:
    """Downsample safe rows to an exact count when they are far too many."""
    return sample_exactly(df, row_id, safe_rows_kept, F.col(label) == 0, seed)
