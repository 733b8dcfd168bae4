"""The tables a security report is made of, from scan results.

Scan results have ``file, status, confidence`` and
``details(complexity, ast_depth, dangerous_calls[])``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift import fixed_values as fixed
from codesift.functions.text import is_critical, or_not_available, percent


def scan_totals(results: DataFrame) -> DataFrame:
    vulnerable = F.count_if(F.col("status") == "VULNERABLE")
    return results.agg(
        F.count(F.lit(1)).alias("total_files"), vulnerable.alias("vulnerable_files"),
        (F.count(F.lit(1)) - vulnerable).alias("safe_files"),
    )


def risk_types(results: DataFrame) -> DataFrame:
    """Findings per type over vulnerable files.

    A vulnerable file without findings counts once as predicted by the model, and
    a finding without a type counts as generic.
    """
    calls = F.col("details.dangerous_calls")
    types = F.transform(calls, lambda c: F.coalesce(c["type"], F.lit(fixed.UNTYPED_RISK)))
    shown = F.when(F.size(calls) > 0, types).otherwise(F.array(F.lit(fixed.MODEL_ONLY_RISK)))
    return (
        results.filter(F.col("status") == "VULNERABLE")
        .select(F.explode(shown).alias("type"))
        .groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    )


def risk_type_count(results: DataFrame) -> DataFrame:
    return risk_types(results).agg(F.count(F.lit(1)).alias("risk_types"))


def vulnerable_details(results: DataFrame) -> DataFrame:
    """One row per finding of a vulnerable file; files without findings keep one row."""
    return (
        results.filter(F.col("status") == "VULNERABLE")
        .select("file", percent(F.col("confidence")).alias("confidence"),
                F.explode_outer("details.dangerous_calls").alias("f"))
        .select(
            "file", "confidence", "f.line", "f.content",
            F.coalesce("f.type", F.when(F.col("f").isNull(), fixed.MODEL_ONLY_RISK)
                       .otherwise(fixed.UNTYPED_RISK)).alias("type"),
            F.coalesce(is_critical(F.col("f.severity")), F.lit(False)).alias("is_critical"),
            or_not_available(F.col("f.cwe")).alias("cwe"),
            or_not_available(F.col("f.owasp")).alias("owasp"),
            "f.description", "f.remediation",
        )
    )


def safe_files(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status") != "VULNERABLE").select(
        "file", percent(F.col("confidence")).alias("confidence"), "status"
    )
