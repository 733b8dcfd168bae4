"""Declared schemas and the small built-in tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from codesift import fixed_values as fixed

SAMPLE_SCHEMA = "code string, is_vulnerable int, cwe_id string"
KNOWLEDGE_BASE_SCHEMA = (
    "cve_id string, description string, language string, code string, is_vulnerable int"
)
SNIPPET_SCHEMA = (
    "snippet_id int, snippet string, is_vulnerable int, cwe_id string, language string, "
    "cve_id string"
)
FILE_SCHEMA = "path string, content binary, length long"


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of a few rows that is part of the plan, so its size is known to Spark."""
    names = [column.split()[0] for column in schema.split(",")]
    columns = zip(*rows) if rows else [[] for _ in names]
    return spark.createDataFrame(
        pa.table({name: list(column) for name, column in zip(names, columns)}), schema)


def snippet_rows() -> list[tuple]:
    """Vulnerable snippets, safe snippets, then known weaknesses."""
    rows = [(code, 1, cwe, language, None) for code, cwe, language in fixed.VULNERABLE_SNIPPETS]
    rows += [(code, 0, fixed.NO_CWE, language, None) for code, language in fixed.SAFE_SNIPPETS]
    rows += [
        (code, 1, fixed.KNOWLEDGE_BASE_CWE, fixed.LANGUAGE_EXTENSIONS[language], cve_id)
        for cve_id, _, language, code in fixed.KNOWN_WEAKNESSES
    ]
    return [(i, *row) for i, row in enumerate(rows)]


def snippet_table(spark: SparkSession) -> DataFrame:
    return small_table(spark, snippet_rows(), SNIPPET_SCHEMA)


def known_weaknesses(spark: SparkSession) -> DataFrame:
    """The built-in knowledge base; every entry is a vulnerable sample."""
    rows = [(*entry, 1) for entry in fixed.KNOWN_WEAKNESSES]
    return small_table(spark, rows, KNOWLEDGE_BASE_SCHEMA)
