"""Mining: files of many repositories to a weakly labelled sample table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift import fixed_values as fixed
from codesift.functions import text
from codesift.operators import distributions
from codesift.operators.findings import weak_cwe, weak_label, with_findings
from codesift.operators.rules import Rule
from codesift.sources.code_files import read_code_files


def decoded(files: DataFrame) -> DataFrame:
    """``path, source, language, code`` of file rows; unreadable files drop.

    The first folder below ``root`` names the repository.
    """
    return files.filter("content is not null").select(
        "path", "source", text.extension(F.col("path")).alias("language"),
        text.normalize_newlines(text.decode_dropping(F.col("content"))).alias("code"),
    )


def in_length_band(df: DataFrame, code: str = "code") -> DataFrame:
    return df.filter(
        F.char_length(code).between(fixed.MINED_MIN_CHARS, fixed.MINED_MAX_CHARS)
    )


def labelled(df: DataFrame, rules: DataFrame | list[Rule] | None = None) -> DataFrame:
    """Weak labels from the rules: ``is_vulnerable`` and ``cwe_id``."""
    found = with_findings(df, rules)
    return found.withColumn("is_vulnerable", weak_label(F.col("findings"))).withColumn(
        "cwe_id", weak_cwe(F.col("findings"))
    ).drop("findings", "danger_count")


def mined_samples(spark: SparkSession, root: str,
                  rules: DataFrame | list[Rule] | None = None) -> DataFrame:
    """All repositories below ``root`` as one table; nothing is shuffled."""
    files = read_code_files(spark, root, "mining")
    below = F.substring("path", len(root.rstrip("/")) + 2, 1 << 30)
    with_source = files.withColumn("source", F.element_at(F.split(below, "/"), 1))
    return labelled(in_length_band(decoded(with_source)), rules).select(
        "code", "is_vulnerable", "cwe_id", "source", "language"
    )


def mining_summary(mined: DataFrame) -> dict[str, DataFrame]:
    return {
        "classes": distributions.class_distribution(mined),
        "languages": distributions.language_distribution(mined),
        "sources": distributions.source_stats(mined),
    }


def explored(samples: DataFrame) -> dict[str, DataFrame]:
    """Class and CWE distributions of a sample table."""
    return {
        "classes": distributions.class_distribution(samples),
        "cwes": distributions.cwe_distribution(samples),
    }
