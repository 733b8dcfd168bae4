"""Scanning: score code with a fitted model and nest the details."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift.functions import text
from codesift.operators.rules import Rule
from codesift.plans.features import prepared
from codesift.session import without_summary
from codesift.sources.code_files import read_code_files
from codesift.sources.scan_reports import DETAILS_TYPE


def scan_target(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root`` as ``file, code, error``; empty files stay.

    A file that cannot be read keeps a row with an error and no code.
    """
    files = read_code_files(spark, root, "scanning")
    return files.select(
        F.col("path").alias("file"),
        text.normalize_newlines(text.decode_fallback(F.col("content"))).alias("code"),
        F.when(F.col("content").isNull(), "unreadable").alias("error"),
    )


def readable(target: DataFrame) -> DataFrame:
    return target.filter("error is null").drop("error")


def errors(target: DataFrame) -> DataFrame:
    return target.filter("error is not null").select("file", "error")


def scores(predictions: DataFrame) -> DataFrame:
    """Add ``score``, the probability of class 1, from any probabilistic model."""
    if "score" in predictions.columns:
        return predictions
    return predictions.withColumn("score", vector_to_array("probability")[1])


def with_details(df: DataFrame) -> DataFrame:
    """Nest ``complexity``, ``ast_depth`` and the findings as ``details``."""
    details = F.struct(F.col("complexity").cast("double"), "ast_depth",
                       F.transform("findings", lambda f: f.dropFields("rule_id"))
                       .alias("dangerous_calls"))
    return df.withColumn("details", details.cast(DETAILS_TYPE))


def scan_results(files: DataFrame, model: Transformer, features: PipelineModel | None = None,
                 rules: DataFrame | list[Rule] | None = None) -> DataFrame:
    """``file, status, confidence, details, timestamp`` of every row of ``file, code``.

    ``model`` is any fitted transformer that gives ``prediction`` and either
    ``probability`` or ``score``; ``features`` makes its input. All steps work
    within the row, so a scan shuffles nothing and also runs on a stream. Where ``files`` has
    an ``error``, rows with one keep it and get no verdict.
    """
    rows = prepared(files, rules)
    vectors = features.transform(rows) if features is not None else rows
    predicted = scores(without_summary(model).transform(vectors))
    verdict = {
        "status": text.status(F.col("prediction")), "confidence": F.col("score"),
        "details": F.col("details"),
        "timestamp": text.timestamp_text(F.current_timestamp()),
    }
    if "error" not in files.columns:
        return with_details(predicted).select("file", *[c.alias(n) for n, c in verdict.items()])
    return with_details(predicted).select(
        "file", *[F.when(F.col("error").isNull(), c).alias(n) for n, c in verdict.items()], "error")


def api_rows(results: DataFrame) -> DataFrame:
    """Scan results as answers to single uploads."""
    return results.select(
        F.col("file").alias("filename"), "status", "confidence", "details",
        text.message(F.col("status"), F.col("confidence")).alias("message"),
    )
