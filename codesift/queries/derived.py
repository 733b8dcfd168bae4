"""Inputs of the queries, derived by Spark from the given tables."""

from __future__ import annotations

import gc
import os
from functools import lru_cache

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift.plans import corpus as corpus_plan
from codesift.plans import evaluating
from codesift.plans.training import forest, split_features
from codesift.session import new_path, without_summary
from codesift.sources.code_files import filesystem_of, write_code_files


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return corpus_plan.table(spark, folder, name)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_plan.as_code(documents(spark, folder))


def judged(spark: SparkSession, folder: str) -> DataFrame:
    """Labels with two made-up scores: ``model, doc_id, label, score, prediction``."""
    both = table(spark, folder, "labels").join(
        table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id")
    first = (F.col("n_chars") * 7 + F.col("doc_id") * 13) % 97 / F.lit(96.0)
    second = (F.col("n_chars") + F.col("quality") * 40) % 101 / F.lit(100.0)
    scored = both.select(
        "doc_id", F.col("quality").alias("label"),
        F.inline(F.array(F.struct(F.lit("first").alias("model"), first.alias("score")),
                         F.struct(F.lit("second").alias("model"), second.alias("score")))),
    )
    return scored.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def results(spark: SparkSession, folder: str) -> DataFrame:
    """Scan results of the corpus with its own labels in place of a model's verdict."""
    from codesift.functions import text
    from codesift.operators.findings import with_findings
    from codesift.plans.scanning import with_details

    confidence = (F.col("doc_id") * 37 % 101) / F.lit(100.0)
    rows = with_findings(corpus(spark, folder)).withColumn("complexity", F.lit(1.0))
    rows = rows.withColumn("ast_depth", text.brace_depth(F.col("code")))
    return with_details(rows).select(
        F.concat(F.lit("doc_"), "doc_id", "language").alias("file"),
        text.status(F.col("is_vulnerable")).alias("status"), confidence.alias("confidence"),
        "details", F.lit("2024-01-01 00:00:00").alias("timestamp"),
    )


FILE_FOLDERS = ("src", "my_tests", ".hidden", "node_modules", "lib", "test_cases")


def file_path():
    """Path of a document as a file: source, a folder by id, extension by language."""
    folder = F.element_at(F.array(*[F.lit(f) for f in FILE_FOLDERS]),
                          (F.col("doc_id") % len(FILE_FOLDERS) + 1).cast("int"))
    name = F.concat(F.lit("_doc_"), "doc_id", "language")
    return F.concat_ws("/", "source", folder, name)


# Every so many documents, a file is a link that leads nowhere where some must be unreadable.
BROKEN = 7


def _break(root: str, paths: DataFrame) -> None:
    """Links that lead nowhere in place of files, made by tasks; local folders only."""
    _, base = filesystem_of(root)

    def link(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                target = os.path.join(base, path)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                if not os.path.islink(target):
                    os.symlink("nowhere", target)
            yield batch

    paths.select("path").mapInArrow(link, "path string").count()


@lru_cache(maxsize=4)
def _landed(app: str, folder: str, broken: bool) -> str:
    spark = SparkSession.active()
    root = new_path(spark, "files")
    rows = corpus(spark, folder).select(
        "doc_id", file_path().alias("path"), F.encode("code", "UTF-8").alias("content"))
    lost = F.lit(broken) & (F.col("doc_id") % BROKEN == 0)
    write_code_files(rows.filter(~lost), root)
    if broken:
        _break(root, rows.filter(lost))
    return root


def landed_files(spark: SparkSession, folder: str, broken: bool = False) -> str:
    """The corpus as one file per document, some of them broken; landed once per session."""
    return _landed(spark.sparkContext.applicationId, folder, broken)


@lru_cache(maxsize=4)
def _split(app: str, folder: str):
    samples = corpus(SparkSession.active(), folder).select("doc_id", "code", "is_vulnerable")
    return split_features(samples, "doc_id")


def split(spark: SparkSession, folder: str):
    """Train and test rows, features and names; once per session."""
    return _split(spark.sparkContext.applicationId, folder)


# The forest of each session and folder.
_FORESTS: dict[tuple[str, str], RandomForestClassificationModel] = {}


def trained(spark: SparkSession, folder: str):
    """Train and test rows, features, names and a forest; once per session."""
    rows, key = split(spark, folder), (spark.sparkContext.applicationId, folder)
    if key not in _FORESTS:
        _FORESTS[key] = without_summary(forest().fit(rows[0]))
    return *rows, _FORESTS[key]


def reloaded(spark: SparkSession, folder: str, path: str) -> RandomForestClassificationModel:
    """The forest stored at ``path``, from now on in place of the fitted one.

    Two forests of a million nodes do not fit in a small driver, so the first one goes before;
    a caller must not hold it any more.
    """
    key = spark.sparkContext.applicationId, folder
    _FORESTS.pop(key, None)
    gc.collect()
    spark._jvm.System.gc()
    _FORESTS[key], _ = evaluating.load_models(path)
    return _FORESTS[key]
