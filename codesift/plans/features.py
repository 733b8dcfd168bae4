"""Features of code samples: TF-IDF, complexity, tree depth and rule hits."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift import fixed_values as fixed
from codesift.functions.structure import with_structure
from codesift.operators.findings import with_danger_count, with_findings
from codesift.operators.rules import Rule
from codesift.operators.tfidf import fitted_tfidf, vocabulary, with_tokens
from codesift.sources.tables import small_table


def prepared(df: DataFrame, rules: DataFrame | list[Rule] | None = None, code: str = "code",
             nest: bool = True) -> DataFrame:
    """Add ``tokens, complexity, ast_depth, danger_count`` and, nested, ``findings``.

    Every column comes from its own row, so this shuffles nothing. Findings are
    worked out once; the count is their number. Training needs only the count.
    """
    rows = with_tokens(with_structure(df, code), code)
    return with_findings(rows, rules, code) if nest else with_danger_count(rows, rules, code)


def fitted_features(train: DataFrame, include_rule_feature: bool = True,
                    size: int = fixed.VOCABULARY_SIZE) -> tuple[PipelineModel, list[str]]:
    """Transformer from prepared rows to sparse ``features``, and feature names.

    Fitted on training rows only. ``include_rule_feature=False`` leaves out the
    number of rule hits, from which mined labels derive.
    """
    model, words = fitted_tfidf(vocabulary(train, size=size))
    structure = [f for f in fixed.STRUCTURE_FEATURES
                 if include_rule_feature or f != "danger_count"]
    assembler = VectorAssembler(inputCols=["tfidf", *structure], outputCol="features")
    # A vocabulary is never empty for the vectorizer, so neither are the names.
    return PipelineModel([*model.stages, assembler]), [*(words or [" "]), *structure]


def feature_names(names: list[str], df: DataFrame) -> DataFrame:
    """Index to name table, for joining importances and attributions."""
    rows = list(enumerate(names))
    return small_table(df.sparkSession, rows, "index int, feature string")


def with_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights: rows / (2 * rows of the class).

    The class counts are two numbers, read as scalar subqueries.
    """
    counts = df.groupBy().agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("p"))
    rows = counts.select("n").scalar()
    positive = counts.select("p").scalar()
    weight = F.when(F.col(label) == 1, F.try_divide(rows, 2.0 * positive)).otherwise(
        F.try_divide(rows, 2.0 * (rows - positive)))
    return df.withColumn("weight", weight)
