"""Whole jobs from folders to folders: mine, explore, train, evaluate, scan, explain, drift.

A job reads and writes tables and gives its result tables by name, so it can be
called from a notebook or through ``python -m codesift``.
"""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift.operators import metrics, report
from codesift.operators.rules import Rule
from codesift.plans import evaluating, explaining, features, mining, scanning, training
from codesift.session import written
from codesift.sources import samples as sample_files
from codesift.sources import scan_reports

Tables = dict[str, DataFrame]


def mine(spark: SparkSession, root: str, out: str,
         rules: DataFrame | list[Rule] | None = None) -> Tables:
    """Repositories below ``root`` to the mined table at ``out`` (Parquet)."""
    sample_files.write_mined(mining.mined_samples(spark, root, rules), out)
    return mining.mining_summary(spark.read.parquet(out))


def load(spark: SparkSession, base: str | None = None, mined: str | None = None,
         **external) -> DataFrame:
    """Merged samples with a stable ``row_id``: the hash of the code, unique after
    deduplication. Written once, since every later step reads them."""
    merged = sample_files.load_samples(spark, base, mined, **external)
    return written(merged.withColumn("row_id", F.sha2("code", 256)), "samples")


def explore(samples: DataFrame) -> Tables:
    return mining.explored(samples)


def train(samples: DataFrame, models: str, settings: list[dict] | None = None,
          include_rule_feature: bool = True, row_id: str = "row_id") -> Tables:
    """Grid-searched forest and calibrated SVM, saved below ``models`` with the
    feature transformer, feature names and the scored test set."""
    train_rows, test_rows, feature_model, names = training.split_features(
        samples, row_id, include_rule_feature)
    forest, grid = training.grid_search(train_rows, row_id, settings)
    svm = training.calibrated_svm(train_rows, row_id)
    scored = evaluating.scored_test_set(
        {"Random Forest": forest, "SVM": svm}, test_rows, row_id)
    evaluating.save_models(models, forest, feature_model, scored)
    svm.save(models)
    features.feature_names(names, samples).write.mode("overwrite").parquet(f"{models}/names")
    test_rows.write.mode("overwrite").parquet(f"{models}/test")
    curve = learning_curve(train_rows, forest_like(forest), row_id)
    return {"grid": grid, **curve, **evaluating.evaluation(scored)}


def forest_like(model) -> Estimator:
    """A forest with the settings of a fitted one, not yet fitted."""
    weight = "balanced" if model.isDefined("weightCol") else None
    return training.forest(model.getNumTrees, model.getOrDefault("maxDepth"),
                           2 * model.getOrDefault("minInstancesPerNode"), weight)


def learning_curve(rows: DataFrame, estimator, row_id: str = "row_id") -> Tables:
    """Mean scores per training size, and the verdict on the last."""
    folds = training.learning_curve(rows, row_id, estimator)
    curve = metrics.fold_summary(folds, "train_size", ["train", "cv"])
    return {"learning_curve": curve, "diagnosis": metrics.fit_diagnosis(curve)}


def training_analysis(train_rows: DataFrame, test_rows: DataFrame,
                      row_id: str = "row_id") -> dict[str, Tables]:
    """Learning curves of a forest and a linear SVM over train and test rows together."""
    rows = train_rows.unionByName(test_rows)
    estimators = {"Random Forest": training.forest(trees=100),
                  "SVM": training.linear_svm(rows.count())}
    return {name: learning_curve(rows, e, row_id) for name, e in estimators.items()}


def evaluate(spark: SparkSession, models: str) -> Tables:
    """Evaluation tables of the stored test set, per model."""
    return evaluating.evaluation(evaluating.load_baseline(spark, models))


def scan(spark: SparkSession, root: str, models: str, out: str,
         rules: DataFrame | list[Rule] | None = None) -> Tables:
    """Files below ``root`` to a scan report at ``out``, and the tables of it."""
    forest, feature_model = evaluating.load_models(models)
    target = scanning.scan_target(spark, root)
    results = scanning.scan_results(target, forest, feature_model, rules)
    scan_reports.write_report(results, out)
    return {**report_tables(scan_reports.read_results(spark, out)),
            "errors": scan_reports.read_errors(spark, out)}


def report_tables(results: DataFrame) -> Tables:
    return {
        "totals": report.scan_totals(results), "risk_types": report.risk_types(results),
        "risk_type_count": report.risk_type_count(results),
        "vulnerable_files": report.vulnerable_details(results),
        "safe_files": report.safe_files(results),
    }


def explain(spark: SparkSession, models: str, row_id: str = "row_id") -> Tables:
    """Attributions of the stored forest over the stored test rows."""
    forest, _ = evaluating.load_models(models)
    names = spark.read.parquet(f"{models}/names")
    test = spark.read.parquet(f"{models}/test")
    return {"attributions": explaining.attribution_means(forest, test, row_id, names),
            "importances": explaining.importances(forest, names)}


def drift(spark: SparkSession, models: str, new_results: str | None = None) -> Tables:
    """Confidence of a newer scan against the stored scores; a rehearsal without one."""
    baseline = evaluating.load_baseline(spark, models).filter("model = 'Random Forest'")
    if new_results is None:
        return {"drift": evaluating.drift_rehearsal(baseline)}
    newer = scan_reports.read_results(spark, new_results).select(F.col("confidence").alias("score"))
    return {"drift": evaluating.score_drift(baseline.select("score"), newer)}
