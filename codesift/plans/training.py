"""Training: forest grid, linear SVM with probabilities, learning curves."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift import fixed_values as fixed
from codesift.operators.metrics import best_setting
from codesift.operators.ranking import (
    hash_key,
    learning_curve_steps,
    sample_exactly,
    with_folds,
    with_test_flag,
)
from codesift.operators.samples import balanced
from codesift.plans.features import fitted_features, prepared, with_class_weight
from codesift.plans.trees import dense, forest_nodes, shares, sparse_rows, tree_groups
from codesift.plans.trials import run_trials
from codesift.session import new_path, without_summary, written
from codesift.sources.tables import small_table

# Rows of a part of a search's table: of small tables, and the most of a large one. A fit keeps
# some 4 KB of a row of a thousand features.
ROWS_PER_TASK = 2_500
MOST_ROWS_PER_TASK = 20_000
# Rows that the fits of a search hold side by side, at most, if there are more than one.
ROWS_SIDE_BY_SIDE = 160_000
# The deepest tree MLlib builds stands for "no limit".
DEEPEST_TREE = 30
# Counts of the nodes that a task splits at one time. Each task holds them twice over (its
# own, and what it sends or merges), next to the rows; more nodes take more passes.
SPLIT_MEMORY_MB = 64


def training_table(samples: DataFrame, row_id: str) -> DataFrame:
    """Balanced rows with ``label``, what models read, and ``is_test``; written once."""
    rows = prepared(balanced(samples, row_id), nest=False).select(
        row_id, "tokens", *fixed.STRUCTURE_FEATURES,
        F.col("is_vulnerable").cast("double").alias("label"))
    # The split is drawn over the written rows, so features are worked out once.
    return with_test_flag(written(rows, "training"), row_id)


def split_features(samples: DataFrame, row_id: str,
                   include_rule_feature: bool = True) -> tuple[DataFrame, DataFrame,
                                                               PipelineModel, list[str]]:
    """Train and test rows with ``features``; the vocabulary comes from train alone."""
    table = training_table(samples, row_id)
    model, names = fitted_features(table.filter(~F.col("is_test")), include_rule_feature)
    vectors = written(
        model.transform(table).select(row_id, "label", "features", "is_test"), "features")
    train = vectors.filter(~F.col("is_test")).drop("is_test")
    test = vectors.filter("is_test").drop("is_test")
    return train, test, model, names


def forest(trees: int = 100, depth: int | None = None, min_split: int = 2,
           class_weight: str | None = None, seed: int = fixed.SEED) -> RandomForestClassifier:
    """A random forest. A node that must hold ``min_split`` rows to split is met
    by children of at least half that many. Deep trees keep each row's node, so that
    rows need not be sent through the trees again at every level."""
    deepest = DEEPEST_TREE if depth is None else depth
    estimator = RandomForestClassifier(
        numTrees=trees, maxDepth=deepest, minInstancesPerNode=max(1, min_split // 2), seed=seed,
        featureSubsetStrategy="sqrt", maxMemoryInMB=SPLIT_MEMORY_MB, cacheNodeIds=deepest > 15,
    )
    return estimator.setWeightCol("weight") if class_weight == "balanced" else estimator


def grid_settings(grid: dict[str, tuple] | None = None) -> list[dict]:
    """All settings of a grid, in its order."""
    grid = grid or fixed.FOREST_GRID
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def bounded(train: DataFrame, row_id: str, max_rows: int | None) -> DataFrame:
    """``train``, or exactly ``max_rows`` of its rows in hash order if the caller wants no more."""
    if max_rows is None:
        return train
    return sample_exactly(train, row_id, lambda n, _: F.least(n, F.lit(max_rows)))


def _in_few_parts(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows in parts of ``ROWS_PER_TASK``: a small fit is one task a step, and fits
    side by side use the cores. Parts of a large table stay below ``MOST_ROWS_PER_TASK``."""
    parts = min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK))
    return rows.repartition(max(1, parts, -(-n // MOST_ROWS_PER_TASK)))


def _side_by_side(n: int, parallelism: int) -> int:
    """How many fits over ``n`` rows run at one time."""
    return max(1, min(parallelism, ROWS_SIDE_BY_SIDE // max(n, 1)))


def _right_predictions(model, rows: DataFrame, wanted: list[tuple[int, int, int]]) -> DataFrame:
    """``setting_id, right, n`` of ``rows``, for settings ``(id, trees, depth)`` of one forest.

    The first trees of a forest are a forest of that many, and a tree cut at a depth is one
    grown with that limit. So one fitted forest stands for all of these settings.
    """
    depths = sorted({depth for _, _, depth in wanted})
    sparse = sparse_rows(rows, F.col("row_id"), F.col("label").cast("double").alias("label"))
    parts, done = [], 0
    for trees in tree_groups(forest_nodes(model)):
        features = trees.features()
        shared = rows.sparkSession.sparkContext.broadcast(
            (trees, features, np.searchsorted(features, trees.feature)))

        def run(batches, shared=shared, done=done):
            trees, features, columns = shared.value
            for batch in batches:
                found = shares(trees, dense(batch, features), columns, depths)
                for setting, count, depth in wanted:
                    votes = found[depths.index(depth)][:, : max(0, count - done)].sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(votes), setting, np.int32)), batch.column("row_id"),
                         batch.column("label"), pa.array(votes / count)],
                        ["setting_id", "row_id", "label", "share"])

        parts.append(sparse.mapInArrow(run, "setting_id int, row_id string, label double, share double"))
        done += len(trees.roots)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    if len(parts) > 1:
        whole = whole.groupBy("setting_id", "row_id", "label").agg(F.sum("share").alias("share"))
    right = (F.col("share") > 0.5).cast("double") == F.col("label")
    return whole.groupBy("setting_id").agg(F.count_if(right).alias("right"), F.count("*").alias("n"))


GRID_SCHEMA = "setting_id int, right long, n long, fold int"


def grid_scores(train: DataFrame, row_id: str, settings: list[dict] | None = None,
                folds: int = fixed.FOLDS, parallelism: int = 8, max_rows: int | None = None,
                folder: str | None = None) -> DataFrame:
    """``setting_id, setting, score, folds, rows``: mean accuracy over the folds per setting.

    Settings that differ in the number of trees and the depth alone are read off one
    forest, the largest and deepest of them; class weights are those of the rows that a fit
    sees. Fits run side by side over one written table of all rows, or of ``max_rows`` in hash
    order where the caller asks for that. With a ``folder`` of an earlier call, fits that had
    finished there are not repeated.
    """
    spark = train.sparkSession
    settings = settings if settings is not None else grid_settings()
    folder = folder or new_path(spark, "trials")
    folded = written(with_folds(
        bounded(train, row_id, max_rows).select(
            F.col(row_id).cast("string").alias("row_id"), "label", "features"),
        "row_id", "label", folds), "folds")
    n = folded.count()
    data = written(_in_few_parts(folded, n), "folds")
    families: dict[tuple, list[tuple[int, int, int]]] = {}
    for at, setting in enumerate(settings):
        deepest = setting["depth"] or DEEPEST_TREE
        families.setdefault((setting["min_split"], setting["class_weight"]), []).append(
            (at, setting["trees"], deepest))

    def trial(family: tuple, fold: int):
        def run() -> DataFrame:
            wanted = families[family]
            part = data.filter(F.col("fold") != fold)
            estimator = forest(max(w[1] for w in wanted), max(w[2] for w in wanted), *family)
            model = estimator.fit(with_class_weight(part) if family[1] else part)
            held_out = data.filter(F.col("fold") == fold)
            return _right_predictions(model, held_out, wanted).withColumn("fold", F.lit(fold))

        return run

    trials = {f"{'-'.join(map(str, family))}-{fold}": trial(family, fold)
              for family in families for fold in range(folds)}
    scores = run_trials(spark, folder, trials, GRID_SCHEMA, _side_by_side(n, parallelism))
    names = small_table(spark, [(i, str(s)) for i, s in enumerate(settings)], "setting_id int, setting string")
    return scores.groupBy("setting_id").agg(
        F.avg(F.col("right") / F.col("n")).alias("score"), F.count("*").alias("folds"),
        F.sum("n").alias("rows")).join(F.broadcast(names), "setting_id").select(
        "setting_id", "setting", "score", "folds", "rows")


def grid_search(train: DataFrame, row_id: str, settings: list[dict] | None = None,
                folds: int = fixed.FOLDS, parallelism: int = 8, max_rows: int | None = None,
                folder: str | None = None) -> tuple[Model, DataFrame]:
    """The best setting fitted on all rows, and the scores of all settings."""
    settings = settings if settings is not None else grid_settings()
    table = written(grid_scores(train, row_id, settings, folds, parallelism, max_rows, folder), "grid")
    winner = {str(s): s for s in settings}[best_setting(table).first()["setting"]]
    return without_summary(forest(**winner).fit(with_class_weight(train))), table


class CalibratedSvm:
    """A linear SVM and the logistic curve that turns its margin into a probability."""

    def __init__(self, svm, curve: LogisticRegressionModel):
        self.svm, self.curve = svm, curve

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` (by margin) and ``score`` (probability of class 1)."""
        scored = _with_margin(self.svm.transform(df)).drop("rawPrediction")
        margin = F.get(vector_to_array("margin"), 0)
        slope, offset = float(self.curve.coefficients[0]), float(self.curve.intercept)
        return scored.withColumn("score", 1.0 / (1.0 + F.exp(-(slope * margin + offset)))).drop(
            "margin")

    def save(self, path: str) -> None:
        self.svm.write().overwrite().save(f"{path}/svm")
        self.curve.write().overwrite().save(f"{path}/curve")

    @classmethod
    def load(cls, path: str) -> "CalibratedSvm":
        from pyspark.ml.classification import LinearSVCModel

        return cls(LinearSVCModel.load(f"{path}/svm"), LogisticRegressionModel.load(f"{path}/curve"))


def _with_margin(scored: DataFrame) -> DataFrame:
    raw = scored.withColumn("_margin", vector_to_array("rawPrediction")[1])
    return VectorAssembler(inputCols=["_margin"], outputCol="margin").transform(raw).drop("_margin")


def linear_svm(rows: int, max_iter: int = 50) -> LinearSVC:
    """A soft-margin SVM of cost 1 over features as they are.

    The cost of a row against the margin is 1 in the sum over rows; MLlib takes the mean,
    so the penalty is 1 over the number of rows.
    """
    return LinearSVC(weightCol="weight", maxIter=max_iter, regParam=1.0 / max(rows, 1),
                     standardization=False)


def calibrated_svm(train: DataFrame, row_id: str, folds: int = fixed.FOLDS,
                   max_iter: int = 50) -> CalibratedSvm:
    """Balanced linear SVM; probabilities after Platt (1999) from out-of-fold margins."""
    data = written(with_folds(train, row_id, "label", folds), "folds")

    def fitted_on(rows: DataFrame):
        return without_summary(linear_svm(rows.count(), max_iter).fit(with_class_weight(rows)))

    margins = None
    for fold in range(folds):
        fitted = fitted_on(data.filter(F.col("fold") != fold))
        part = _with_margin(fitted.transform(data.filter(F.col("fold") == fold))).select(
            "label", "margin")
        margins = part if margins is None else margins.unionByName(part)
    curve = LogisticRegression(featuresCol="margin").fit(margins)
    return CalibratedSvm(fitted_on(data), curve)


CURVE_SCHEMA = "train_size long, fold int, train double, cv double"


def learning_curve(df: DataFrame, row_id: str, estimator: Estimator, folds: int = fixed.FOLDS,
                   fractions=fixed.LEARNING_CURVE_FRACTIONS, parallelism: int = 8,
                   max_rows: int | None = None, folder: str | None = None) -> DataFrame:
    """Train and validation accuracy per size and fold: ``train_size, fold, train, cv``.

    ``df`` has ``label`` and ``features``; all its rows take part, or ``max_rows`` in hash
    order where the caller asks for that. Each size takes the first rows of every fold's training set in hash
    order; only the cutoff keys come to the driver. Fits run side by side; with the
    ``folder`` of an earlier call, those that had finished there are not repeated. An
    estimator with a weight column gets balanced weights of each training set.
    """
    spark = df.sparkSession
    weighted = estimator.isDefined("weightCol")
    folder = folder or new_path(spark, "trials")
    rows = bounded(df.select(row_id, "label", "features"), row_id, max_rows)
    folded = written(with_folds(rows, row_id, "label", folds).withColumn("key", hash_key(F.col(row_id))), "folds")
    n = folded.count()
    folded = written(_in_few_parts(folded, n), "folds")

    def trial(step):
        def run() -> DataFrame:
            held_out = F.col("fold") == step["test_fold"]
            part = ~held_out & (F.col("key") <= step["cutoff"])
            fit = folded.filter(part)
            model = without_summary(estimator.copy().fit(with_class_weight(fit) if weighted else fit))
            right = (F.col("label") == F.col("prediction")).cast("double")
            scored = model.transform(folded.filter(part | held_out))
            return scored.agg(F.avg(F.when(~held_out, right)).alias("train"),
                              F.avg(F.when(held_out, right)).alias("cv")).select(
                F.lit(step["train_size"]).cast("long").alias("train_size"),
                F.lit(step["test_fold"]).alias("fold"), "train", "cv")

        return run

    steps = learning_curve_steps(folded, row_id, folds, fractions).collect()  # a row per fit
    trials = {f"{s['test_fold']}-{s['step']}": trial(s) for s in steps}
    return run_trials(spark, folder, trials, CURVE_SCHEMA, _side_by_side(n, parallelism))
