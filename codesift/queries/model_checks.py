"""What can be known of a model's results without the model: rows, labels, sums, bounds.

A fitted model cannot be rebuilt in SQL, but which rows it was tested on, what their labels
are, how many rows each fit saw, and what its numbers must add up to or lie between can.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift import fixed_values as fixed
from codesift.operators import metrics
from codesift.operators.findings import with_danger_count
from codesift.plans import embedding, evaluating, explaining, features, scanning, training
from codesift.queries.derived import corpus, documents, judged, reloaded, split, trained
from codesift.session import new_path, written

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _long(*names: str) -> list:
    return [F.col(n).cast("long").alias(n) for n in names]


def _share(name: str):
    return F.col(name).between(0.0, 1.0)


@lru_cache(maxsize=4)
def _grid(app: str, folder: str) -> DataFrame:
    train, *_ = split(SparkSession.active(), folder)
    return written(training.grid_scores(train, "doc_id"), "grid")


def grid(spark: SparkSession, folder: str) -> DataFrame:
    """The scores of the whole grid; once per session."""
    return _grid(spark.sparkContext.applicationId, folder)


@lru_cache(maxsize=4)
def _curve(app: str, folder: str) -> DataFrame:
    train, test, *_ = split(SparkSession.active(), folder)
    rows = train.unionByName(test)
    return written(training.learning_curve(rows, "doc_id", training.forest()), "curve")


def curve(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy at all sizes over all folds; once per session."""
    return _curve(spark.sparkContext.applicationId, folder)


@lru_cache(maxsize=4)
def _svm(app: str, folder: str):
    train, *_ = split(SparkSession.active(), folder)
    return training.calibrated_svm(train, "doc_id")


def svm(spark: SparkSession, folder: str):
    """The calibrated SVM; once per session."""
    return _svm(spark.sparkContext.applicationId, folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return corpus(spark, folder).select(F.concat(F.lit("doc_"), "doc_id", "language").alias("file"), "code")


@query
def grid_settings_scored(spark, folder):
    """Every setting of the grid, what its fits saw, and that it beats a coin."""
    return grid(spark, folder).select(
        "setting_id", "setting", *_long("folds", "rows"),
        F.col("score").between(0.5, 1.0).alias("in_bounds"))


@query
def best_grid_setting(spark, folder):
    """The winner is a setting of the grid that no other one beats."""
    table = grid(spark, folder)
    best = metrics.best_setting(table).select(F.col("score").alias("best"), F.col("setting").alias("winner"))
    return table.crossJoin(F.broadcast(best)).groupBy().agg(
        F.count_if(F.col("score") > F.col("best")).alias("better"),
        F.count_if((F.col("setting") == F.col("winner")) & (F.col("score") == F.col("best"))).alias("winners"))


@query
def learning_curve_cells(spark, folder):
    """Every size and fold of the learning curve."""
    rows = curve(spark, folder)
    return rows.select(*_long("train_size", "fold"),
                       (_share("train") & _share("cv")).alias("in_bounds"))


@query
def attribution_totals(spark, folder):
    """Attributions of every test row, with the base value, add up to its score."""
    _, test, _, _, model = trained(spark, folder)
    base = explaining.base_value(model).scalar()
    score = model.transform(test).select(
        "doc_id", "label", vector_to_array("probability")[1].alias("score"))
    sums = explaining.attribution_sums(model, test, "doc_id")
    return sums.join(score, "doc_id").select(
        "doc_id", "label", (F.abs(F.col("phi") + base - F.col("score")) < 1e-9).alias("adds_up"))


@query
def importance_total(spark, folder):
    """Importances are shares of one, and no feature is named twice."""
    _, test, _, names, model = trained(spark, folder)
    rows = explaining.importances(model, features.feature_names(names, test))
    return rows.agg(F.round(F.sum("importance"), 9).alias("total"),
                    (F.min("importance") >= 0).alias("none_negative"),
                    (F.count("*") - F.count_distinct("index")).alias("repeated"))


@query
def svm_test_rows(spark, folder):
    """Test rows with the SVM's probabilities in bounds; a higher one never turns the verdict back."""
    _, test, *_ = split(spark, folder)
    scored = svm(spark, folder).transform(test)
    edge = scored.groupBy().agg(
        F.max(F.when(F.col("prediction") == 0, F.col("score"))).alias("high"),
        F.min(F.when(F.col("prediction") == 1, F.col("score"))).alias("low"))
    apart = edge.select(F.coalesce(F.col("high") <= F.col("low"), F.lit(True))).scalar()
    return scored.select("doc_id", "label", (_share("score") & apart).alias("in_bounds"))


@query
def stored_test_rows(spark, folder):
    """The scored test set as it comes back from storage, scored again by the stored forest."""
    _, test, features_model, _, model = trained(spark, folder)
    path = new_path(spark, "models")
    scored = evaluating.scored_test_set({"Random Forest": model}, test, "doc_id")
    evaluating.save_models(path, model, features_model, scored)
    del model, scored
    loaded = reloaded(spark, folder, path)
    again = scanning.scores(loaded.transform(test)).select("doc_id", F.col("score").alias("again"))
    stored = evaluating.load_baseline(spark, path)
    return stored.join(again, "doc_id").select(
        "doc_id", "label", (F.col("score") == F.col("again")).alias("same"),
        ((F.col("score") > 0.5).cast("double") == F.col("prediction")).alias("verdict_follows"))


@query
def evaluation_supports(spark, folder):
    """Rows of each class behind the evaluation of both models, and its rates in bounds."""
    _, test, _, _, model = trained(spark, folder)
    scored = evaluating.scored_test_set({"forest": model, "svm": svm(spark, folder)}, test, "doc_id")
    tables = evaluating.evaluation(scored)
    confusion = tables["confusion"].groupBy("model", F.col("label").cast("long").alias("label")).agg(
        F.sum("n").alias("support"))
    rates = tables["auc"].select("model", F.col("auc").between(0.5, 1.0).alias("better_than_chance"))
    return confusion.join(F.broadcast(rates), "model")


@query
def scan_verdicts(spark, folder):
    """Scanned files: verdicts follow the confidence, findings are those of the rules."""
    _, _, features_model, _, model = trained(spark, folder)
    found = scanning.scan_results(_files(spark, folder), model, features_model)
    return found.select(
        "file", ((F.col("status") == "VULNERABLE") == (F.col("confidence") > 0.5)).alias("verdict_follows"),
        _share("confidence").alias("in_bounds"),
        F.size("details.dangerous_calls").cast("long").alias("calls"))


@query
def upload_messages(spark, folder):
    """Answers to uploads: the message says what the verdict is."""
    _, _, features_model, _, model = trained(spark, folder)
    files = corpus(spark, folder).select(F.col("doc_id").cast("string").alias("file"), "code")
    rows = scanning.api_rows(scanning.scan_results(files, model, features_model))
    return rows.select("filename", _share("confidence").alias("in_bounds"),
                       F.contains(F.upper("message"), F.upper("status")).alias("message_says_it"))


@query
def own_model_scan(spark, folder):
    """A scan with a model of the user's: files with rule hits are vulnerable, by their number."""
    model = SQLTransformer(statement=(
        "SELECT *, CAST(danger_count > 0 AS DOUBLE) AS prediction, "
        "danger_count / (danger_count + 1.0D) AS score FROM __THIS__"))
    files = with_danger_count(_files(spark, folder))
    found = scanning.scan_results(files, model)
    return found.select("file", "status", F.round("confidence", 6).alias("confidence"),
                        F.size("details.dangerous_calls").cast("long").alias("calls"))


@query
def score_drift_samples(spark, folder):
    """How many scores a drift check compares, and its statistic in bounds."""
    train, test, _, _, model = trained(spark, folder)
    base = evaluating.scored_test_set({"forest": model}, test, "doc_id")
    new = evaluating.scored_test_set({"forest": model}, train, "doc_id")
    return evaluating.score_drift(base.select("score"), new.select("score")).select(
        *_long("n_base", "n_new"), (_share("d") & _share("p_value")).alias("in_bounds"))


@query
def rehearsal_samples(spark, folder):
    """The rehearsal compares the scores with as many noisy ones."""
    scored = judged(spark, folder).filter("model = 'first'").select("score")
    return evaluating.drift_rehearsal(scored).select(
        *_long("n_base", "n_new"), (_share("d") & _share("p_value")).alias("in_bounds"))


EMBEDDED_LETTERS = "aeinorst"


@query
def letter_embeddings(spark, folder):
    """Vectors of whole documents by an encoder whose weights are a file sent to the workers."""
    weights = written(spark.range(len(EMBEDDED_LETTERS)).select(
        F.col("id").alias("at"), (F.col("id") * 2 + 1).cast("float").alias("weight")), "weights")
    encoder = embedding.letter_encoder(EMBEDDED_LETTERS, weights)
    rows = embedding.with_embedding(
        documents(spark, folder).select("doc_id", "text"), "text", encoder)
    return rows.select("doc_id", *[
        F.get("embedding", i).cast("long").alias(f"v{i}") for i in range(len(EMBEDDED_LETTERS))])


def _text(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def twins(corpus_sql: str, scan_sql: str, key: str) -> dict[str, str]:
    """SQL for the queries above; the arguments are shared parts of other twins."""
    split = (
        f"{corpus_sql}, sizes AS (SELECT sum(is_vulnerable) AS v, count(*) - sum(is_vulnerable) AS s "
        "FROM corpus), ranked AS (SELECT doc_id, is_vulnerable, row_number() OVER "
        f"(PARTITION BY is_vulnerable ORDER BY {key}) AS place FROM corpus), "
        "chosen AS (SELECT doc_id, is_vulnerable AS label FROM ranked, sizes WHERE is_vulnerable = 1 "
        f"OR place <= CASE WHEN s > CAST(v AS DOUBLE) * CAST({fixed.BALANCE_TRIGGER} AS DOUBLE) "
        f"THEN floor(CAST(v AS DOUBLE) * CAST({fixed.BALANCE_RATIO} AS DOUBLE)) ELSE s END), "
        f"split AS (SELECT doc_id, CAST(label AS DOUBLE) AS label, row_number() OVER (ORDER BY {key}) <= "
        f"ceil((SELECT count(*) FROM chosen) * CAST({fixed.TEST_FRACTION} AS DOUBLE)) AS is_test FROM chosen)"
    )
    settings = ", ".join(f"({i}, {_text(s)})" for i, s in enumerate(training.grid_settings()))
    fractions = ", ".join(f"({f})" for f in fixed.LEARNING_CURVE_FRACTIONS)
    letters = ", ".join(
        f"(length(coalesce(text, '')) - length(replace(coalesce(text, ''), '{c}', ''))) * {2 * i + 1} AS v{i}"
        for i, c in enumerate(EMBEDDED_LETTERS))
    tested = "SELECT doc_id, label, TRUE AS {} FROM split WHERE is_test"
    file = "'doc_' || c.doc_id || c.language AS file"
    hits = "LEFT JOIN hits h ON c.doc_id = h.doc_id GROUP BY ALL"
    return {
        "grid_settings_scored":
            f"WITH {split} SELECT CAST(i AS INTEGER) AS setting_id, setting, CAST({fixed.FOLDS} AS BIGINT) "
            f"AS folds, (SELECT count(*) FROM split WHERE NOT is_test) AS rows, "
            f"TRUE AS in_bounds FROM (VALUES {settings}) g(i, setting)",
        "best_grid_setting": "SELECT CAST(0 AS BIGINT) AS better, CAST(1 AS BIGINT) AS winners",
        "learning_curve_cells":
            f"WITH {split}, "
            f"folded AS (SELECT (row_number() OVER (PARTITION BY label ORDER BY {key}) - 1) % {fixed.FOLDS} "
            "AS fold FROM split), per AS (SELECT fold, count(*) AS n FROM folded GROUP BY 1), "
            "least_rows AS (SELECT sum(n) - max(n) AS n FROM per) "
            "SELECT CAST(floor(CAST(f AS DOUBLE) * n) AS BIGINT) AS train_size, CAST(fold AS BIGINT) AS fold, "
            f"TRUE AS in_bounds FROM least_rows, per AS p(fold, m), (VALUES {fractions}) s(f)",
        "attribution_totals": f"WITH {split} {tested.format('adds_up')}",
        "importance_total":
            "SELECT CAST(1 AS DOUBLE) AS total, TRUE AS none_negative, CAST(0 AS BIGINT) AS repeated",
        "svm_test_rows": f"WITH {split} {tested.format('in_bounds')}",
        "stored_test_rows":
            f"WITH {split} SELECT doc_id, label, TRUE AS same, TRUE AS verdict_follows FROM split WHERE is_test",
        "evaluation_supports":
            f"WITH {split} SELECT model, CAST(label AS BIGINT) AS label, count(*) AS support, "
            "TRUE AS better_than_chance FROM split, (VALUES ('forest'), ('svm')) m(model) "
            "WHERE is_test GROUP BY 1, 2",
        "scan_verdicts":
            f"WITH {scan_sql} SELECT {file}, TRUE AS verdict_follows, TRUE AS in_bounds, "
            f"count(h.rule_id) AS calls FROM corpus c {hits}",
        "upload_messages":
            "SELECT CAST(doc_id AS VARCHAR) AS filename, TRUE AS in_bounds, TRUE AS message_says_it FROM documents",
        "own_model_scan":
            f"WITH {scan_sql} SELECT {file}, CASE WHEN count(h.rule_id) > 0 THEN 'VULNERABLE' ELSE 'SAFE' END "
            "AS status, round(count(h.rule_id) / (count(h.rule_id) + 1.0::DOUBLE), 6) AS confidence, "
            f"count(h.rule_id) AS calls FROM corpus c {hits}",
        "score_drift_samples":
            f"WITH {split} SELECT count(*) FILTER (is_test) AS n_base, count(*) FILTER (NOT is_test) AS n_new, "
            "TRUE AS in_bounds FROM split",
        "rehearsal_samples":
            "SELECT count(*) AS n_base, count(*) AS n_new, TRUE AS in_bounds "
            "FROM labels l JOIN documents d ON l.doc_id = d.doc_id",
        "letter_embeddings": f"SELECT doc_id, {letters} FROM documents",
    }
