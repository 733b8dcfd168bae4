import numpy as np
import pytest
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from codesift.functions.text import tokens
from codesift.operators import tfidf
from codesift.plans import embedding, evaluating, explaining, features, scanning, training, trees
from codesift.session import new_path
from codesift.sources.synthetic import with_snippet
from codesift.streaming import jobs


@pytest.fixture(scope="module")
def samples(spark):
    drawn = with_snippet(spark.range(240), F.col("id"))
    code = F.concat("snippet", F.lit("\n"), F.lit("int v"), F.col("id"), F.lit(";"))
    return drawn.select("id", code.alias("code"), "is_vulnerable")


@pytest.fixture(scope="module")
def fitted(spark, samples):
    train, test, feature_model, names = training.split_features(samples, "id")
    model = training.forest(trees=12, depth=6).fit(train)
    return train, test, feature_model, names, model


def test_split_sizes(fitted, samples):
    train, test, _, names, _ = fitted
    assert (train.count(), test.count()) == (192, 48)
    assert train.select("id").intersect(test.select("id")).count() == 0
    assert names[-3:] == ["complexity", "ast_depth", "danger_count"]
    assert train.first()["features"].size == len(names)


def test_tfidf_by_hand(spark):
    docs = ["a b b # a", "b c", "c c d é", ""]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, code string")
    df = tfidf.with_tokens(df)
    bags = [["a", "b", "b"], ["b", "c"], ["c", "c", "d", "é"], []]
    vocabulary = {r["token"]: r for r in tfidf.vocabulary(df).collect()}
    idf = {}
    for token in "abcdé":
        documents = sum(token in bag for bag in bags)
        idf[token] = np.log(5 / (1 + documents)) + 1
        assert vocabulary[token]["idf"] == pytest.approx(idf[token])
        assert vocabulary[token]["term_count"] == sum(bag.count(token) for bag in bags)
    got = {(r["id"], r["token"]): r["tfidf"] for r in tfidf.tfidf_rows(df, "id").collect()}
    want = {}
    for i, bag in enumerate(bags):
        weights = {t: bag.count(t) * idf[t] for t in set(bag)}
        norm = np.sqrt(sum(w * w for w in weights.values()))
        want.update({(i, t): w / norm for t, w in weights.items()})
    assert got == pytest.approx(want)
    top = tfidf.vocabulary(df, size=2).collect()
    assert {r["token"] for r in top} == {"b", "c"}
    joined = tfidf.known_tokens(df, "id", tfidf.vocabulary(df, size=2)).collect()
    assert {(r["id"], r["token"], r["n"]) for r in joined} == {
        (0, "b", 2), (1, "b", 1), (1, "c", 1), (2, "c", 2)}


def test_empty_vocabulary(spark):
    df = spark.createDataFrame([("+-*",)], "code string").withColumn("tokens", tokens(F.col("code")))
    assert tfidf.tfidf_rows(df.withColumn("id", F.lit(1)), "id").count() == 0


def test_forest_learns_and_scans(spark, fitted):
    _, test, feature_model, _, model = fitted
    scored = evaluating.scored_test_set({"forest": model}, test, "id")
    tables = evaluating.evaluation(scored)
    assert tables["auc"].first()["auc"] > 0.8
    files = spark.createDataFrame(
        [("a.c", "int main() { return 0; }"), ("b.c", "gets(buffer);"), ("empty.c", "")],
        "file string, code string")
    rows = {r["file"]: r for r in scanning.scan_results(files, model, feature_model).collect()}
    assert set(rows) == {"a.c", "b.c", "empty.c"}
    for r in rows.values():
        assert r["status"] in ("VULNERABLE", "SAFE") and 0 <= r["confidence"] <= 1
    assert rows["b.c"]["details"]["dangerous_calls"][0]["cwe"] == "CWE-242"
    assert rows["empty.c"]["details"]["ast_depth"] == 1


def test_models_survive_saving(spark, fitted):
    _, test, feature_model, _, model = fitted
    path = new_path(spark, "test-models")
    scored = evaluating.scored_test_set({"forest": model}, test, "id")
    evaluating.save_models(path, model, feature_model, scored)
    loaded, loaded_features = evaluating.load_models(path)
    again = evaluating.scored_test_set({"forest": loaded}, test, "id")
    assert sorted(again.collect()) == sorted(scored.collect())
    assert evaluating.load_baseline(spark, path).count() == 48
    assert len(loaded_features.stages) == len(feature_model.stages)


def test_rule_feature_can_be_left_out(samples):
    prepared = features.prepared(samples, nest=False)
    _, names = features.fitted_features(prepared, include_rule_feature=False)
    assert names[-2:] == ["complexity", "ast_depth"]


def test_grid_settings(spark):
    settings = training.grid_settings()
    assert len(settings) == 36 and settings[0] == {
        "trees": 100, "depth": None, "min_split": 2, "class_weight": "balanced"}
    assert training.forest(**settings[0]).getMaxDepth() == 30


def test_split_counts_leave_room_for_rows():
    assert training.forest().getMaxMemoryInMB() <= 128


def test_models_of_a_session_that_has_observed(spark):
    session = spark.newSession()
    rows = session.range(60).select(
        "id", (F.col("id") % 2).cast("double").alias("label"),
        array_to_vector(F.array((F.col("id") % 2 + F.col("id") % 3).cast("double"))).alias("features"))
    seen = Observation()
    rows.observe(seen, F.count("*").alias("n")).collect()
    forest = training.forest(trees=2, depth=2).fit(rows)
    svm = training.calibrated_svm(rows, "id", folds=2, max_iter=2)
    assert forest.hasSummary
    assert evaluating.scored_test_set({"forest": forest, "svm": svm}, rows, "id").count() == 120
    curve = training.learning_curve(rows, "id", training.forest(trees=2, depth=2), folds=2, fractions=(1.0,))
    assert curve.count() == 2


def test_grid_search(spark, fitted):
    settings = [{"trees": t, "depth": d, "min_split": 2, "class_weight": w}
                for w in ("balanced", None) for t, d in ((3, 3), (6, None), (6, 2))]
    folder = new_path(spark, "grid")
    model, table = training.grid_search(fitted[0], "id", settings, folds=2, folder=folder)
    rows = {r["setting_id"]: r for r in table.collect()}
    assert set(rows) == set(range(6))
    for i, r in rows.items():
        assert r["setting"] == str(settings[i]) and 0.5 < r["score"] <= 1
        assert (r["folds"], r["rows"]) == (2, 192)
    assert model.getNumTrees in (3, 6)


def test_finished_trials_are_not_repeated(spark, fitted, monkeypatch):
    folder = new_path(spark, "grid")
    settings = [{"trees": 2, "depth": 2, "min_split": 2, "class_weight": None}]
    first = training.grid_scores(fitted[0], "id", settings, folds=2, folder=folder).collect()
    monkeypatch.setattr(training, "forest", lambda *_: pytest.fail("fitted again"))
    assert training.grid_scores(fitted[0], "id", settings, folds=2, folder=folder).collect() == first


def test_settings_are_read_off_one_forest(spark, fitted, monkeypatch):
    train, test, _, _, model = fitted
    rows = test.withColumn("row_id", F.col("id").cast("string"))
    right = model.transform(test).filter("prediction = label").count()
    wanted = [(0, 12, 30), (1, 12, 6), (2, 1, 30), (3, 12, 0)]
    for limit in (1_000_000, 40):
        monkeypatch.setattr(trees, "NODES_PER_GROUP", limit)
        found = {r["setting_id"]: r for r in training._right_predictions(model, rows, wanted).collect()}
        assert found[0]["right"] == found[1]["right"] == right and found[0]["n"] == 48
        first = model.trees[0].transform(test).filter("prediction = label").count()
        assert found[2]["right"] == first
        # Cut at the root, a forest says the same of every row.
        positive = test.filter("label = 1").count()
        assert found[3]["right"] in (positive, 48 - positive)


def test_fits_are_bounded(fitted):
    scores = training.grid_scores(
        fitted[0], "id", [{"trees": 2, "depth": 2, "min_split": 2, "class_weight": None}], folds=2, max_rows=50)
    assert scores.first()["rows"] == 50


def test_svm_probabilities(spark, fitted):
    train, test, *_ = fitted
    model = training.calibrated_svm(train, "id", folds=2, max_iter=5)
    path = new_path(spark, "test-svm")
    model.save(path)
    rows = training.CalibratedSvm.load(path).transform(test).orderBy("id").collect()
    assert all(0 < r["score"] < 1 and r["prediction"] in (0.0, 1.0) for r in rows)
    mean = {p: np.mean([r["score"] for r in rows if r["label"] == p]) for p in (0.0, 1.0)}
    assert mean[1.0] > mean[0.0]


def test_learning_curve(spark, fitted):
    folder = new_path(spark, "curve")
    curve = training.learning_curve(fitted[0], "id", training.forest(trees=2, depth=2), folds=2,
                                    fractions=(0.5, 1.0), folder=folder).collect()
    assert len(curve) == 4 and {r["fold"] for r in curve} == {0, 1}
    assert {r["train_size"] for r in curve} == {48, 96}
    assert all(0 <= r["cv"] <= 1 and 0.5 < r["train"] <= 1 for r in curve)


def test_attributions_add_up(spark, fitted, monkeypatch):
    _, test, _, names, model = fitted
    base = explaining.base_value(model).first()["base_value"]
    rows = explaining.attributions(model, test, "id")
    totals = {r["id"]: r["s"] + base for r in
              rows.groupBy("id").agg(F.sum("phi").alias("s")).collect()}
    predicted = {r["id"]: r["p"] for r in model.transform(test).select(
        "id", vector_to_array("probability")[1].alias("p")).collect()}
    assert totals == pytest.approx(predicted, abs=1e-12)
    assert {r["id"]: r["phi"] + base for r in explaining.attribution_sums(model, test, "id").collect()
            } == pytest.approx(predicted, abs=1e-12)
    named = features.feature_names(names, test)
    means = {r["feature"]: r["mean_abs_phi"] for r in
             explaining.attribution_means(model, test, "id", named).collect()}
    assert set(means) <= set(names) and means == pytest.approx(
        {r["feature"]: r["mean_abs_phi"] for r in explaining.attribution_summary(rows, named).collect()})
    monkeypatch.setattr(trees, "NODES_PER_GROUP", 30)
    grouped = {(r["id"], r["index"]): r["phi"] for r in
               explaining.attributions(model, test, "id").collect()}
    whole = {(r["id"], r["index"]): r["phi"] for r in rows.collect() if (r["id"], r["index"]) in grouped}
    assert grouped == pytest.approx(whole, abs=1e-12)
    assert means == pytest.approx({
        r["feature"]: r["mean_abs_phi"] for r in explaining.attribution_means(model, test, "id", named).collect()})


def random_tree(rng, depth):
    """Nodes of a grown tree: (feature, threshold, left, right, cover, value), leaves without children."""
    nodes = []

    def grow(cover, left_depth):
        at = len(nodes)
        nodes.append(None)
        if left_depth == 0 or cover < 2 or rng.random() < 0.15:
            nodes[at] = (0, 0.0, -1, -1, cover, rng.random())
        else:
            share = rng.uniform(0.1, 0.9)
            left, right = grow(cover * share, left_depth - 1), grow(cover * (1 - share), left_depth - 1)
            nodes[at] = (rng.randrange(4), rng.choice([0.2, 0.5, 0.7]), left, right, cover, 0.0)
        return at

    grow(1000.0, depth)
    f, t, left, right, cover, value = map(np.array, zip(*nodes))
    return trees.Trees(np.array([0]), left, right, f, t, cover, value)


@pytest.mark.parametrize("seed", range(6))
def test_attributions_are_shapley_values(seed):
    import random
    from itertools import combinations
    from math import factorial

    tree = random_tree(random.Random(seed), 2 + seed)
    x = np.random.default_rng(seed).random((5, 4))
    phi = np.zeros((5, 4))
    explaining.add_attributions(tree, tree.feature, x, phi)

    def worth(row, known, node=0):
        if tree.left[node] < 0:
            return tree.value[node]
        f, children = tree.feature[node], (tree.left[node], tree.right[node])
        if f in known:
            return worth(row, known, children[int(row[f] > tree.threshold[node])])
        return sum(worth(row, known, c) * tree.cover[c] / tree.cover[node] for c in children)

    for r in range(5):
        for f in range(4):
            others = [g for g in range(4) if g != f]
            want = sum(
                factorial(k) * factorial(3 - k) / 24 * (worth(x[r], {*s, f}) - worth(x[r], set(s)))
                for k in range(4) for s in combinations(others, k))
            assert phi[r, f] == pytest.approx(want, abs=1e-12)


class AlwaysSafe(Transformer):
    """A stand-in model: any transformer with prediction and score will do."""

    def _transform(self, df):
        return df.withColumn("prediction", F.lit(0.0)).withColumn("score", F.lit(0.1))


def test_user_model_and_odd_bytes(spark):
    uploads = spark.createDataFrame([("w.c", b"\x80\x81\xff"), ("e.c", b"")],
                                    "path string, content binary")
    answers = jobs.scan_stream(jobs.arriving_code(uploads), AlwaysSafe()).collect()
    assert {r["filename"] for r in answers} == {"w.c", "e.c"}
    assert answers[0]["message"] == "File is SAFE with 0.10 confidence."


def test_embeddings(spark):
    df = spark.createDataFrame([("a",), (None,)], "code string")
    zero = embedding.with_embedding(df).collect()
    assert all(len(r["embedding"]) == 768 and not any(r["embedding"]) for r in zero)

    def make_encoder():
        return lambda texts, limit: np.array([[len(t), limit] for t in texts])

    rows = embedding.with_embedding(df, make_encoder=make_encoder).collect()
    assert [r["embedding"] for r in rows] == [[1.0, 512.0], [0.0, 512.0]]


def test_streams_restart(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "path string, content binary"
    first = spark.createDataFrame([("a.c", b"gets(x)")], schema)
    second = spark.createDataFrame([("b.c", b"")], schema)

    def run():
        uploads = spark.readStream.schema(schema).parquet(source)
        answers = jobs.scan_stream(jobs.arriving_code(uploads), AlwaysSafe())
        jobs.write_stream(answers, out, checkpoint).awaitTermination()
        return sorted(r["filename"] for r in spark.read.parquet(out).collect())

    first.write.mode("append").parquet(source)
    assert run() == ["a.c"]
    second.write.mode("append").parquet(source)
    assert run() == ["a.c", "b.c"]
