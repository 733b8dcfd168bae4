import hashlib
import math

from pyspark.sql import functions as F

from codesift.operators import ranking, samples


def key(i, seed=42):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest() + f":{i}"


def test_exact_split(spark):
    for n in (0, 1, 4, 5, 101):
        df = spark.range(n)
        flags = {r["id"]: r["is_test"] for r in ranking.with_test_flag(df, "id").collect()}
        chosen = sorted(range(n), key=key)[: math.ceil(n * 0.2)]
        assert {i for i, f in flags.items() if f} == set(chosen)
    train, test = ranking.train_test_split(spark.range(10), "id")
    assert train.count() == 8 and test.count() == 2 and train.columns == ["id"]


def test_ranks_within_groups(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 3)
    got = {r["id"]: r["rank"] for r in ranking.with_rank(df, "id", ["g"]).collect()}
    for g in range(3):
        order = sorted((i for i in range(500) if i % 3 == g), key=key)
        assert [got[i] for i in order] == list(range(1, len(order) + 1))


def test_ranks_do_not_depend_on_bucket_size(spark, monkeypatch):
    want = ranking.with_rank(spark.range(300), "id").collect()
    monkeypatch.setattr(ranking, "BUCKET_DIGITS", 1)
    assert sorted(ranking.with_rank(spark.range(300), "id").collect()) == sorted(want)
    flags = ranking.with_test_flag(spark.range(300), "id").filter("is_test").collect()
    assert {r["id"] for r in flags} == set(sorted(range(300), key=key)[:60])


def test_folds_are_even_per_class(spark):
    df = spark.range(103).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    sizes = ranking.with_folds(df, "id", "label").groupBy("label", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r["label"] == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_learning_curve_steps(spark):
    df = spark.range(53).withColumn("label", (F.col("id") % 4 == 0).cast("int"))
    folded = ranking.with_folds(df, "id", "label")
    fold = {r["id"]: r["fold"] for r in folded.collect()}
    smallest = min(sum(v != f for v in fold.values()) for f in range(5))
    steps = ranking.learning_curve_steps(folded, "id").collect()
    assert len(steps) == 25
    for s in steps:
        own = sorted((key(i) for i in fold if fold[i] != s["test_fold"]))
        fraction = (0.1, 0.325, 0.55, 0.775, 1.0)[s["step"]]
        assert s["train_size"] == int(fraction * smallest)
        assert s["cutoff"] == own[s["train_size"] - 1]


def test_balancing(spark):
    def classes(df):
        return {r["is_vulnerable"]: r["count"] for r in
                df.groupBy("is_vulnerable").count().collect()}

    skewed = spark.range(100).withColumn("is_vulnerable", (F.col("id") < 11).cast("int"))
    assert classes(samples.balanced(skewed, "id")) == {1: 11, 0: 13}
    even = spark.range(100).withColumn("is_vulnerable", (F.col("id") < 40).cast("int"))
    assert classes(samples.balanced(even, "id")) == {1: 40, 0: 60}
    none = spark.range(10).withColumn("is_vulnerable", F.lit(0))
    assert classes(samples.balanced(none, "id")) == {}


def test_shuffle_keeps_all_rows(spark):
    rows = [r["id"] for r in ranking.shuffled(spark.range(50), "id").collect()]
    assert rows == sorted(range(50), key=key)


def test_deduplication(spark):
    base = spark.createDataFrame([("a", 1, "X", 5), ("b", 0, "None", 7), ("a", 0, "Y", 3)],
                                 "code string, is_vulnerable int, cwe_id string, row_id long")
    more = spark.createDataFrame([("b", 1, "Z", 0), (None, 1, "Z", 1), (None, 0, "W", 2)],
                                 base.schema)
    merged = samples.union_by_rank([base, more])
    kept = samples.deduplicated(merged, ["source_rank", "row_id"]).select(*samples.CANONICAL)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [("a", 0, "Y"), ("b", 0, "None"), (None, 1, "Z")], key=str)
    assert tuple(samples.dropped_duplicates(merged).first()) == (6, 3, 3)


def test_hot_code_folds_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("code"),
        F.lit(1).alias("is_vulnerable"), F.lit("None").alias("cwe_id"), F.col("id").alias("row_id"))
    kept = samples.deduplicated(df, ["row_id"])
    assert kept.count() == 20001
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_external_adapters(spark):
    functions = spark.createDataFrame([("f()", "TRUE"), ("g()", "no")],
                                      "functionSource string, vulnerability string")
    assert sorted(map(tuple, samples.from_function_table(functions).collect())) == [
        ("f()", 1, "N/A"), ("g()", 0, "N/A")]
    patches = spark.createDataFrame([("p", "d", "CWE-1")], "patch string, diff string, cwe string")
    assert tuple(samples.from_patch_table(patches).first()) == ("p", 1, "CWE-1")
    assert tuple(samples.from_patch_table(patches.select("diff")).first()) == ("d", 1, "Unknown")
    assert samples.from_patch_table(patches.select("cwe")) is None
    assert samples.from_function_table(patches) is None
