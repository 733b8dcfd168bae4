import os

from pyspark.sql import functions as F

from codesift.__main__ import main
from codesift.plans import jobs
from codesift.plans.corpus import as_code
from codesift.sources import samples
from tests.test_sources import land


def test_all_jobs(spark, tmp_path, monkeypatch, capsys):
    def at(name):
        return str(tmp_path / name)

    repositories = {}
    for i in range(60):
        line = b"strcpy(a, b);" if i % 3 == 0 else b"int x%d = %d;" % (i, i)
        repositories[f"repo{i % 2}/src/f{i}.c"] = b"int f%d(void) {\n  %s\n  return %d;\n}\n" % (
            i, line, i) + b"// filler line to pass the length band\n"
    land(at("repos"), repositories)
    mined = jobs.mine(spark, at("repos"), at("mined.parquet"))
    assert {tuple(r) for r in mined["classes"].collect()} == {(0, 40), (1, 20)}
    assert sorted(os.listdir(at("mined.parquet")))[-2:] == ["source=repo0", "source=repo1"]

    documents = spark.range(72).select(F.col("id").alias("doc_id"), F.lit("src").alias("source"),
                                       F.concat(F.lit("text "), "id").alias("text"))
    samples.write_csv(as_code(documents).select("code", "is_vulnerable", "cwe_id"), at("base"))
    loaded = jobs.load(spark, at("base"), at("mined.parquet"))
    assert loaded.count() == 132 and loaded.select("row_id").distinct().count() == 132
    explored = jobs.explore(loaded)
    assert {r["is_vulnerable"]: r["n"] for r in explored["classes"].collect()} == {1: 66, 0: 66}

    small = [{"trees": 4, "depth": 4, "min_split": 2, "class_weight": None}]
    monkeypatch.setattr(jobs, "learning_curve", lambda *_: {})
    trained = jobs.train(loaded, at("models"), small)
    assert trained["report"].select("model").distinct().count() == 2
    assert jobs.evaluate(spark, at("models"))["auc"].count() == 2

    land(at("target"), {"a/x.c": b"gets(line);", "a/_empty.py": b"", "venv/y.c": b"skipped"})
    scanned = jobs.scan(spark, at("target"), at("models"), at("report"))
    assert scanned["totals"].first()["total_files"] == 2 and scanned["errors"].count() == 0
    assert jobs.explain(spark, at("models"))["attributions"].count() > 0
    assert jobs.drift(spark, at("models"))["drift"].count() == 1
    main(["drift", at("models"), "--results", at("report")])
    assert "p_value" in capsys.readouterr().out


def test_learning_curve_job(spark):
    from codesift.plans import training

    df = spark.range(40).select(F.col("id").alias("row_id"),
                                (F.col("id") % 2).cast("double").alias("label"))
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=["label"], outputCol="features").transform(df)
    tables = jobs.learning_curve(rows, training.forest(trees=1, depth=1))
    assert tables["learning_curve"].count() == 5
    assert tables["diagnosis"].first()["diagnosis"] == "good fit"
