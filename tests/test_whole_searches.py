"""The searches of the registered queries fit on all rows, and only what they name is fitted."""

import duckdb
import pytest

import check
from __spark_entry__ import oracle_sql, queries
from codesift.plans import training
from codesift.queries import derived

ROWS = 760


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of which more than 400 are left to fit on."""
    root = str(tmp_path_factory.mktemp("many"))
    words = ("river", "stone", "bread", "window", "garden")
    rows = [(i, " ".join(words[(i * k) % 5] for k in range(1, 9)), "en", "web", 50) for i in range(ROWS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{root}/documents.parquet")
    return root


@pytest.fixture
def small(monkeypatch):
    """Two settings and two sizes of small forests; the cuts of rows are what is looked at."""
    plain = training.forest
    settings = [{"trees": t, "depth": 2, "min_split": 2, "class_weight": None} for t in (1, 2)]
    monkeypatch.setattr(training, "grid_settings", lambda grid=None: settings)
    monkeypatch.setattr(training, "forest", lambda *a, **k: plain(2, 2))


def told(folder, name, *columns):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return duck.execute(f"SELECT DISTINCT {', '.join(columns)} FROM ({oracle_sql()[name]})").fetchall()


def test_the_grid_is_scored_on_all_rows(spark, folder, small):
    train, *_ = derived.split(spark, folder)
    n = train.count()
    assert n > 400
    for name in ("forest_grid", "grid_settings_scored"):
        assert {r["rows"] for r in queries()[name](spark, folder).collect()} == {n}
    assert told(folder, "grid_settings_scored", "rows") == [(n,)]
    assert queries()["best_grid_setting"](spark, folder).first()["winners"] == 1


def test_the_curve_takes_all_rows(spark, folder, small):
    train, test, *_ = derived.split(spark, folder)
    n = train.count() + test.count()
    cells = queries()["learning_curve_cells"](spark, folder)
    sizes = {r["train_size"] for r in cells.collect()}
    assert max(sizes) >= n * 4 // 5 - 1 > 320
    assert {s for s, in told(folder, "learning_curve_cells", "train_size")} == sizes
    means = {r["train_size"] for r in queries()["model_learning_curve"](spark, folder).collect()}
    assert means == sizes
    assert check.rows_of(["train_size", "fold"], cells.select("train_size", "fold").collect()) == check.rows_of(
        ["train_size", "fold"], told(folder, "learning_curve_cells", "train_size", "fold"))


def test_fits_side_by_side():
    assert [training._side_by_side(n, 8) for n in (0, 640, 20_000, 50_000, 10**7)] == [8, 8, 8, 3, 1]


def test_rows_that_need_no_forest_wait_for_none(spark, folder, monkeypatch):
    monkeypatch.setattr(derived, "forest", lambda *_: pytest.fail("a forest was fitted"))
    _, test, *_ = derived.split(spark, folder)
    for name in ("svm_scores", "svm_test_rows"):
        assert queries()[name](spark, folder).count() == test.count()
