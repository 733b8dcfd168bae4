"""Which folders the file source reads."""

import os

from codesift.sources.code_files import read_code_files
from codesift.sources.scan_reports import read_errors, read_report, read_results, write_report


def landed(root, *names):
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("int a;")


def found(spark, root, policy):
    return sorted(os.path.relpath(r.path, root) for r in read_code_files(spark, str(root), policy).collect())


def test_repositories_are_mined_whatever_their_names(spark, tmp_path):
    landed(tmp_path, "pytest/src/a.c", ".github/b.c", "ok/src/a.c", "ok/tests/a.c", "ok/.git/a.c",
           "ok/read.txt", "top.c")
    assert found(spark, tmp_path, "mining") == [".github/b.c", "ok/src/a.c", "pytest/src/a.c", "top.c"]


def test_links_to_folders_are_not_followed(spark, tmp_path):
    landed(tmp_path, "src/a.c", "src/b.c")
    os.symlink(tmp_path, tmp_path / "src" / "up")
    os.symlink(tmp_path / "src" / "a.c", tmp_path / "src" / "c.c")
    for policy in ("all", "mining", "scanning"):
        assert found(spark, tmp_path, policy) == ["src/a.c", "src/b.c", "src/c.c"]


def test_report_holds_results_and_errors_of_one_pass(spark, tmp_path):
    passes = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            passes.add(len(batch))
            yield batch

    rows = [(f"f{i}.c", "SAFE" if i % 3 else "VULNERABLE", 0.5, None) for i in range(9)]
    rows.append(("gone.c", None, None, "unreadable"))
    df = spark.createDataFrame(rows, "file string, status string, confidence double, error string")
    write_report(df.mapInPandas(seen, df.schema), str(tmp_path / "report"))
    assert passes.value == 10
    assert read_results(spark, str(tmp_path / "report")).count() == 9
    assert [tuple(r) for r in read_errors(spark, str(tmp_path / "report")).collect()] == [
        ("gone.c", "unreadable")]
    summary = spark.read.json(str(tmp_path / "report/summary")).first()
    assert (summary.total_files, summary.vulnerable_files) == (9, 3)


def test_both_forms_of_a_report(spark, tmp_path):
    one = '{"file": "a.c", "status": "SAFE", "confidence": 0.1, "timestamp": "t"}'
    (tmp_path / "list.json").write_text(f"[{one}, {one}]")
    (tmp_path / "object.json").write_text('{"timestamp": "t", "total_files": 1, "results": [%s]}' % one)
    assert read_report(spark, str(tmp_path / "list.json")).count() == 2
    assert [r.file for r in read_report(spark, str(tmp_path / "object.json")).collect()] == ["a.c"]
