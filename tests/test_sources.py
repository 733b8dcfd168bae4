import json
import os

import pytest
from pyspark.sql import functions as F

from codesift.operators import report
from codesift.plans import mining, scanning
from codesift.sources import code_files, samples, scan_reports, synthetic, tables


def test_csv_round_trip(spark, tmp_path):
    rows = [('a "quoted"\nline, two', 1, "CWE-1"), ("", 0, "None"), (" back\\slash ", 0, "None"),
            ("tab\tend ", 1, "N/A")]
    df = spark.createDataFrame(rows, tables.SAMPLE_SCHEMA)
    samples.write_csv(df, str(tmp_path / "out"))
    back = samples.read_csv(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_plain_csv(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text('code,is_vulnerable,cwe_id\n"say ""x"", y",1,CWE-9\nz;,0,None\n')
    got = sorted(map(tuple, samples.read_csv(spark, str(path)).collect()))
    assert got == [('say "x", y', 1, "CWE-9"), ("z;", 0, "None")]


def test_cascade(spark, tmp_path):
    assert samples.base_samples(spark, str(tmp_path / "none"), num_samples=11).count() == 14
    landed = tmp_path / "functions.csv"
    landed.write_text("functionSource,vulnerability\nf(),yes\n")
    patches = tmp_path / "patches.csv"
    patches.write_text("diff,cwe\n+x,CWE-3\n")
    external = samples.base_samples(spark, None, str(landed), str(patches))
    assert sorted(map(tuple, external.collect())) == [("+x", 1, "CWE-3"), ("f()", 1, "N/A")]
    base = tmp_path / "base.csv"
    base.write_text("code,is_vulnerable,cwe_id\na,1,CWE-1\na,1,CWE-2\nb,0,None\n")
    mined = tmp_path / "mined.csv"
    mined.write_text("code,is_vulnerable,source,language\nb,1,r,.c\nc,1,r,.c\n")
    loaded = samples.load_samples(spark, str(base), str(mined))
    assert sorted(map(tuple, loaded.collect())) == [
        ("a", 1, "CWE-1"), ("b", 0, "None"), ("c", 1, "None")]


def test_synthetic_samples(spark):
    df = synthetic.synthetic_samples(spark, 20)
    rows = df.collect()
    assert len(rows) == 24 and df.columns == ["code", "is_vulnerable", "cwe_id"]
    assert sum(r["is_vulnerable"] for r in rows) == 14
    assert sum(r["cwe_id"] == "External-CVE" for r in rows) == 4


def test_knowledge_base(spark, tmp_path):
    known = tables.known_weaknesses(spark)
    samples.write_knowledge_base(known, str(tmp_path / "kb"))
    assert sorted(samples.read_knowledge_base(spark, str(tmp_path / "kb")).collect()) == sorted(
        known.collect())
    array = tmp_path / "kb.json"
    array.write_text(json.dumps([r.asDict() for r in known.collect()], indent=4))
    assert samples.read_knowledge_base(spark, str(array), multi_line=True).count() == 4


def land(root, files):
    for name, content in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as out:
            out.write(content)


FILES = {
    "repo/src/__init__.py": b"", "repo/src/a.py": b"x = 1\r\n" * 20, "repo/.git/b.py": b"gets(",
    "repo/my_Tests/c.py": b"eval(x)" * 20, "repo/venv/d.c": b"x" * 60, "repo/e.txt": b"text",
    "repo/src/deep/er/f.c": b"strcpy(a, b);\n" * 10 + b"\xff", "repo/test_cases/g.c": b"y" * 60,
    "repo/src/explain.py": b"z" * 60, "other/h.go": b"fmt.Println()\n" * 5, "other/_i.rb": b"\x80\x81\xff",
}


def names(df, root):
    return {os.path.relpath(r["path"], root) for r in df.collect()}


def test_code_files_policies(spark, tmp_path):
    root = str(tmp_path)
    land(root, FILES)
    everything = code_files.read_code_files(spark, root, extensions=())
    assert names(everything, root) == set(FILES)
    mined = names(code_files.read_code_files(spark, root, "mining"), root)
    assert mined == {"repo/src/__init__.py", "repo/src/a.py", "repo/venv/d.c",
                     "repo/src/deep/er/f.c", "repo/src/explain.py", "other/h.go", "other/_i.rb"}
    scanned = names(code_files.read_code_files(spark, root, "scanning"), root)
    assert scanned == {"repo/src/__init__.py", "repo/src/a.py", "repo/my_Tests/c.py",
                       "repo/src/deep/er/f.c", "other/h.go", "other/_i.rb"}
    single = code_files.read_code_files(spark, f"{root}/repo/e.txt", "scanning")
    assert names(single, root) == {"repo/e.txt"}
    by_uri = code_files.read_code_files(spark, f"file://{root}/", "mining").collect()
    assert {r["path"] for r in by_uri} == {f"file://{root}/{n}" for n in mined}
    short = code_files.read_code_files(spark, f"file:{root}", "mining").collect()
    assert {r["path"] for r in short} == {f"file:{root}/{n}" for n in mined}


def test_listing_opens_nothing(spark, tmp_path):
    root = str(tmp_path)
    land(root, FILES)
    # To open a pipe without a writer would never end.
    os.mkfifo(f"{root}/repo/src/pipe.py")
    os.mkfifo(f"{root}/repo/src/other.txt")
    listed = code_files.list_code_files(spark, root, "mining")
    assert "repo/src/pipe.py" in names(listed, root)
    some = listed.filter("length > 0 and not endswith(path, 'pipe.py')")
    read = code_files.with_contents(some, root).collect()
    assert read and all(r["length"] == len(r["content"]) > 0 for r in read)


def test_large_folders_are_dealt_over_tasks(spark, tmp_path, monkeypatch):
    for i in range(3000):
        path = tmp_path / ("big" if i % 3 else f"r{i % 30}") / f"f{i}.c"
        path.parent.mkdir(exist_ok=True)
        path.write_text("int a;" * (i % 5))
    files = code_files.read_code_files(spark, str(tmp_path), "mining")
    counts = [r[0] for r in files.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(counts) == 3000 and len(counts) >= 8 and max(counts) < 600
    monkeypatch.setattr(code_files, "TASK_FILES", 100)
    assert code_files.read_code_files(spark, str(tmp_path), "mining").rdd.getNumPartitions() >= 30


def test_roots_that_are_not_there(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        code_files.read_code_files(spark, str(tmp_path / "no"))
    with pytest.raises(ValueError):
        code_files.read_code_files(spark, str(tmp_path), "nobody's")
    assert code_files.read_code_files(spark, str(tmp_path)).count() == 0


def test_mining_job(spark, tmp_path):
    land(str(tmp_path), FILES)
    rows = {r["code"][:6]: r for r in mining.mined_samples(spark, str(tmp_path)).collect()}
    assert set(rows) == {"x = 1\n", "xxxxxx", "strcpy", "zzzzzz", "fmt.Pr"}
    hit = rows["strcpy"]
    assert (hit["is_vulnerable"], hit["cwe_id"], hit["source"], hit["language"]) == (
        1, "CWE-120", "repo", ".c")
    assert hit["code"].endswith(";\n") and "\r" not in rows["x = 1\n"]["code"]
    summary = mining.mining_summary(mining.mined_samples(spark, str(tmp_path)))
    assert {tuple(r) for r in summary["sources"].collect()} == {("repo", 4, 1), ("other", 1, 0)}


def test_scan_target_keeps_odd_files(spark, tmp_path):
    land(str(tmp_path), FILES)
    rows = {os.path.basename(r["file"]): r["code"]
            for r in scanning.readable(scanning.scan_target(spark, str(tmp_path))).collect()}
    assert rows["__init__.py"] == "" and rows["_i.rb"] == "\x80\x81ÿ"
    assert scanning.errors(scanning.scan_target(spark, str(tmp_path))).count() == 0


def test_both_report_forms(spark, tmp_path):
    result = {"file": "a.c", "status": "VULNERABLE", "confidence": 0.84,
              "timestamp": "2025-01-01 00:00:00"}
    safe = {**result, "file": "b.c", "status": "SAFE", "confidence": 0.125}
    listed = tmp_path / "list.json"
    listed.write_text(json.dumps([result, safe], indent=4))
    full = tmp_path / "full.json"
    call = {"line": 3, "content": "gets(x)", "type": "Buffer Overflow", "severity": "Critical"}
    full.write_text(json.dumps({
        "timestamp": "t", "total_files": 2, "vulnerable_files": 1, "scan_duration": 0,
        "results": [{**result, "details": {"complexity": 1, "ast_depth": 2,
                                           "dangerous_calls": [call, {**call, "type": None}]}}, safe]}))
    old = scan_reports.read_report(spark, str(listed))
    new = scan_reports.read_report(spark, str(full))
    for rows in (old, new):
        assert tuple(report.scan_totals(rows).first()) == (2, 1, 1)
    assert [tuple(r) for r in report.risk_types(old).collect()] == [("ML Predicted Risk", 1)]
    assert {tuple(r) for r in report.risk_types(new).collect()} == {
        ("Buffer Overflow", 1), ("Generic Risk", 1)}
    shown = report.vulnerable_details(new).filter("type = 'Buffer Overflow'").first()
    assert (shown["confidence"], shown["is_critical"], shown["cwe"]) == ("84.00%", True, "N/A")
    assert [tuple(r) for r in report.safe_files(old).collect()] == [("b.c", "12.50%", "SAFE")]


def test_report_round_trip(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a.c", "SAFE", 0.1, (1.0, 2, []), "2025-01-01 00:00:00")], scan_reports.RESULT_SCHEMA)
    scan_reports.write_report(rows, str(tmp_path / "r"))
    assert scan_reports.read_results(spark, str(tmp_path / "r")).collect() == rows.collect()
    summary = spark.read.json(str(tmp_path / "r/summary")).first()
    assert (summary["total_files"], summary["vulnerable_files"], summary["scan_duration"]) == (1, 0, 0)
