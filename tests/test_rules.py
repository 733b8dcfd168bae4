import random
import re

import pytest
from pyspark.sql import functions as F

from codesift import fixed_values as fixed
from codesift.functions.patterns import java_pattern, literal_text
from codesift.operators import findings, rules
from tests.test_text import PIECES

RULE_PIECES = PIECES + [
    "gets(", "exec(", "eval(", "shell_exec(", "pickle.load", "subprocess.call(", "shell=True",
    "Statement", "createStatement", ".executeQuery", "(", ")", "new", "Random()", "SqlCommand",
    "Unsafe.", "ValidateInput", "false", "fmt.Sprintf(", "SELECT", "select", "ſelect", "params[:",
    "].html_safe", "api_key", "password", "passwörd", "'secret'", '"abc"', "a" * 20, "update",
    "DELETE", "w", "MD5(", "AES/ECB", "-----BEGIN PRIVATE KEY-----", "unsafe.Pointer",
]


PATTERNS = {i: re.compile(rule[0]) for i, rule in enumerate(fixed.RULES, start=1)}


def python_findings(code):
    """Pairs of line and rule, from every rule's own pass over the text."""
    found = set()
    starts = [0, *(at + 1 for at, char in enumerate(code) if char == "\n")]
    for rule_id, pattern in PATTERNS.items():
        for number, start in enumerate(starts, start=1):
            end = code.find("\n", start)
            if pattern.search(code[start: end if end >= 0 else len(code)]):
                found.add((number, rule_id))
    return sorted(found)


def random_codes(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(RULE_PIECES, k=rng.randint(0, 16))) for _ in range(n)]


def test_rule_base_shape():
    severities = [r[2] for r in fixed.RULES]
    assert len(fixed.RULES) == 32 and len({r[0] for r in fixed.RULES}) == 32
    assert {s: severities.count(s) for s in set(severities)} == {
        "High": 16, "Medium": 8, "Critical": 7, "Low": 1}
    assert len({r[3] for r in fixed.RULES}) == 14 and len({r[1] for r in fixed.RULES}) == 20


def test_both_forms_agree_with_python(spark):
    codes = random_codes(3000, 5)
    df = spark.createDataFrame(list(enumerate(codes)), "id int, code string")
    want = {i: python_findings(c) for i, c in enumerate(codes)}
    assert sum(map(len, want.values())) > 3000
    nested = {
        r["id"]: [(f["line"], f["rule_id"]) for f in r["findings"]]
        for r in findings.with_findings(df).collect()
    }
    assert nested == want
    rows = findings.hit_rows(df, ["id"]).collect()
    assert sorted((r["id"], r["line"], r["rule_id"]) for r in rows) == sorted(
        (i, *hit) for i, hits in want.items() for hit in hits)
    counts = {r["id"]: r["danger_count"] for r in findings.with_danger_count(df).collect()}
    assert counts == {i: len(h) for i, h in want.items()}


def test_guards_never_lose_a_hit():
    for code in random_codes(4000, 6):
        for rule in rules.default_rules():
            if rule.guard and re.search(rule.pattern, code):
                assert rule.guard in code


def test_long_line_is_linear(spark):
    line = "select " * 14000
    df = spark.createDataFrame([(line,), (line + "+ x",)], "code string")
    assert [r["danger_count"] for r in findings.with_danger_count(df).collect()] == [0, 1]


def test_golden_sources(spark):
    sources = {
        "buffer": "void f() {\n  // gets() is bad\n  gets(buffer);\n}",
        "query": 'String q = "SELECT * FROM t WHERE n = " + user;',
        "shell": "import os\nos.system('ping ' + host)",
        "clean": 'int main() {\n  printf("Hello");\n}',
        "runtime": "Runtime.getRuntime().exec(cmd);",
        "empty": "",
    }
    df = spark.createDataFrame(list(sources.items()), "file string, code string")
    found = {r["file"]: [(f["line"], f["type"], f["cwe"]) for f in r["findings"]]
             for r in findings.with_findings(df).collect()}
    assert found == {
        "buffer": [(2, "Buffer Overflow", "CWE-242"), (3, "Buffer Overflow", "CWE-242")],
        "query": [(1, "SQL Injection", "CWE-89")],
        "shell": [(2, "Command Injection", "CWE-78")],
        "clean": [],
        "runtime": [(1, "Code Injection", "CWE-95"), (1, "Command Injection", "CWE-78")],
        "empty": [],
    }
    labels = findings.with_findings(df).select(
        "file", findings.weak_label(F.col("findings")), findings.weak_cwe(F.col("findings")))
    assert {tuple(r) for r in labels.collect()} >= {
        ("runtime", 1, "CWE-78;CWE-95"), ("clean", 0, "None")}


def test_golden_snippets(spark):
    """Rules against the labels of the built-in snippets."""
    from codesift.sources.tables import snippet_table

    rows = findings.with_findings(snippet_table(spark), code="snippet").collect()
    known = [r["danger_count"] for r in rows if r["cve_id"]]
    samples = [r for r in rows if not r["cve_id"]]
    hit_bad = [r["danger_count"] for r in samples if r["is_vulnerable"] and r["danger_count"]]
    hit_safe = [r["snippet"] for r in samples if not r["is_vulnerable"] and r["danger_count"]]
    assert known == [1, 1, 1, 1]
    assert (len(hit_bad), sum(hit_bad)) == (12, 13)
    assert len(hit_safe) == 1 and hit_safe[0].startswith("fgets(")


def test_null_code_has_no_findings(spark):
    df = spark.createDataFrame([(None,)], "code string")
    row = findings.with_findings(df).first()
    assert row["findings"] == [] and row["danger_count"] == 0
    assert findings.hit_rows(df, []).count() == 0
    assert findings.with_danger_count(df).first()["danger_count"] == 0


def test_no_rules(spark):
    df = spark.createDataFrame([(1, "gets(x)")], "id int, code string")
    assert findings.hit_rows(df, ["id"], []).count() == 0
    assert findings.with_findings(df, []).first()["findings"] == []
    assert findings.with_danger_count(df, []).first()["danger_count"] == 0


def test_user_rules_in_batches(spark, monkeypatch):
    monkeypatch.setattr(rules, "RULES_PER_PASS", 3)
    table = spark.createDataFrame(
        [(i, rf"\bword{i}\b", f"type {i}") for i in range(8)],
        "rule_id int, pattern string, type string")
    df = spark.createDataFrame([("a word1 wordword2\nword7 word1",)], "code string")
    rows = findings.finding_rows(df, [], table).collect()
    assert sorted((r["line"], r["rule_id"], r["type"]) for r in rows) == [
        (1, 1, "type 1"), (2, 1, "type 1"), (2, 7, "type 7")]
    nested = findings.with_findings(df, table).first()["findings"]
    assert sorted((f["line"], f["rule_id"]) for f in nested) == [(1, 1), (2, 1), (2, 7)]
    assert nested[0]["cwe"] == "N/A"


@pytest.mark.parametrize("pattern", [
    r"\w+\s*=", r"[\w.]+@", r"[^\w]x", r"(?i)straße", r"\bé\b", r"[[(]x", r"[]x]", r"[^]x]", r"\d+",
    r"\S\W", r"x{2,}",
])
def test_java_spelling(one, pattern):
    texts = random_codes(300, 7) + ["é x", "aé b", "STRASSE Straße", "a@b", "[x", "]", "٣٤", "xx=xx"]
    texts = [t for t in texts if "\n" not in t]
    java = java_pattern(pattern)
    assert one(lambda v: v.rlike(java), texts) == [bool(re.search(pattern, t)) for t in texts]


def test_literal_text():
    assert literal_text(r"strcpy\(") == "strcpy("
    assert literal_text("AES/ECB") == "AES/ECB"
    assert literal_text(r"a.b") is None and literal_text(r"a\s") is None
    assert literal_text("") is None


def test_nesting_keeps_files_without_findings(spark):
    files = spark.createDataFrame([("a",), ("b",)], "file string")
    rows = spark.createDataFrame([("a", 2, 1), ("a", 1, 5)], "file string, line int, rule_id int")
    nested = {r["file"]: [(f["line"], f["rule_id"]) for f in r["findings"]]
              for r in findings.nest_findings(files, rows, ["file"]).collect()}
    assert nested == {"a": [(1, 5), (2, 1)], "b": []}


def test_pieces_lie_within_a_text():
    keys, of = findings.piece_keys(["abcde", "", "xyz", "\U0001F600bcde"])
    assert of.tolist() == [0, 0, 3, 3]
    assert keys[1] == keys[3] != keys[0] != keys[2] and len(set(keys.tolist())) == 3
    assert findings.piece_keys(["ab", "cd"])[0].size == findings.piece_keys([])[0].size == 0


def test_many_rules_are_met_by_an_index(spark, monkeypatch):
    import random

    from codesift.operators import findings, rules

    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9))) for _ in range(60)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 9))) for _ in range(200)] + ["", "abc", "x+y"]
    docs = spark.createDataFrame(
        [(i, "\n".join(lines[4 * i: 4 * i + 4])) for i in range(51)], "doc_id long, code string")
    spelled = sorted(set(words[:30]))
    patterns = spelled + [rf"\b{w}\b" for w in spelled] + [rf"{w[:4]}\w+" for w in spelled] + ["x\\+y", "[ab]+c"]
    table = spark.createDataFrame(
        [(i, p, f"t{i}") for i, p in enumerate(patterns, 1)], "rule_id int, pattern string, type string")
    plain = sorted(findings.hit_rows(docs, ["doc_id"], table).collect())
    assert len(plain) > 500
    monkeypatch.setattr(findings, "RULES_PER_PASS", 10)
    monkeypatch.setattr(rules, "RULES_PER_PASS", 10)
    assert sorted(findings.hit_rows(docs, ["doc_id"], table).collect()) == plain
    index = {r.rule_id: r for r in rules.indexed_rules(table).collect()}
    assert all(r.gram is None or (len(r.gram) == rules.GRAM and r.gram in r.needed) for r in index.values())
    assert any(r.gram is None for r in index.values()) and any(r.regex is None for r in index.values())
