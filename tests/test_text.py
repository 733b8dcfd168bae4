import random
import re

import pytest
from pyspark.sql import functions as F

from codesift.functions import text

PIECES = ["strcpy(", "//", "#", " ", "  ", "\t", "\n", "é", "²", "中", "ſ", "\x1c", "\xa0", "\u2028",
          "\r", "{", "}", "x", "_", "SELECT ", "+", "0", "'", '"', "\\", "İ", "\x85", "K", "="]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(n)]


def scanned_words(code):
    """What is left of a text, character by character: no comments, words by one blank."""
    words, word, comment = [], "", False
    for at, char in enumerate(code or ""):
        if char == "\n":
            comment = False
        elif char == "#" or code[at: at + 2] == "//":
            comment = True
        if comment:
            continue
        if char.isspace():
            words.append(word)
            word = ""
        else:
            word += char
    return " ".join(w for w in [*words, word] if w)


def open_braces(code):
    """The most braces open at once; a closing one without its partner counts nothing."""
    open_at, most = [], 0
    for at, char in enumerate(code):
        if char == "{":
            open_at.append(at)
        elif char == "}" and open_at:
            open_at.pop()
        most = max(most, len(open_at))
    return most


def test_clean_code_examples(one):
    given = ["int main() { // comment \n return 0; }", "", "   ", None, "int main() { return 0; }"]
    assert one(text.clean_code, given) == [
        "int main() { return 0; }", "", "", "", "int main() { return 0; }"]


def test_text_functions_agree_with_python(one):
    texts = random_texts(600, 1)
    assert one(text.clean_code, texts) == [scanned_words(t) for t in texts]
    assert one(text.brace_depth, texts) == [open_braces(t) for t in texts]
    assert one(text.lines, texts) == [t.split("\n") for t in texts]
    no_newline = [t.replace("\n", "") for t in texts]
    assert one(text.snippet, no_newline) == [t.strip()[:100] for t in no_newline]


def test_tokens_agree_with_python(one):
    texts = [t for t in random_texts(600, 2) if "İ" not in t]
    want = [re.findall(r"\b\w+\b", scanned_words(t).lower()) for t in texts]
    assert one(text.tokens, texts) == want


def test_snippet_is_cut(one):
    assert one(text.snippet, ["  " + "a" * 150 + " "]) == ["a" * 100]


def test_brace_depth_examples(one):
    given = ["}}{{}", "{{}}}{", "", "{", "a}b{c{d}e}f}{{{", None]
    assert one(text.brace_depth, given) == [2, 2, 0, 1, 3, 0]


@pytest.mark.parametrize("content", [
    b"", b"plain", b"\x80\x81\xff", "é中".encode(), b"a\xe2\x28b", b"\xf0\x90\x80A",
    "real � kept".encode(), "real � kept".encode() + b"\xff", b"\xc3",
])
def test_decoding_agrees_with_python(spark, content):
    df = spark.createDataFrame([(content,)], "c binary")
    got = df.select(text.decode_dropping(F.col("c")), text.decode_fallback(F.col("c"))).first()
    try:
        whole = content.decode("utf-8")
    except UnicodeDecodeError:
        whole = content.decode("latin-1")
    assert got[0] == content.decode("utf-8", errors="ignore")
    assert got[1] == whole


def test_newlines(one):
    assert one(text.normalize_newlines, ["a\r\nb\rc\nd\r\r\n"]) == ["a\nb\nc\nd\n\n"]


def test_extensions_and_names(one):
    import posixpath

    paths = ["a.c", "d/b.tar.gz", "d.x/noext", ".bashrc", "d/.hidden.py", "x.", "..c", "_a.PY"]
    assert one(text.extension, paths) == [posixpath.splitext(p)[1] for p in paths]
    assert one(text.repository_name, ["https://host/x/name.git", "name"]) == ["name", "name"]


def test_two_decimals_agree_with_python(one):
    rng = random.Random(3)
    values = [i / 200 for i in range(401)] + [i / 64 for i in range(65)] + [
        rng.random() for _ in range(500)] + [0.295, 1.005, 2.675, 65.625, -0.125, 99.995]
    assert one(text.two_decimals, values, "double") == [f"{v:.2f}" for v in values]
    assert one(text.percent, values, "double") == [f"{v:.2%}" for v in values]


def test_small_functions(spark, one):
    assert one(text.truthy, ["1", "TRUE", "Yes", "vulnerable", "0", "2", None]) == [
        1, 1, 1, 1, 0, 0, 0]
    assert one(text.clip, [-0.5, 0.25, 1.5], "double") == [0.0, 0.25, 1.0]
    assert one(text.status, [1, 0], "int") == ["VULNERABLE", "SAFE"]
    assert one(text.is_critical, ["Critical", "High", "Medium", "Low"]) == [True, True, False, False]
    row = spark.range(1).select(text.message(F.lit("SAFE"), F.lit(0.125))).first()
    assert row[0] == "File is SAFE with 0.12 confidence."
    noisy = spark.range(500).select(text.perturbed(F.lit(0.02)).alias("x"))
    low, high = noisy.agg(F.min("x"), F.max("x")).first()
    assert low == 0.0 and 0.02 < high < 0.4
