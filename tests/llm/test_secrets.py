import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from codesift.llm import secrets

from .conftest import odd_rows, prose

PATH = public_tokenizers.path("word_bpe_49k.json")
HEX = "0123456789abcdef"


def corpus(n, seed):
    rng = random.Random(seed)
    rows, truth = [], {}
    for i in range(n):
        key = "".join(rng.choice(HEX) for _ in range(40))
        number = "".join(rng.choice("0123456789") for _ in range(16))
        name = f"release-{rng.randint(1, 9)}-build-{rng.randint(100, 999)}"
        kind = i % 4
        middle = [f'token = "{key}"', f"order {number} of", f"see {name} for", f"commit {key} in"][kind]
        rows.append((i, f"{prose(i, 12)} {middle} {prose(i + 1000, 12)}", f"src{i % 3}"))
        truth[i] = kind == 0
    return rows, truth


def test_held_out_findings(make):
    schema = "doc_id long, text string, path string"
    train, truth = corpus(300, 1)
    found = secrets.candidates(make(train, schema), PATH, "path")
    labels = make(list(truth.items()), "_id long, secret boolean")
    model = secrets.trained(found.join(labels, found.doc_id == F.col("_id")).withColumn(
        "label", F.col("secret").cast("double")))
    test, truth = corpus(200, 2)
    out = secrets.scored(secrets.candidates(make(test, schema), PATH, "path"), model).collect()
    assert len(out) == 200
    assert sum(r.is_secret == truth[r.doc_id] for r in out) >= 0.97 * len(out)


@pytest.mark.parametrize("text, values", [
    ("", []), ("plain words only", []), ("abcdef123456", ["abcdef123456"]), ("abcdef12345", []),
    ("password: hunter2!", ["hunter2!"]), ('api_key="abcdef1234567890"', ["abcdef1234567890"]),
    ("longwordwithoutdigits", []), ("TOKEN=abc", []), ("x 4111111111111111 y", ["4111111111111111"])])
def test_spans(text, values):
    assert [text[a:b] for a, b in secrets.spans(text)] == values


def test_covered():
    words = frozenset(["garden", "gar", "den"])
    assert secrets.covered("garden", words) == 1.0
    assert secrets.covered("xxgarxden9", words) == 0.6


def test_labels_of_one_class(make):
    found = secrets.candidates(make([(1, "abc def 1234567890abcdef", None)],
                                    "doc_id long, text string, path string"), PATH, "path")
    model = secrets.trained(found.withColumn("label", F.lit(0.0)))
    assert [(r.probability, r.is_secret) for r in secrets.scored(found, model).collect()] == [(0.0, False)]


def test_odd_rows(odd, none):
    found = secrets.candidates(odd, PATH, "source").collect()
    want = sum(len(secrets.spans(t or "")) for _, t, *_ in odd_rows())
    assert len(found) == want
    assert secrets.candidates(none, PATH, "source").count() == 0
    empty = secrets.candidates(none, PATH, "source").withColumn("label", F.lit(1.0))
    assert secrets.scored(empty, secrets.trained(empty)).count() == 0
