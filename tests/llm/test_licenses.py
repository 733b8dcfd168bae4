import random

import duckdb
import pandas as pd
import pytest

from codesift.llm import licenses
from codesift.llm.twins import TWINS

from .conftest import odd_rows, prose


def by_sql(rows):
    duck = duckdb.connect()
    duck.register("documents", pd.DataFrame(
        {"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": pd.Series([r[1] for r in rows], dtype="object")}))
    result = duck.execute(TWINS["op11_licenses"])
    names = [d[0] for d in result.description]
    return names, sorted((tuple(r) for r in result.fetchall()), key=str)


def found(docs, names):
    return sorted((tuple(r) for r in licenses.licensed(docs).select(*names).collect()), key=str)


def test_odd_rows(odd, none):
    names, want = by_sql(odd_rows())
    assert found(odd, names) == want and len(want) == len(odd_rows())
    assert found(none, names) == []


def noisy(seed):
    """Notices among other words, cut, edited, doubled or moved apart."""
    rng = random.Random(seed)
    out = []
    for label, text, _ in rng.sample(licenses.TEMPLATES, rng.randrange(0, 4)):
        words = text.split()
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(words))
            words[at: at + rng.randrange(2)] = rng.choice([[], ["other"], ["License"], [rng.choice(words)]])
        out.append(prose(rng.randrange(99), rng.randrange(6)) + " " + " ".join(words).upper() * rng.randrange(1, 3))
    return "\n".join(out) + rng.choice(["", " cc by", " cc-by the Apache License", " MIT-License GNU General"])


def test_edited_notices(make):
    rows = [(i // 2, noisy(i)) for i in range(150)]
    names, want = by_sql(rows)
    got = found(make(rows).repartition(3), names)
    assert got == want
    assert len({r[names.index("labels")] for r in got}) > 15


@pytest.mark.parametrize("at", range(len(licenses.TEMPLATES)))
def test_templates_hold_their_phrases(at):
    label, text, phrases = licenses.TEMPLATES[at]
    words = " ".join(licenses.words_of(text))
    assert all(p in words for p in phrases)
    assert len(set(words.split())) >= licenses.VOTES


def test_every_notice_is_found(make):
    rows = [(i, prose(i, 30) + ".\n" + text + "\n" + prose(i + 50, 2000 * (i % 2)))
            for i, (_, text, _) in enumerate(licenses.TEMPLATES)]
    rows += [(100, "a " * 50 + "new york"), (101, "permission is granted"), (102, "gnu general public")]
    got = {r.doc_id: r for r in licenses.licensed(make(rows)).collect()}
    for i, (label, _, _) in enumerate(licenses.TEMPLATES):
        assert label in got[i].labels.split(",") and got[i].score == 1.0
    assert [(got[i].labels, got[i].score, got[i].n_base) for i in (100, 101, 102)] == [("", 0.0, 0)] * 3


def test_no_python_in_the_plan(make):
    plan = licenses.licensed(make([(1, "MIT License")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
