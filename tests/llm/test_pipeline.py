"""The stages against plain versions, and the registered queries."""

import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from __spark_entry__ import oracle_sql, queries
from codesift.llm.queries import QUERIES
from codesift.llm.twins import TWINS
from codesift.session import written

from . import test_linededup, test_mixing, test_neardup, test_packing
from .conftest import odd_rows, prose

STAGES = dict(P.STAGES)


@pytest.fixture(scope="module")
def docs(make_docs):
    rng = random.Random(8)
    rows = []
    for i in range(60):
        text = "\n".join(prose(40 * i + j, rng.randint(6, 30)) for j in range(3))
        rows.append((i, text, "en", f"src{min(i % 7, 2)}"))
    for i in range(12):  # one long line each, so that copies are caught by the third stage
        text = prose(5000 + i // 3, 120)
        # Another first word each: lines that begin alike would go in the second stage.
        text = test_neardup.edited(text, rng, 0.01) if i % 3 else text
        rows.append((100 + i, "abcdefghijkl"[i] + " " + text, "en", "src1"))
    rows += [(200 + i, rows[i][1], "en", "src9") for i in range(5)]  # copies
    rows += [(300, "!!! 123 ...", "en", "src1"), (301, "", "en", "src1"), (302, None, "en", "src1")]
    return make_docs(rows)


@pytest.fixture(scope="module")
def make_docs(spark):
    def run(rows):
        return spark.createDataFrame(
            [(*r, len(r[1] or ""), "extra") for r in rows],
            "doc_id long, text string, lang string, source string, n_chars long, kept string")

    return run


def test_against_plain_versions(spark, docs):
    order = [name for name, _ in P.STAGES]
    assert order == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]
    columns, step = docs.columns, docs
    texts = {r.doc_id: r.text for r in docs.collect()}

    step = written(STAGES["language_id"](spark, step, ""), "t")
    assert step.columns == columns
    texts = {d: t for d, t in texts.items() if t and any(c.isalpha() for c in t)}
    assert {r.doc_id: r.text for r in step.collect()} == texts

    step = written(STAGES["line_dedup"](spark, step, ""), "t")
    assert step.columns == columns
    before, texts = texts, test_linededup.brute(list(texts.items()))
    texts = {d: t for d, t in texts.items() if t == before[d] or t.split()}
    rows = step.collect()
    assert {r.doc_id: r.text for r in rows} == texts
    assert all(r.n_chars == len(r.text) and r.kept == "extra" for r in rows)
    assert not any(200 <= d < 205 for d in texts)

    step = written(STAGES["near_dedup"](spark, step, ""), "t")
    assert step.columns == columns
    kept = {d for d, _, _, k in test_neardup.brute(list(texts.items())) if k}
    assert {r.doc_id for r in step.collect()} == kept and len(kept) < len(texts)

    step = written(STAGES["mixing"](spark, step, ""), "t")
    assert step.columns == columns
    rows = step.collect()
    copies = Counter(r.doc_id for r in rows)
    assert set(copies) == kept and max(copies.values()) == 2
    sources = {r.doc_id: r.source for r in rows}
    totals = test_mixing.tokens([(d, texts[d], sources[d]) for d in kept])
    _, times = test_mixing.brute(totals, 0.5, 2.0)
    got = test_mixing.tokens([(r.doc_id, r.text, r.source) for r in rows])
    longest = max(len(texts[d].split()) for d in kept)
    for source, total in totals.items():
        assert -1 <= times[source] * total - got[source] <= longest

    out = STAGES["packing"](spark, step, "").collect()
    found = defaultdict(list)
    for r in rows:
        found[r.doc_id].append(r.text)
    test_packing.check_packed(
        out, found, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 2048)


def test_odd_rows(spark, odd, none):
    for start in (odd, none):
        step = start
        for name, stage in P.STAGES[:-1]:
            step = written(stage(spark, step, ""), "t")
            assert step.columns == odd.columns, name
        assert P.STAGES[-1][1](spark, step, "").count() >= (step.count() > 0)
    assert len(odd_rows()) == odd.count()


def test_registered():
    names = [f"op{n}_" for n in range(1, 11)]
    assert all(sum(q.startswith(n) for q in QUERIES) == 1 for n in names)
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(TWINS) <= set(oracle_sql())


def test_whole_pipeline(spark):
    rows = queries()["pipeline"](spark, "/root/testdata/sf0.001").collect()
    sequences = defaultdict(int)
    for r in rows:
        sequences[r.sequence_id] += r.length
    assert rows and max(sequences.values()) <= 2048
