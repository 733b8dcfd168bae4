import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from codesift.llm import rollups
from codesift.session import new_path

from .conftest import odd_rows

SCHEMA = ("kind string, doc_id long, source string, lang string, tokenizer string, n_tokens long, "
          "old_tokens long, extra string")


@pytest.fixture
def store(spark):
    return rollups.TokenTotals(spark, new_path(spark, "test-totals"))


def rows_of(store):
    return {tuple(r) for r in store.totals().collect()}


def brute(batches):
    out = defaultdict(lambda: [0, 0])
    for rows in batches:
        for kind, _, source, lang, tokenizer, new, old, _ in set(rows):
            new, old = new or 0, old or 0
            docs, tokens = {"insert": (1, new), "delete": (-1, -new), "revise": (0, new - old)}.get(kind, (0, 0))
            out[source, lang, tokenizer][0] += docs
            out[source, lang, tokenizer][1] += tokens
    return {(*k, *v) for k, v in out.items() if any(v)}


def test_batches_against_plain_sums(make, store):
    rng = random.Random(2)
    batches = []
    for b in range(5):
        rows = [(rng.choice(["insert", "delete", "revise", "other", None]), rng.randint(1, 40),
                 rng.choice(["a", "b", None]), rng.choice(["en", None]), rng.choice(["v1", "v2"]),
                 rng.choice([None, 3, 7]), rng.choice([None, 2]), "x") for _ in range(60)]
        batches.append(rows + rows[:5])
        assert store.commit(f"b{b}", make(batches[-1], SCHEMA))
        assert not store.commit(f"b{b}", make(batches[-1], SCHEMA))
        assert rows_of(store) == brute(batches)
        if b == 2:
            store.compact()
            assert rows_of(store) == brute(batches)
            assert not store.commit("b0", make(batches[0], SCHEMA))
    store.compact()
    assert rows_of(store) == brute(batches)
    assert store.batches() == [f"b{b}" for b in range(5)]


def test_a_broken_batch_does_not_count(spark, make, store):
    row = ("insert", 1, "a", "en", "v1", 5, None, "x")
    store.commit("one", make([row], SCHEMA))
    folder = f"{store._folder}/batches/two"
    rollups.signed(make([row], SCHEMA)).write.parquet(folder)
    store._files.delete(store._path(f"{folder}/_SUCCESS"), False)
    assert rows_of(store) == {("a", "en", "v1", 1, 5)}
    assert store.commit("two", make([(*row[:5], 9, None, "x")], SCHEMA))
    assert rows_of(store) == {("a", "en", "v1", 2, 14)}


def test_deleted_groups_and_empty_batches(make, store):
    assert rows_of(store) == set()
    assert store.commit("none", make([], SCHEMA))
    store.commit("in", make([("insert", 1, "a", "en", "v1", 5, None, "x")], SCHEMA))
    store.commit("out", make([("delete", 1, "a", "en", "v1", 5, None, "x")], SCHEMA))
    assert rows_of(store) == set() and not store.commit("none", make([], SCHEMA))
    with pytest.raises(ValueError):
        store.commit("../x", make([], SCHEMA))


def test_counts(odd, none):
    found = {r.doc_id: r for r in rollups.counted(odd).collect() if r.doc_id is not None}
    for doc_id, text, *_ in odd_rows():
        if doc_id is not None and (text or "").isascii():
            assert found[doc_id].all_words == len((text or "").split())
            assert found[doc_id].words == len(" ".join(dict.fromkeys((text or "").split("\n"))).split())
    assert rollups.counted(none).count() == 0


def test_second_tokenizer(one):
    count = lambda c: rollups.token_count(c, "words-2")
    assert one(count, ["it's 3.5!", "", None, "größer, äöü"]) == [7, 0, 0, 3]
    assert one(lambda c: F.coalesce(c, F.lit("")), [None]) == [""]
