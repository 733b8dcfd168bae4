import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from codesift.llm import mixing

from .conftest import odd_rows, prose


def corpus():
    sizes = {"big": 120, "mid": 40, "small": 15, "tiny": 4}
    return [(i, prose(i, 20 + i % 30), source)
            for i, source in enumerate(s for s, n in sizes.items() for _ in range(n))]


def tokens(rows):
    out = defaultdict(int)
    for _, text, source in rows:
        out[source] += len((text or "").split())
    return out


def brute(totals, lift, max_repeats):
    """The flattest exponent within both limits, by plain bisection."""
    whole, n = sum(totals.values()), len(totals)
    shares = {s: t / whole for s, t in totals.items()}

    def entropy(a):
        z = sum(p**a for p in shares.values())
        return -sum(p**a / z * math.log(p**a / z) for p in shares.values())

    target = entropy(1) + lift * (math.log(n) - entropy(1))
    low, high = 0.0, 1.0
    for _ in range(60):
        a = (low + high) / 2
        fits = entropy(a) <= target and (max(shares.values()) / min(shares.values())) ** (1 - a) <= max_repeats
        low, high = (low, a) if fits else (a, high)
    return high, {s: (max(shares.values()) / p) ** (1 - high) for s, p in shares.items()}


@pytest.mark.parametrize("lift, repeats", [(0.5, 2.0), (0.2, 8.0), (1.0, 3.5), (0.0, 2.0)])
def test_weights_and_budgets(make, lift, repeats):
    rows = corpus()
    docs = make(rows, "doc_id long, text string, source string")
    totals = tokens(rows)
    alpha, times = brute(totals, lift, repeats)
    sized = docs.select("source", mixing.word_count(F.col("text")).alias("n_tokens"))
    found, powers, budget = mixing.exponent(mixing.source_totals(sized), lift, repeats)
    assert found == pytest.approx(alpha, abs=1e-6)
    drawn = mixing.drawn(docs, lift, repeats).collect()
    got = defaultdict(int)
    for r in drawn:
        got[r.source] += r.n_tokens
        assert r.n_tokens == len(r.text.split())
    for source, t in totals.items():
        # Never above the budget, and short of it by less than a document.
        assert 0 <= times[source] * t - got[source] + 1 < 52
    copies = Counter(r.doc_id for r in drawn)
    assert set(copies) == {d for d, _, _ in rows}
    assert max(copies.values()) <= math.ceil(repeats)


def test_blocks_come_whole_and_in_turn(make):
    docs = make(corpus(), "doc_id long, text string, source string")
    rows = mixing.in_turn(mixing.drawn(docs).select("doc_id", "source", "n_tokens", "block", "epoch")).collect()
    blocks = defaultdict(set)
    for r in rows:
        blocks[r.source, r.epoch].add((r.turn, r.block))
    for (source, epoch), found in blocks.items():
        assert [t for t, _ in sorted(found)] == list(range(len(found)))
    members = defaultdict(set)
    for r in rows:
        if r.epoch == 0:
            members[r.source, r.block].add(r.doc_id)
    taken = defaultdict(set)
    for r in rows:
        if r.epoch == 1:
            taken[r.source, r.block].add(r.doc_id)
    cut = Counter(source for (source, block), ids in taken.items() if ids != members[source, block])
    assert all(n <= 1 for n in cut.values())


def test_given_budget(make):
    rows = corpus()
    docs = make(rows, "doc_id long, text string, source string")
    drawn = mixing.drawn(docs, 0.5, 2.0, budget=2000.0).collect()
    assert 2000 - 4 * 52 <= sum(r.n_tokens for r in drawn) <= 2000


def test_odd_rows(odd, none):
    found = mixing.drawn(odd).collect()
    ids = Counter(r.doc_id for r in found)
    assert set(ids) == {r[0] for r in odd_rows()}
    assert all(n >= sum(r[0] == d for r in odd_rows()) for d, n in ids.items())
    assert sorted(found[0].asDict()) == sorted({*odd.columns, "n_tokens", "block", "epoch"})
    assert mixing.drawn(none).count() == 0
