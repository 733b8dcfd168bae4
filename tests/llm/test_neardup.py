import random
from collections import defaultdict

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler

from codesift.llm import neardup
from codesift.llm.common import components, with_more_edges

from .conftest import odd_rows, prose


def sets(text):
    # Words in ASCII lower case only, parted at ASCII white space.
    words = neardup.words_of((text or "").encode())
    if not words:
        return set()
    if len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i: i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    found = [(d, sets(t)) for d, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(found):
        for j, (_, b) in enumerate(found[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    lowest = defaultdict(lambda: 1 << 60)
    for i, (d, _) in enumerate(found):
        lowest[root(i)] = min(lowest[root(i)], d)
    return {(d, len(s), lowest[root(i)], d == lowest[root(i)]) for i, (d, s) in enumerate(found)}


def edited(text, rng, share):
    words = text.split()
    for i in rng.sample(range(len(words)), max(1, int(share * len(words)))):
        words[i] = f"new{rng.randint(0, 10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(make, seed):
    rng = random.Random(seed)
    rows, shared = [], prose(900, 60)
    for group in range(40):
        text = prose(1000 * seed + group, rng.randint(30, 200))
        for _ in range(rng.randint(1, 6)):
            # Edits of 1 to 6 percent of words put similarities on both sides of the threshold.
            rows.append((len(rows), edited(text, rng, rng.choice([0.0, 0.01, 0.03, 0.06]))))
    rows += [(len(rows) + i, shared + " " + prose(7000 + i, 40)) for i in range(60)]
    rng.shuffle(rows)
    found = neardup.near_duplicates(make(rows)).collect()
    assert {tuple(r) for r in found} == brute(rows)


def test_crowded_regions(make, monkeypatch):
    # Many near copies of one text: regions are parted as deep as the tree goes and beyond.
    monkeypatch.setattr(neardup, "REGION", 8)
    rng = random.Random(9)
    text = prose(77, 120)
    rows = [(i, edited(text, rng, 0.01)) for i in range(150)] + [(500, prose(78, 120))]
    found = neardup.near_duplicates(make(rows)).collect()
    assert {tuple(r) for r in found} == brute(rows)


def test_many_leaves_around_one_base(make):
    # Leaves are like the base and not like each other, far more of them than neighbours.
    rng = random.Random(4)
    base = prose(55, 120)
    rows = [(5000, base)]
    for i in range(1000):
        words = base.split()
        for j in (5, 45, 85):
            words[j + rng.randrange(30)] = f"leaf{i}n{j}"
        rows.append((i, " ".join(words)))
    whole = [sets(t) for _, t in rows]
    assert all(100 * len(s & whole[0]) >= 75 * len(s | whole[0]) for s in whole)
    found = neardup.near_duplicates(make(rows)).collect()
    assert {r.component_id for r in found} == {0} and len(found) == 1001


def test_odd_rows(odd):
    found = neardup.near_duplicates(odd).collect()
    assert len(found) == len(odd_rows())
    nulls = [r for r in found if r.doc_id is None]
    assert len(nulls) == 2 and all(r.component_id is None and r.kept for r in nulls)
    want = brute([(d, t) for d, t, *_ in odd_rows() if d is not None])
    assert {tuple(r) for r in found if r.doc_id is not None} == want


def test_no_documents(none):
    assert neardup.near_duplicates(none).count() == 0


def test_models_work_after_components(spark, make):
    components(make([(1, 2), (2, 3)], "a long, b long"))
    rows = make([(float(i % 2), float(i)) for i in range(20)], "label double, x double")
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    model = RandomForestClassifier(numTrees=2, maxDepth=2).fit(rows)
    assert model.hasSummary and model.transform(rows).count() == model.transform(rows).filter(
        "prediction is not null").count() == 20


def test_components(make):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200), (200, 150), (7, 7)]
    found = {tuple(r) for r in components(make(edges, "a long, b long")).collect()}
    assert found == {(i, 0) for i in range(31)} | {(100, 100), (150, 100), (200, 100)}
    assert components(make([], "a long, b long")).count() == 0


def test_more_edges(make):
    label = components(make([(1, 2), (2, 3), (10, 11), (20, 21)], "a long, b long"))
    assert with_more_edges(label, make([(1, 3)], "a long, b long")) is label
    assert with_more_edges(label, make([], "a long, b long")) is label
    found = with_more_edges(label, make([(11, 3), (21, 30), (40, 41)], "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {
        *((i, 1) for i in (1, 2, 3, 10, 11)), (20, 20), (21, 20), (30, 20), (40, 40), (41, 40)}


def recorded(monkeypatch, name, of):
    """What a function of the module is called on, by count."""
    seen, plain = [], getattr(neardup, name)

    def run(*args):
        seen.append(of(*args))
        return plain(*args)

    monkeypatch.setattr(neardup, name, run)
    return seen


def test_a_closed_group_is_not_expanded(make, monkeypatch):
    # 800 near copies are one component before the exact join, which has nothing left to do.
    rng = random.Random(12)
    text = prose(31, 100)
    rows = [(i, edited(text, rng, 0.01)) for i in range(800)] + [(900, prose(32, 100))]
    expanded = recorded(monkeypatch, "_prefixes", lambda sets: sets.count())
    found = neardup.near_duplicates(make(rows)).collect()
    assert {r.component_id for r in found} == {0, 900} and expanded == []


def test_a_shared_passage_makes_no_pairs(make, monkeypatch):
    # 84 words of 100 are the same in all, which is just too little; each is its own component.
    passage = prose(41, 84)
    rows = [(i, passage + " " + " ".join(f"own{i}x{j}" for j in range(16))) for i in range(2000)]
    pairs = recorded(monkeypatch, "confirmed", lambda pairs, sets: pairs.count())
    expanded = recorded(monkeypatch, "_prefixes", lambda sets: sets.count())
    found = neardup.near_duplicates(make(rows)).collect()
    assert all(r.kept for r in found) and len(found) == 2000
    assert expanded == [2000]
    # The last join tries none; neighbours and hubs are a few for each document.
    assert pairs[-1] == 0 and sum(pairs) <= 70 * 2000


def test_blocks_give_all_pairs(make, monkeypatch):
    rng = random.Random(3)
    rows = [(i, rng.randrange(20, 40), i, float(i % 3), key, rng.randrange(0, 6))
            for i in range(60) for key in rng.sample(range(9), 3)]
    docs = make(rows, "id long, n long, component long, typical double, key long, at long")
    want = set()
    for a in rows:
        for b in rows:
            need, left = 75 * (a[1] + b[1]), min(a[1] - a[5], b[1] - b[5])
            if a[4] == b[4] and a[0] < b[0] and 100 * min(a[1], b[1]) >= 75 * max(a[1], b[1]) and 175 * left >= need:
                want.add((a[0], b[0]))
    for block in (512, 4):
        monkeypatch.setattr(neardup, "BLOCK", block)
        assert {tuple(r) for r in neardup.met_in_blocks(docs).collect()} == want
