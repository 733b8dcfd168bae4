import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from codesift.llm import sharding

from .conftest import odd_rows, prose


def spread(sizes, parts, of):
    sums = np.zeros(parts, np.int64)
    np.add.at(sums, of, sizes)
    return int(sums.max() - sums.min())


def test_differencing_by_hand():
    # 8 7 6 5 4 in two: 8-7=1, 6-5=1, 4-1=3, 3-1=2, so sums 16 and 14.
    assert spread([8, 7, 6, 5, 4], 2, sharding.differenced(np.array([8, 7, 6, 5, 4]), 2)) == 2


@pytest.mark.parametrize("seed", range(5))
def test_differencing_beats_largest_first(seed):
    rng = random.Random(seed)
    sizes = np.array(sorted((rng.randint(1, 10**6) for _ in range(400)), reverse=True))
    sums = [0] * 8
    for size in sizes:
        sums[sums.index(min(sums))] += int(size)
    found = spread(sizes, 8, sharding.differenced(sizes, 8))
    assert found <= max(sums) - min(sums)


def check(rows, texts, shards):
    by_shard, of_text = defaultdict(list), defaultdict(set)
    for r in rows:
        by_shard[r.shard].append(r)
        of_text[r.text_crc32, r.size].add(r.shard)
    assert all(len(s) == 1 for s in of_text.values())
    assert set(by_shard) <= set(range(shards))
    for members in by_shard.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    want = sorted(((d is not None, d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                  for d, t in texts)
    assert sorted(((r.doc_id is not None, r.doc_id), r.size, r.text_crc32) for r in rows) == want
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    return [sum(r.size for r in by_shard[s]) for s in range(shards)]


def test_odd_rows(odd, none):
    rows = sharding.sharded(odd).collect()
    check(rows, [(r[0], r[1]) for r in odd_rows()], 8)
    assert sharding.sharded(none).count() == 0


@pytest.mark.parametrize("last", [16_384, 40])
def test_balance(make, monkeypatch, last):
    # With few items in the last task the tree has several levels.
    monkeypatch.setattr(sharding, "LAST", last)
    monkeypatch.setattr(sharding, "BUCKET", 60)
    monkeypatch.setattr(sharding, "PARTS", 16)
    rng = random.Random(4)
    texts = [(i, prose(i % 500, rng.randint(1, 60))) for i in range(900)]
    totals = check(sharding.sharded(make(texts), 4).collect(), texts, 4)
    assert max(totals) - min(totals) <= 0.02 * sum(totals) / 4


def test_one_group_larger_than_a_shard(make, monkeypatch):
    monkeypatch.setattr(sharding, "LAST", 40)
    monkeypatch.setattr(sharding, "BUCKET", 60)
    monkeypatch.setattr(sharding, "PARTS", 16)
    hot = prose(1, 300)
    texts = [(i, hot) for i in range(200)] + [(1000 + i, prose(i + 5, 20)) for i in range(400)]
    totals = sorted(check(sharding.sharded(make(texts), 4).collect(), texts, 4))
    assert totals[3] == 200 * (len(hot) + 1)  # nothing else beside it
    assert totals[2] - totals[0] <= 0.1 * totals[0]
