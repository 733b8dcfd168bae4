from collections import Counter

import pytest
from pyspark.sql import functions as F

from codesift.llm import quality

from .conftest import odd_rows, prose


def brute(text):
    words = [w for w in (text or "").translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w]
    windows = Counter(tuple(words[i: i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) for j in range(3) if windows[tuple(words[i: i + 3])] > 1}
    lines = [x for x in (text or "").split("\n") if any(c not in " \t\v\f\r" for c in x)]
    return (len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("text", ["a b c a b c", "a a a a", "a b", "x y z\nx y z\n\nq", "é# ü$ 你好 <|>"])
def test_measures(make, text):
    row = quality.measured(make([(1, text, "h")], "doc_id long, text string, h string"), "h").first()
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == brute(text)


def test_odd_rows(odd, none):
    found = quality.judged(odd, "source").collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                 for r in found)
    assert got == sorted((str(d), *brute(t)) for d, t, *_ in odd_rows())
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality.judged(none, "source").count() == 0


def test_bad_hosts_go_and_small_ones_are_shrunk(make):
    rows = [(i, prose(i, 60), f"good{i % 8}") for i in range(160)]
    rows += [(1000 + i, prose(i, 60) if i % 5 == 0 else "too short", "bad") for i in range(60)]
    rows += [(2000, "too short", "few"), (2001, prose(9, 60), "few")]
    found = quality.judged(make(rows, "doc_id long, text string, host string"), "host").collect()
    kept = {r.doc_id for r in found if r.kept}
    assert kept == {i for i in range(160)} | {2001}
    rates = {r.host: r.short_rate for r in found}
    assert rates["few"] < 0.5 < rates["bad"] < 0.8


def test_prior_is_the_moments_of_the_hosts(make):
    hosts = make([("a", 100, 10), ("b", 50, 20), ("c", 10, 0)], "host string, docs long, failed long")
    alpha, beta = quality.prior(hosts, "failed")
    mean, total = 30 / 160, 160
    chance = mean * (1 - mean)
    spread = sum(n * (f / n - mean) ** 2 for n, f in [(100, 10), (50, 20), (10, 0)])
    rho = (spread - chance * 2) / (chance * (total - (100**2 + 50**2 + 10**2) / total - 2))
    assert (alpha, beta) == pytest.approx((mean * (1 / rho - 1), (1 - mean) * (1 / rho - 1)))
    same = make([("a", 100, 10), ("b", 50, 5)], "host string, docs long, failed long")
    assert sum(quality.prior(same, "failed")) > 1e5
    assert quality.prior(hosts.withColumn("failed", F.lit(0)), "failed")[0] == 0
