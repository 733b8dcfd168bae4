import random
import re
from collections import Counter

import numpy as np

from codesift.llm import collocations

from .conftest import odd_rows


def brute(rows, top=collocations.TOP):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i: i + k])] += 1
    found = {p: a for p, a in counts.items() if a >= 10 and len(p[1]) > 1}
    out = {}
    for (lang, words), a in found.items():
        if len(words) == 2 and any(
                b * 100 >= 50 * a for (other, longer), b in found.items()
                if other == lang and words in (longer[:2], longer[1:]) and len(longer) == 3):
            continue
        cuts = [(10**6 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k)
                for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append(
            (-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, totals[lang], -s) for lang, rows in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def found(docs, **how):
    rows = collocations.collocations(docs, **how).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(map(tuple, rows.collect()))


def test_odd_rows(odd, none):
    rows = [r for r in odd_rows() for _ in range(1)]
    want = brute([(r[2], r[1]) for r in rows])
    assert found(odd) == want and want
    assert found(none) == []


def some_rows():
    rng = random.Random(5)
    words = ["new", "york", "City", "the", "of", "São", "Paulo", "a.b", "x\ty", "\tq", "!", "ñ,", "#", "'", "日本"]
    rows = [(rng.choice([None, "en", "und", "de"]),
             " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) + rng.choice([".", "\n", "\r\n", "", " "]))
            for _ in range(300)]
    return rows + [("en", "new york city hall " * 40), ("en", "ha ha ha ha ha " * 9), ("de", "w" * 200 + " nach hause\n")] * 11


def test_against_all_phrases(make, monkeypatch):
    rows = some_rows()
    docs = make(rows, "lang string, text string").repartition(5)
    want = brute(rows)
    assert found(docs) == want and {r[0] for r in want} == {"en", "de", "und"}
    assert found(docs, top=3) == brute(rows, 3)
    # Neither the filter nor the size of buffers decides anything.
    monkeypatch.setattr(collocations, "BUFFER", 50)
    for bits in (4, 17):
        monkeypatch.setattr(collocations, "LEAST_BITS", bits)
        monkeypatch.setattr(collocations, "MOST_BITS", bits)
        assert found(docs) == want


def test_windows_of_wide_and_narrow_numbers():
    rng = np.random.default_rng(1)
    numbers = np.concatenate([np.append(rng.integers(0, 6, 50), [0, 0]) for _ in range(4)])
    often = rng.random(len(numbers) - 1) < 0.7
    often &= (numbers[:-1] != 0) & (numbers[1:] != 0)
    want = Counter()
    for i in range(len(numbers) - 2):
        if numbers[i]:
            second = numbers[i + 1] if often[i] else 0
            want[numbers[i], second, numbers[i + 2] if second and often[i + 1] else 0] += 1
    for known in (5, 2**22):
        rows, n = collocations._windows(numbers, often, known)
        assert {tuple(r): c for r, c in zip(rows.T.tolist(), n.tolist())} == want


def test_no_frequent_pair_is_missed(make, monkeypatch):
    monkeypatch.setattr(collocations, "BUFFER", 300)
    rows = some_rows()
    docs = make(rows, "lang string, text string").repartition(4)
    counts = Counter()
    for lang, text in rows:
        ids = collocations._Ids()
        numbers = collocations._numbered(text.encode(), ids)
        names = [b"", *ids.words()]
        for a, b in zip(numbers[:-1], numbers[1:]):
            if a and b:
                counts["und" if lang is None else lang, names[a], names[b]] += 1
    for bits in (8, 18):
        bitmap = collocations.frequent_pairs(docs, bits)
        seen = Counter()
        for (lang, a, b), n in counts.items():
            ids = collocations._Ids()
            numbers = np.array([ids[a], ids[b]])
            bucket = int(collocations._pair_buckets(lang, ids, numbers, bits)[0])
            seen[bucket] += n
        assert [i for i, bit in enumerate(np.unpackbits(bitmap)) if bit] == sorted(
            b for b, n in seen.items() if n >= collocations.LEAST_COUNT)
