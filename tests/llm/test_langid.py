import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from codesift.llm import langid

from .conftest import odd_rows, prose

SYLLABLES = {"en": "th er ing ea st on", "de": "sch ung en ber ich zu", "fr": "eau oi tre que é en"}


def texts(n, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        parts = SYLLABLES[lang].split()
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
                 for _ in range(rng.randint(6, 60))]
        out.append((i, " ".join(words).capitalize(), lang))
    return out


def test_held_out_accuracy(make):
    rows = texts(300)
    found = langid.identified(make(rows, "doc_id long, text string, lang string")).collect()
    out = [r for r in found if r.held_out]
    assert {r.doc_id for r in out} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == r.lang for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in found)


def test_only_the_text_is_looked_at(make):
    rows = texts(120)
    schema = "doc_id long, text string, lang string"
    before = {r.doc_id: (r.lang_pred, r.score) for r in langid.identified(make(rows, schema)).collect()}
    other = [(i, t, "en" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    after = {r.doc_id: (r.lang_pred, r.score) for r in langid.identified(make(other, schema)).collect()}
    assert before == after


def brute_grams(text):
    # Words of letters and marks between blanks; every run of four characters inside.
    out = Counter()
    word = ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        else:
            padded = f" {word} " if word else ""
            out.update(padded[i: i + 4] for i in range(len(padded) - 3))
            word = ""
    return out


@pytest.mark.parametrize("text", [
    "Some words, and more.", "a bc déf", "", "x", "12 ab34cd", "ÜBER straße"])
def test_grams(text):
    keys, of, has = langid.grams(["before it", text, "after"])
    found = Counter("".join(chr(int(k) >> s & 0xFFFF) for s in (48, 32, 16, 0))
                    for k in keys[of == 1])
    assert found == brute_grams(text)
    assert has[1] == any(c.isalpha() for c in text)


def test_filters_answer_for_all_languages(make):
    rows = texts(200)
    filters = langid.learn(make(rows, "doc_id long, text string, lang string"))
    counts = {lang: Counter() for lang in SYLLABLES}
    for _, text, lang in rows:
        counts[lang].update(brute_grams(text))
    rates = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    wrong = total = 0
    for gram in set().union(*counts.values()):
        best = max(r.get(gram, 0) for r in rates.values())
        key = np.array([sum(ord(c) << s for c, s in zip(gram, (48, 32, 16, 0)))], np.uint64)
        mask = np.bitwise_and.reduce([filters.masks[0][s] for s in langid.slots_of(key)])[()]
        mask = int(np.ravel(mask)[0])
        for i, lang in enumerate(filters.languages):
            rate = rates[lang].get(gram, 0)
            holds = rate >= langid.LEAST_RATE and rate >= langid.LEAST_RATIO * best
            assert mask >> i & 1 or not holds  # nothing is missed
            wrong += bool(mask >> i & 1) and not holds
            total += not holds
    assert wrong <= 0.01 * total + 1


def test_more_than_64_languages(make):
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for lang in range(70):
        parts = ["".join(rng.choice(letters) for _ in range(5)) for _ in range(8)]
        rows += [(6 * lang + i, " ".join(rng.choice(parts) for _ in range(30)), f"l{lang:02}")
                 for i in range(6)]
    found = langid.identified(make(rows, "doc_id long, text string, lang string")).collect()
    assert sum(r.lang_pred == r.lang for r in found) >= 0.97 * len(found)


def test_odd_rows(odd, none):
    found = langid.identified(odd).collect()
    assert len(found) == len(odd_rows())
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    for doc_id in (4, 5, 6, 15):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    assert all(r.lang_pred in ("en", "de") for r in found if r.text and any(c.isalpha() for c in r.text))
    assert not any(r.held_out for r in found if r.doc_id is None)
    assert langid.identified(none).count() == 0
    assert {r.lang_pred for r in langid.predicted(odd, langid.learn(none)).collect()} == {"und"}


def han_and_english(seed=3):
    rng = random.Random(seed)
    signs = [chr(0x4E00 + i) for i in range(3000)]
    odds = [1 / (i + 1) for i in range(3000)]
    rows = []
    for i in range(600):
        drawn = rng.choices(signs, odds, k=720)
        rows.append((i, "。".join("".join(drawn[j: j + 12]) for j in range(0, 720, 12)), "zh"))
    return rows + [(600 + i, t, "en") for i, t, lang in texts(900, seed) if lang == "en"]


def test_scripts_without_blanks(spark, make):
    import corpus_pipeline

    rows = han_and_english()
    junk = [(9000 + i, " ".join("".join(chr(0x410 + (7 * i + j * k) % 32) for k in range(1, 9)) for j in range(40)),
             None) for i in range(20)]
    short = [(9500, "你", None), (9501, "x y z", None), (9502, "Да.", None)]
    schema = "doc_id long, text string, lang string"
    found = langid.identified(make(rows + junk + short, schema), floors=True).collect()
    lang = {d: x for d, _, x in rows}
    assert all(r.lang_pred == lang[r.doc_id] for r in found if r.doc_id in lang and r.held_out)
    docs = make([(*r, "s", 1) for r in rows + junk + short], schema + ", source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert kept == set(lang) | {9500, 9501, 9502}


def test_pairs_in_unparted_scripts():
    keys, of, has = langid.grams(["你好世 abcd", "好", "กข", "ab你"])
    found = [("".join(chr(int(k) >> s & 0xFFFF) for s in (48, 32, 16, 0)).strip("\0"), int(o)) for k, o in zip(keys, of)]
    assert found == [("你好", 0), ("好世", 0), (" abc", 0), ("abcd", 0), ("bcd ", 0), ("กข", 2), (" ab你", 3), ("ab你 ", 3)]
    assert has.tolist() == [True] * 4


def test_memory_of_a_batch_does_not_grow_with_its_texts():
    texts = [prose(i % 20, 200) for i in range(2000)]
    assert sum(map(len, texts)) > 3_000_000
    filters = langid.Filters(["a", "b"], np.ones((1, 2**langid.SLOT_BITS), np.uint64), np.full(2, 0.1), 0, np.zeros(2))
    langid.grams(texts[:1])
    tracemalloc.start()
    for low, high, go_on in langid._pieces(texts):
        langid.judge(texts[low:high], filters, go_on)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000


def test_pieces_of_a_chunk_give_its_grams(monkeypatch):
    monkeypatch.setattr(langid, "_PIECE", 300)
    texts = [prose(i, 10) for i in range(30)] + ["", " 1 ", "1st", "中文字 ab", "é"] + [prose(i, 20) for i in range(9)]
    keys, of, has = langid.grams(texts)
    parts = [(low, langid.grams(texts[low:high], go_on)) for low, high, go_on in langid._pieces(texts)]
    assert len(parts) > 10
    assert np.array_equal(keys, np.concatenate([p[0] for _, p in parts]))
    assert np.array_equal(of, np.concatenate([low + p[1] for low, p in parts]))
    assert np.array_equal(has, np.concatenate([p[2] for _, p in parts]))
