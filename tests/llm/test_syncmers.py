import hashlib
import random

import pytest
import xxhash

from codesift.llm import syncmers

from .conftest import odd_rows, prose

K, S = syncmers.K, syncmers.S


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def anchors(raw):
    inner = [signed(xxhash.xxh64_intdigest(raw[i: i + S], seed=42)) for i in range(len(raw) - S + 1)]
    span = K - S + 1
    return [(i, raw[i: i + K]) for i in range(len(raw) - K + 1)
            if min(inner[i: i + span]) in (inner[i], inner[i + span - 1])]


def likeness(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("text", [
    "", "short", "x" * 100, "abc" * 30, prose(1, 3), prose(2, 50), "größer als äöü " * 9, "你好世界" * 12])
def test_anchors(one, text):
    got = one(lambda c: syncmers.anchors(c.cast("binary")), [text])[0]
    assert [v >> 32 for v in got] == [i for i, _ in anchors(text.encode())]


def test_anchors_do_not_depend_on_what_is_around(one):
    passage = prose(3, 40)
    alone, within = one(lambda c: syncmers.anchors(c.cast("binary")),
                        [passage, prose(4, 10) + passage + prose(5, 10)])
    assert {v & 0xFFFFFFFF for v in alone} <= {v & 0xFFFFFFFF for v in within}


def parts(text):
    found = [k for _, k in anchors(text.encode())]
    return found or ([text.encode()] if text else [])


def check(rows, found):
    """Every row against a direct search in the whole edited text."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    want = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        a, b, c = parts(text), parts(edited), parts(after)
        want.append((str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest(), len(a),
                     len(b), round(likeness(a, b), 9), round(likeness(a, c), 9)))
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256, len(r.fingerprint) // 8,
            len(r.edited_fingerprint) // 8, round(r.near_edited, 9), round(r.near_next, 9)) for r in found]
    assert sorted(got) == sorted(want)


def test_against_direct_search(make):
    rng = random.Random(6)
    rows = [(i * 3, prose(i % 25, rng.randint(0, 90))) for i in range(60)]
    rows += [(500 + i, "äöü€你" * rng.randint(0, 30)) for i in range(10)]
    found = syncmers.fingerprints(make(rows)).collect()
    check(rows, found)
    prints = {}
    texts = dict(rows)
    for r in found:
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint


def test_odd_rows(odd, none):
    found = syncmers.fingerprints(odd).collect()
    check([(r[0], r[1]) for r in odd_rows()], found)
    assert syncmers.fingerprints(none).count() == 0


def test_a_document_alone(make):
    check([(9, prose(1, 30))], syncmers.fingerprints(make([(9, prose(1, 30))])).collect())


def test_no_python_in_the_plan(odd):
    plan = syncmers.fingerprints(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
