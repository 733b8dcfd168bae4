import hashlib
import zlib

import pytest

from codesift.llm import merkle

from .conftest import odd_rows, prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i: i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    for level in levels[:-1]:
        run = level[i // 3 * 3: i // 3 * 3 + 3]
        yield run[: i % 3], run[i % 3 + 1:]
        i //= 3


def brute(rows):
    groups, out = {}, []
    for doc_id, text, lang, source, n_chars in rows:
        met = text
        if None not in (doc_id, text) and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            met = text.replace("\n", "")
        leaves = [digest(*map(framed, (doc_id, source, lang, n_chars, t))) for t in (text, met)]
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, *leaves, doc_id))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in sources:
        groups[source].sort(key=lambda x: x[:3])
        trees.append(levels_of([x[2] for x in groups[source]]))
    top = levels_of([t[-1][0] for t in trees])
    for place, (source, tree) in enumerate(zip(sources, trees)):
        for i, (_, _, leaf, fold, doc_id) in enumerate(groups[source]):
            siblings = []
            for before, after in [*path(tree, i), *path(top, place)]:
                siblings += before + after
                fold = digest(*before, fold, *after)
            root = top[-1][0]
            out.append((doc_id, leaf, tree[-1][0], root, digest(*siblings), fold, fold == root))
    return sorted(out, key=str)


def found(docs):
    rows = merkle.manifest(docs, merkle.without_breaks(docs)).collect()
    return sorted(map(tuple, rows), key=str)


def test_odd_rows(spark, odd, none):
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    assert found(odd) == brute([r[:5] for r in odd_rows()])
    assert found(none) == []
    assert spark.conf.get(limit) == before


@pytest.mark.parametrize("sizes", [[1], [4], [27, 3, 1, 82]])
def test_trees_of_all_sizes(make, sizes):
    rows = [(100 * s + i, prose(i, 3) + "\n\nend\n", "en", [None, "b", "a", "ä"][s], 9)
            for s, n in enumerate(sizes) for i in range(n)]
    got = found(make(rows, SCHEMA))
    assert got == brute(rows)
    assert {r[-1] for r in got} <= {True, False} and len({r[3] for r in got}) == 1


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()])
    assert found(docs) == want


def test_any_change_shows(make):
    rows = [(i, f"text {i}", "en", "s", 6) for i in range(20)]
    docs = make(rows, SCHEMA)
    got = {r.doc_id: r.verified for r in merkle.manifest(
        docs, merkle.F.when(docs.doc_id == 7, "other").otherwise(docs.text)).collect()}
    assert got == {i: i != 7 for i in range(20)}
