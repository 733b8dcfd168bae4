import random
from collections import defaultdict

import pytest

from codesift.llm import linededup

from .conftest import odd_rows, prose


def masked(tokens):
    return tuple("<*>" if any("0" <= c <= "9" for c in t) else t for t in tokens)


def brute(rows):
    """doc_id to the texts left, from ``(doc_id, text)`` rows with distinct ids."""
    lines = [(d, i, tuple(line.split()), len(line)) for d, text in rows if None not in (text, d)
             for i, line in enumerate(text.split("\n")) if line.split()]
    gone, equal, leaves = defaultdict(set), defaultdict(list), defaultdict(list)
    for d, i, raw, chars in sorted(lines):
        equal[raw].append((d, i, chars))
        tokens = masked(raw)
        if len(raw) >= linededup.LEAST_TOKENS and 2 * tokens.count("<*>") <= len(raw):
            leaves[len(raw), tokens[:linededup.DEPTH]].append((d, i, tokens))
    groups = []
    for raw, where in equal.items():
        short = len(raw) < linededup.LEAST_TOKENS and all(c < linededup.LONG_CHARACTERS for *_, c in where)
        groups.append((linededup.SHORT_DOCUMENTS if short else 2, [(d, i) for d, i, _ in where]))
    for members in leaves.values():
        for _ in range(linededup.ROUNDS):
            if not members:
                break
            seed = members[0][2]
            same = [sum(a == b for a, b in zip(t[4:], seed[4:])) * 100 >= 70 * (len(t) - 4) for *_, t in members]
            groups.append((linededup.TEMPLATE_DOCUMENTS, [m[:2] for m, s in zip(members, same) if s]))
            members = [m for m, s in zip(members, same) if not s]
        rest = defaultdict(list)
        for d, i, tokens in members:
            rest[tokens].append((d, i))
        groups += [(linededup.TEMPLATE_DOCUMENTS, w) for w in rest.values()]
    for least, where in groups:
        if len({d for d, _ in where}) >= least:
            home = min(d for d, _ in where)
            for d, i in where:
                if d > home:
                    gone[d].add(i)
    return {d: text if d not in gone else "\n".join(
        line for i, line in enumerate(text.split("\n")) if i not in gone[d]) for d, text in rows}


def left(make, rows):
    return {r.doc_id: r.clean_text for r in linededup.without_recurring_lines(make(rows)).collect()}


def test_templates_across_documents(make):
    rng = random.Random(3)
    rows = []
    for d in range(80):
        lines = [prose(10 * d + i, rng.randint(3, 15)) for i in range(4)]
        lines.insert(1, f"Posted by user{d} on 2024-01-{d % 28 + 1} in the general forum")
        lines.insert(3, "All content here is under a common licence " + rng.choice(["A", "B"]))
        lines.append(rng.choice(["Home About Contact", f"Home {prose(d, 1)}", "x"]))
        if d % 3:
            lines.append(f"The same opening words then {prose(9000 + d, 9)}")
        # Several templates of one leaf, each with a word that differs.
        kind = ["was seen in the old town by a man", "has come down from a far place with his dog",
                "may yet rise over hills and fields of late corn", "will never be what others took it for"][d % 4]
        lines.append(f"One day the moon {kind} {prose(500 + d, 1)}" + " again" * (d % 2))
        rows.append((d, "\n".join(lines)))
    found = linededup.without_recurring_lines(make(rows)).collect()
    want = brute(rows)
    assert {r.doc_id: r.clean_text for r in found} == want
    assert all(r.n_dropped == len(r.text.split("\n")) - len(r.clean_text.split("\n")) for r in found)
    later = [r for r in found if r.doc_id > 1]
    assert all("Posted by" not in r.clean_text and "licence" not in r.clean_text for r in later)
    assert all("same opening" in r.clean_text for r in found if r.doc_id % 3)
    assert sum("One day the moon" in r.clean_text for r in found) <= 40


def test_nothing_unique_is_lost(make):
    rows = [(1, "the price is now low"), (2, "the price is now high"),
            (3, "1 2 3 4 5 6"), (4, "7 8 9 10 11 12"), (5, "2024-01-01 17 3.5 EUR 9"), (6, "2024-01-02 18 3.6 EUR 9")]
    rows += [(10 + i, f"{i} {i * 7} {i * 9} total {i} of {i}") for i in range(20)]
    assert left(make, rows) == dict(rows)


def test_short_and_unparted_lines(make):
    chinese = "这是一个没有空格的长句子它在许多文件里出现过很多次"
    rows = [(i, f"Home About Contact\n{chinese}\n{prose(i, 12)}\nonly here {i}") for i in range(12)]
    rows += [(20 + i, f"Two words\n{prose(50 + i, 12)}") for i in range(9)]
    found = left(make, rows)
    assert found == brute(rows)
    assert [d for d, t in found.items() if "Home" in t] == [0] and [d for d, t in found.items() if chinese in t] == [0]
    assert sum("Two words" in t for t in found.values()) == 9


def test_rows_of_one_id_lose_lines_each_for_itself(make):
    copied = prose(5, 12)
    own = "unique words here that nobody else has at all"
    rows = [(1, copied + "\n" + prose(6, 12)), (2, copied + "\n" + prose(7, 12)), (2, own + "\n" + prose(8, 12))]
    found = linededup.without_recurring_lines(make(rows + rows[2:])).collect()
    texts = sorted((r.doc_id, r.clean_text, r.kept) for r in found)
    assert texts == sorted([(1, rows[0][1], True), (2, prose(7, 12), True), (2, rows[2][1], True), (2, rows[2][1], True)])


def test_long_passages(make):
    passage = prose(50, 70)
    rows = [(d, f"{prose(60 + d, 20)}\n{passage}\n{prose(90 + d, 20)}") for d in range(6)]
    found = {r.doc_id: r for r in linededup.without_recurring_lines(make(rows)).collect()}
    assert passage in found[0].clean_text
    assert all(passage not in found[d].clean_text and found[d].n_dropped == 1 for d in range(1, 6))
    assert all(r.kept for r in found.values())


def test_copies_are_left_empty(make):
    text = f"{prose(1, 20)}\n{prose(2, 20)}"
    found = {r.doc_id: r for r in linededup.without_recurring_lines(make([(5, text), (8, text)])).collect()}
    assert found[5].kept and found[5].clean_text == text
    assert not found[8].kept and found[8].clean_text == ""


def test_odd_rows(odd):
    found = linededup.without_recurring_lines(odd).collect()
    assert len(found) == len(odd_rows())
    want = brute([(d, t) for d, t, *_ in odd_rows() if d not in (None, 16)])
    assert {r.doc_id: r.clean_text for r in found if r.doc_id not in (None, 16)} == want
    assert {r.clean_text for r in found if r.doc_id is None} == {prose(4, 60), None}
    null = next(r for r in found if r.doc_id == 5)
    assert null.n_lines == 0 and null.kept and null.clean_text is None
    assert sorted(found[0].asDict()) == sorted(
        {*odd.columns, "clean_text", "n_lines", "n_dropped", "kept"})


def test_no_documents(none):
    assert linededup.without_recurring_lines(none).count() == 0


@pytest.mark.parametrize("line, tokens", [
    ("", []), ("  a\tb ", ["a", "b"]), ("id 12x 7", ["id", "<*>", "<*>"]), ("é ö", ["é", "ö"])])
def test_tokens(one, line, tokens):
    assert one(linededup.line_tokens, [line]) == [tokens]


def test_templates_of_a_leaf_without_a_limit(make, monkeypatch):
    """Seven templates in one leaf, each with six lines that differ in a word."""
    starts = ["here came the old red fox", "there went a young blue bird", "nobody saw this great grey cat",
              "he found some small green frog", "we met that very white horse", "they sold each fine brown cow",
              "who lost an odd black sheep"]
    rows = [(6 * k + i, f"One day the moon {start} {prose(700 + 10 * k + i, 1)}")
            for i in range(6) for k, start in enumerate(starts)]
    rows += [(100 + d, prose(800 + d, 12)) for d in range(20)]

    def emptied(**options):
        found = linededup.without_recurring_lines(make(rows), **options).collect()
        return sorted(r.doc_id for r in found if r.clean_text == "")

    limited, whole = emptied(), emptied(rounds=None)
    assert limited == [6 * k + i for k in range(3) for i in range(1, 6)]
    assert whole == [6 * k + i for k in range(7) for i in range(1, 6)]
    # The steps in which templates are found make no difference, nor does a limit never reached.
    monkeypatch.setattr(linededup, "FIRST_LINES", 2)
    assert emptied(rounds=None) == emptied(rounds=50) == whole


def test_the_query_takes_all_templates_of_a_leaf(spark, make, tmp_path):
    """Five templates in one leaf, each with six lines that differ in a word; SQL says the same."""
    import duckdb

    from codesift.llm.queries import op8_line_dedup
    from codesift.llm.twins import TWINS

    starts = ["here came the old red fox", "there went a young blue bird", "nobody saw this great grey cat",
              "he found some small green frog", "we met that very white horse"]
    rows = [(5 * i + k, f"One day the moon {start} {prose(900 + 10 * k + i, 1)}")
            for i in range(6) for k, start in enumerate(starts)]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = op8_line_dedup(spark, str(tmp_path)).select("doc_id", "n_dropped", "kept").collect()
    assert sorted(map(tuple, found)) == [(d, int(d > 4), d <= 4) for d in range(30)]
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    told = duck.execute(f"SELECT doc_id, n_dropped, kept FROM ({TWINS['op8_line_dedup']})").fetchall()
    assert sorted(told) == sorted(map(tuple, found))


def test_filters_lose_no_key(make):
    from pyspark.sql import functions as F

    from codesift.llm.common import may_be_in

    rows = make([(i, str(i)) for i in range(5000)] + [(None, "n")])
    keys = rows.filter("doc_id % 7 = 0").select("doc_id")
    found = may_be_in(rows, F.col("doc_id"), keys, "found")
    asked = {r.doc_id for r in found.collect() if r.found}
    assert found.count() == 5001 and found.columns == ["doc_id", "text", "found"]
    assert {i for i in range(0, 5000, 7)} <= asked and len(asked) < 800
    assert not may_be_in(rows, F.col("doc_id"), keys.limit(0), "found").filter("found").count()
