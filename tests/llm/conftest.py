import random

import pytest

WORDS = ("the of and to in is that for it with as on be at by this from or an are was not "
         "mill river stone bread window garden letter silver morning engine market shoulder "
         "winter candle harbour thread copper station meadow bridge").split()

# Extra columns have names that operators use for their own.
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, "
        "key string, size long, _row string, score double, block int, `count` int")


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(words))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, copies, ties, a repeated row."""
    long_line = prose(1, 6000)
    lines = "\n".join(prose(100 + i, 8) for i in range(400))
    base = prose(2, 80)
    near = base.split()
    near[40] = "changed"
    texts = [
        (1, base), (2, base), (3, " ".join(near)), (4, ""), (5, None), (6, " \n\t "),
        (7, long_line), (8, lines), (9, lines + "\nlast line of this one"), (10, "one two"),
        (11, "one two"), (12, "ONE two"), (13, prose(3, 5)), (14, "zwölf Ölfässer größer über äß"),
        (15, "!!! ... 123"), (None, prose(4, 60)), (None, None), (16, "word " * 300), (16, "word " * 300),
        (17, "a\nb\nc\n\n"), (18, prose(5, 49)), (19, "你好世界 " * 40), (20, "x" * 5000),
    ]
    rows = []
    for i, (doc_id, text) in enumerate(texts):
        rows.append((doc_id, text, [None, "en", "de"][i % 3], [None, "a", "b"][i % 3],
                     None if text is None else len(text), bool(i % 2), "k", i, "r", 0.5, 3, 1))
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def make(spark):
    def run(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)

    return run
