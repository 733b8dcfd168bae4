"""Collocations from counts of the longest windows alone.

A piece of text is a run of words without a stop. Every place in a piece gives one window:
the word there and, as lead columns, the two after it, padded with nothing where the piece
ends. Only these windows are counted. What shorter phrases come to follows by
marginalisation: a ``ROLLUP`` over the window's growing prefixes sums them, so a phrase's
count is that of the windows which begin with it, and a word's that of all windows at it.

Most windows come once. A phrase that comes ``LEAST_COUNT`` times has only pairs of words
that do, so a window may be padded from the first pair on that is surely rarer, and no
count that matters changes. Which pairs are rare a filter of hashed counts tells (after
Park, Chen and Yu, 1995): counts of pairs by bucket, summed over all texts, leave one bit
for each bucket. A bucket of several pairs may seem frequent and then merely costs time.
The filter has about one bit for two words and ``MOST_BITS`` at most, so what is broadcast
is bounded; on corpora far beyond that size it pads less, with the same results.

Windows are counted within tasks first, in buffers of a fixed number of words, then by Spark.

Defined results: null and empty texts have no words; a null lang counts as ``und``, next to
a lang of that name; repeated rows count each time, whatever their ids; ties of score and
count go by the phrase's bytes; a lang with fewer phrases gives all it has, an empty table
no rows. Columns other than text and lang are ignored, and so none can clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesift.llm.hashing import ODD, mixed, word_hashes
from codesift.session import written

STOPS = ".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"
LONGEST = 3
LEAST_COUNT = 10
INSIDE_PERCENT = 50
SCALE = 1_000_000
TOP = 2000
# Parts in which the phrases of a lang are ordered before its first ones are.
PARTS = 64
# Words counted in a task before the counts go out.
BUFFER = 2_000_000
# Bits of a bucket's number in the filter: 8 kB for the least, 64 MB for the most.
LEAST_BITS, MOST_BITS = 16, 29
_BYTES_A_BIT = 12
# Buckets whose counts travel together.
_CHUNK_BITS = 16
_SMALL_IDS = 2**21
_STOP = b"."
_FOLD = bytes(
    ord(_STOP) if chr(c) in STOPS else 0x20 if c == 9 else c + 32 if 65 <= c <= 90 else c
    for c in range(256))


def words_and_stops(text: bytes) -> list[bytes]:
    """The words of a text, A to Z in lower case, with a full stop between its pieces."""
    # All that bytes.split() takes for blank is a space or a stop by then.
    return text.translate(_FOLD).replace(_STOP, b" . ").split()


class _Ids(dict):
    """Numbers for words as they come; 0 is a stop."""

    def __init__(self):
        super().__init__({_STOP: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number

    def words(self) -> list[bytes]:
        return list(self)[1:]


def _numbered(text: bytes, ids: _Ids) -> np.ndarray:
    words = words_and_stops(text)
    # Stops at the end, so that no window reaches into the next text.
    out = np.zeros(len(words) + 2, np.int64)
    out[:-2] = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    return out


def _buffers(batches):
    """``lang, ids, numbers`` of about ``BUFFER`` words of texts, a lang at a time."""
    langs: dict[str, tuple[_Ids, list]] = {}
    size = 0

    def held():
        return [(lang, ids, np.concatenate(parts)) for lang, (ids, parts) in langs.items()]

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids, parts = langs.setdefault(lang, (_Ids(), []))
            parts.append(_numbered(text.as_py(), ids))
            size += len(parts[-1])
            if size >= BUFFER:
                yield from held()
                langs, size = {}, 0
    yield from held()


def _pair_buckets(lang: str, ids: _Ids, numbers: np.ndarray, bits: int) -> np.ndarray:
    """The filter's bucket for the pair that begins at each place but the last."""
    hashes = np.concatenate([np.zeros(1, np.uint64), word_hashes(ids.words())])[numbers]
    own = word_hashes([lang.encode()])[0]
    return (mixed((hashes[:-1] * ODD + hashes[1:]) * ODD + own) >> np.uint64(64 - bits)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.filter("text is not null").select(
        F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("binary"))


def frequent_pairs(docs: DataFrame, bits: int) -> np.ndarray:
    """The filter: 8 buckets a byte, a bit set where ``LEAST_COUNT`` pairs or more fell."""
    size = 1 << min(_CHUNK_BITS, bits)

    def count(batches):
        for lang, ids, numbers in _buffers(batches):
            pair = (numbers[:-1] != 0) & (numbers[1:] != 0)
            found, n = np.unique(_pair_buckets(lang, ids, numbers, bits)[pair], return_counts=True)
            n = np.minimum(n, LEAST_COUNT).astype(np.uint8)
            chunk, at = found // size, (found % size).astype(np.uint16)
            starts = np.flatnonzero(np.diff(chunk, prepend=-1))
            ends = [*starts[1:], len(chunk)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk[starts]),
                 pa.array([at[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary()),
                 pa.array([n[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary())],
                ["chunk", "places", "counts"])

    def add_up(batches):
        sums: dict[int, np.ndarray] = {}  # the chunks of this task, whatever the corpus
        for batch in batches:
            for chunk, places, counts in zip(*(c.to_pylist() for c in batch.columns)):
                total = sums.setdefault(chunk, np.zeros(size, np.uint8))
                at = np.frombuffer(places, np.uint16)
                total[at] = np.minimum(total[at] + np.frombuffer(counts, np.uint8), LEAST_COUNT)
        for chunk, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([np.packbits(total >= LEAST_COUNT).tobytes()], pa.binary())],
                ["chunk", "bits"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = _texts(docs).mapInArrow(count, "chunk long, places binary, counts binary").repartition(
        parts, "chunk").mapInArrow(add_up, "chunk long, bits binary").toArrow()
    whole = np.zeros((1 << bits) // size * (size // 8), np.uint8)
    for chunk, part in zip(*(c.to_pylist() for c in found.columns)):
        whole[chunk * (size // 8): (chunk + 1) * (size // 8)] = np.frombuffer(part, np.uint8)
    return whole


def _windows(numbers: np.ndarray, often: np.ndarray, known: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct padded windows of numbered words, as rows of three numbers, and their counts.

    ``often`` says of each place but the last whether the pair there may be frequent.
    """
    first = numbers[:-2]
    second = np.where(often[:-1], numbers[1:-1], 0)
    third = np.where((second != 0) & often[1:], numbers[2:], 0)
    at = first != 0
    if known < _SMALL_IDS:
        packed, n = np.unique((first[at] << 42) | (second[at] << 21) | third[at], return_counts=True)
        low = _SMALL_IDS - 1
        return np.stack([packed >> 42, (packed >> 21) & low, packed & low]), n
    rows, n = np.unique(np.stack([first[at], second[at], third[at]], axis=1), axis=0, return_counts=True)
    return rows.T, n


def window_counts(docs: DataFrame, often: np.ndarray, bits: int) -> DataFrame:
    """``lang, key, n``: the windows and how often they come; a key joins words by spaces."""
    shared = docs.sparkSession.sparkContext.broadcast(often)

    def run(batches):
        bitmap = shared.value
        blank = pa.scalar(b" ", pa.large_binary())
        for lang, ids, numbers in _buffers(batches):
            bucket = _pair_buckets(lang, ids, numbers, bits)
            frequent = (bitmap[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8) & 1).astype(bool)
            rows, n = _windows(numbers, frequent & (numbers[:-1] != 0) & (numbers[1:] != 0), len(ids))
            names = pa.array([None, *ids.words()], pa.large_binary())
            for low in range(0, len(n), 100_000):
                words = [names.take(pa.array(r[low: low + 100_000])) for r in rows]
                key = pc.binary_join_element_wise(*words, blank, null_handling="skip")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(key), np.int8))),
                     key.cast(pa.binary()), pa.array(n[low: low + 100_000])], ["lang", "key", "n"])

    found = _texts(docs).mapInArrow(run, "lang string, key binary, n long")
    return found.groupBy("lang", F.col("key").cast("string").alias("key")).agg(F.sum("n").alias("n"))


def _words(key: str) -> Column:
    return F.length(key) - F.length(F.translate(key, " ", "")) + 1


def marginalised(windows: DataFrame) -> DataFrame:
    """``lang, key, words, n``: counts of all prefixes of the windows that come often enough.

    ``words`` is 0 in the row of a lang's total. ``windows`` is read twice.
    """
    pair = F.when(_words("key") >= 2, F.substring_index("key", " ", 2))
    shorter = windows.select("lang", F.substring_index("key", " ", 1).alias("first"), pair.alias("pair"), "n").rollup(
        "lang", "first", "pair").agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
    # A window padded after its first word has no pair; its word is counted one level up.
    shorter = shorter.filter(
        ((F.col("level") == 0) & F.col("pair").isNotNull() & (F.col("n") >= LEAST_COUNT))
        | ((F.col("level") == 1) & (F.col("n") >= LEAST_COUNT)) | (F.col("level") == 3)).select(
        "lang", F.coalesce("pair", "first", F.lit("")).alias("key"),
        F.when(F.col("level") == 0, 2).when(F.col("level") == 1, 1).otherwise(0).alias("words"), "n")
    longest = windows.filter((F.col("n") >= LEAST_COUNT) & (_words("key") == LONGEST)).select(
        "lang", "key", F.lit(LONGEST).alias("words"), "n")
    return shorter.unionByName(longest)


def scored(counts: DataFrame) -> DataFrame:
    """``lang, key, words, a, l, r, score`` of the candidates, each with its lowest cut."""
    phrases = counts.filter("words >= 2").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    phrases = phrases.select(
        "lang", "key", "words", F.col("n").alias("a"), "cut",
        F.expr("substring_index(key, ' ', cut)").alias("_left"),
        F.expr("substring_index(key, ' ', cut - words)").alias("_right"))
    parts = counts.filter("words between 1 and 2")
    for side, name in (("_left", "l"), ("_right", "r")):
        phrases = phrases.join(parts.select(
            F.col("lang").alias("_lang"), F.col("key").alias("_part"), F.col("n").alias(name)),
            (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))).drop("_lang", "_part")
    cut = phrases.withColumn("score", F.expr(
        f"(cast({SCALE} as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)))"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    return cut.groupBy("lang", "key", "words").agg(
        F.min(F.struct("score", "cut", "a", "l", "r")).alias("m")).select(
        "lang", "key", "words", "m.a", "m.l", "m.r", "m.score")


def kept(phrases: DataFrame) -> DataFrame:
    """The candidates that do not stand within a longer one half of the time or more."""
    inner = F.explode(F.array(F.substring_index("key", " ", 2), F.substring_index("key", " ", -2)))
    longer = phrases.filter(F.col("words") == LONGEST).select(
        F.col("lang").alias("_lang"), inner.alias("_key"), F.col("a").alias("_a")).groupBy(
        "_lang", "_key").agg(F.max("_a").alias("_a"))
    found = phrases.join(longer, (F.col("lang") == F.col("_lang")) & (F.col("key") == F.col("_key")), "left")
    return found.filter((F.col("words") == LONGEST) | F.col("_a").isNull()
                        | (100 * F.col("_a") < INSIDE_PERCENT * F.col("a"))).drop("_lang", "_key", "_a")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each lang's first ``top`` phrases."""
    docs = docs.select("lang", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, (size // _BYTES_A_BIT).bit_length()))
    windows = written(window_counts(docs, frequent_pairs(docs, bits), bits), "windows")
    counts = written(marginalised(windows), "counts")
    phrases = written(scored(counts), "phrases")
    totals = counts.filter("words = 0").select(F.col("lang").alias("_lang"), F.col("n").alias("_total"))
    order = [F.desc("score"), F.desc("a"), "key"]

    def first_rows(rows: DataFrame, *by: str) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(
            F.col("rank") <= top)

    # The first of each part of a lang go on, so that no task orders all phrases of one.
    parts = kept(phrases).withColumn("_part", F.pmod(F.xxhash64("key"), F.lit(PARTS)))
    ranked = first_rows(first_rows(parts, "lang", "_part"), "lang")
    return ranked.join(totals, F.col("lang") == F.col("_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), F.col("key").alias("phrase"), "a", "l", "r",
        F.col("_total").alias("n"), "score")
