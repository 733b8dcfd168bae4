"""Language identification with n-gram filters that answer for all languages at once.

Training counts the n-grams of the learning documents per language and keeps, for each
language, those that are frequent in it and not far more frequent in another. They go into
one Bloom filter per language, stored bit-sliced: slot ``i`` is a mask with a bit for each
language whose filter has bit ``i`` set, so one lookup per hash, and-ed, gives the mask of
all languages that hold the n-gram. A text is judged by the popcounts of its masks, one
per language: the share of its n-grams that a language holds, less what its filter answers
by mistake. The largest share names the language and is the score.

N-grams lie within a word, its ends marked by a blank; letters and marks in lower case
make words, all else parts them. Scripts that do not part words by blanks give pairs of
characters in place of longer n-grams.

How large a share is usual differs from language to language, and falls with the number of
different n-grams a language has. So a text counts as ``foreign`` only by what its own
language's learning texts show: if its score is under half of the score that all but one in
a hundred of these reach. What is too short to be judged so is not foreign.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is
every text if nothing could be learned; a text too short for an n-gram gets the language
with most learning documents and score 0; equal shares go to the language that sorts
first. Rows with a null doc_id are not learned from and not held out. Repeated rows count
as often as they come. An empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from codesift.session import written

UNKNOWN = "und"
GRAM = 4
SLOT_BITS = 20
HASHES = 3
# A kept n-gram makes up this share of its language's n-grams at least: so a language has
# at most 1 / LEAST_RATE of them, whatever the size of the corpus.
LEAST_RATE = 1e-5
# And its share is at least this part of its share in any other language.
LEAST_RATIO = 0.1
# A text with fewer n-grams is not called foreign.
LEAST_GRAMS = 30
# The part of a language's learning texts that may score below its floor, and the part of
# the floor under which a text is foreign.
FLOOR_QUANTILE = 0.01
FLOOR_SHARE = 0.5
# Scripts whose words are not parted by blanks: Thai, Lao, Tibetan, Myanmar, Khmer, kana,
# Han with its extensions.
UNPARTED = [(0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF),
            (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)]
# Characters that are joined to one run of text within a task, and those of it worked on at a
# time; a character takes some 100 bytes meanwhile.
_CHUNK = 2_000_000
_PIECE = 200_000
_BLANK = np.uint32(32)


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every code point: is it a letter, a letter or a mark, one of an unparted script."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    letter = np.array([k == "L" for k in kinds])
    inside = letter | np.array([k == "M" for k in kinds])
    unparted = np.zeros(0x110000, bool)
    for low, high in UNPARTED:
        unparted[low: high + 1] = True
    return letter, inside, unparted & inside


def grams(texts: list[str], go_on: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram keys of all texts, the text each comes from, and which texts have a letter.

    With ``go_on`` other texts stand before these: the first word begins with a blank too.
    """
    letter, inside, unparted = _letters()
    lowered = [t.lower() for t in texts]
    lengths = np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered))
    # Two blanks at the end, so that the last pair of characters begins a window too.
    codes = np.frombuffer((" " + " ".join(lowered) + "   ").encode("utf-32-le", "surrogatepass"),
                          np.uint32)
    of = np.repeat(np.arange(len(texts)), lengths)
    has = np.zeros(len(texts), bool)
    of = np.concatenate([[0], of, of[-1:], of[-1:]])
    has[of[letter[codes]]] = True
    blank = ~inside[codes]
    keep = ~blank
    keep[0] |= go_on
    keep[1:] |= ~blank[:-1]
    keep[-2:] = True
    codes = np.where(blank, _BLANK, codes)[keep]
    of = of[keep]
    single = unparted[codes]
    codes = codes.astype(np.uint64)
    n = len(codes) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), has
    words = codes != _BLANK
    good = np.ones(n, bool)
    key = np.zeros(n, np.uint64)
    for i in range(GRAM):
        key = (key << np.uint64(16)) ^ codes[i: i + n]
        if 0 < i < GRAM - 1:
            good &= words[i: i + n]
    # Pairs where the window begins in an unparted script; no window runs into one.
    pair = single[:n] & words[1: n + 1]
    key = np.where(single[:n], (codes[:n] << np.uint64(16)) ^ codes[1: n + 1], key)
    good = np.where(single[:n], pair, good & ~single[1: n + 1])
    return key[good], of[1: n + 1][good], has


def slots_of(keys: np.ndarray) -> list[np.ndarray]:
    """The slots of each key under each hash."""
    out = []
    for i in range(HASHES):
        x = (keys ^ np.uint64(i + 1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append((x >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
    return out


def _chunks(texts, size: int = _CHUNK):
    """Ranges of rows of about ``size`` characters."""
    low = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= size:
            yield low, i + 1
            low, total = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def _pieces(texts):
    """Ranges of rows of about ``_PIECE`` characters, and whether each goes on in a chunk."""
    for start, end in _chunks(texts):
        for low, high in _chunks(texts[start:end], _PIECE):
            yield start + low, start + high, low > 0


@dataclass(frozen=True)
class Filters:
    """The languages, their bit-sliced filters, their error rates, and the most common one.

    ``masks`` has a row per 64 languages and ``2 ** SLOT_BITS`` slots in each; ``floors``
    are the scores that nearly all learning texts of a language reach, 0 where not asked for.
    """

    languages: list[str]
    masks: np.ndarray
    errors: np.ndarray
    common: int
    floors: np.ndarray


def learn(docs: DataFrame) -> Filters:
    """Filters from the rows of ``text, lang``; rows without either teach nothing."""
    docs = docs.select("text", "lang").filter("text is not null and lang is not null")
    # As many rows as there are languages.
    counted = sorted((r[0], r[1]) for r in docs.groupBy("lang").count().collect())
    languages = [name for name, _ in counted]
    at = {name: i for i, name in enumerate(languages)}

    def count(batches):
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for low, high, go_on in _pieces(texts):
                keys, of, _ = grams(texts[low:high], go_on)
                which = np.array([at[x] for x in langs[low:high]], np.int64)[of]
                for i in np.unique(which):
                    key, n = np.unique(keys[which == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), i, np.int32)), pa.array(key.view(np.int64)),
                         pa.array(n.astype(np.int64))], ["language", "gram", "n"])

    counts = written(docs.mapInArrow(count, "language int, gram long, n long").groupBy(
        "gram", "language").agg(F.sum("n").alias("n")), "grams")
    per_gram = counts.groupBy("gram").agg(F.collect_list(F.struct("language", "n")).alias("n"))
    # At most one row per language again.
    totals = {r[0]: r[1] for r in counts.groupBy("language").agg(F.sum("n")).collect()}
    rate = F.create_map(*[F.lit(x) for i, t in totals.items() for x in (i, 1.0 / t)]) if totals else None
    words = len(languages) // 64 + 1
    masks = np.zeros((words, 2**SLOT_BITS), np.uint64)
    if totals:
        rates = per_gram.select("gram", F.transform("n", lambda x: F.struct(
            x["language"].alias("language"), (x["n"] * rate[x["language"]]).alias("rate"))).alias("r"))
        best = F.array_max(F.transform("r", lambda x: x["rate"]))
        kept = rates.select("gram", best.alias("best"), F.inline("r")).filter(
            (F.col("rate") >= LEAST_RATE) & (F.col("rate") >= LEAST_RATIO * F.col("best")))

        def place(batches):
            for batch in batches:
                keys = batch.column(0).to_numpy().view(np.uint64)
                for slot in slots_of(keys):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(1), pa.array(slot)], ["language", "slot"])

        placed = kept.select("gram", "language").mapInArrow(place, "language int, slot long")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("language") % 64)
        sliced = placed.groupBy((F.col("language") / 64).cast("int").alias("word"), "slot").agg(
            F.bit_or(bit).alias("mask")).toArrow()  # at most a row per slot and word
        masks[sliced["word"].to_numpy(), sliced["slot"].to_numpy()] = (
            sliced["mask"].to_numpy().view(np.uint64))
    errors = np.array([float((masks[i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean()) ** HASHES
                       for i in range(len(languages))])
    common = max(range(len(counted)), key=lambda i: (counted[i][1], -i)) if counted else -1
    return Filters(languages, masks, errors, common, np.zeros(len(languages)))


def judge(texts: list[str], filters: Filters, go_on: bool = False) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language and score of each text, and whether it is foreign."""
    keys, of, has = grams(texts, go_on)
    names, scores = np.full(len(texts), filters.common), np.zeros(len(texts))
    sizes = np.bincount(of, minlength=len(texts))
    if len(keys) and filters.languages:
        slots = slots_of(keys)
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        present, total = of[starts], np.diff(np.append(starts, len(of)))
        shares = np.empty((len(filters.languages), len(starts)))
        for word, masks in enumerate(filters.masks):
            found = masks[slots[0]]
            for slot in slots[1:]:
                found &= masks[slot]
            for bit in range(min(64, len(filters.languages) - 64 * word)):
                language = 64 * word + bit
                hits = np.add.reduceat((found >> np.uint64(bit)) & np.uint64(1), starts)
                wrong = filters.errors[language]
                shares[language] = (hits / total - wrong) / max(1 - wrong, 1e-9)
        best = shares.argmax(axis=0)
        names[present] = best
        scores[present] = np.clip(shares[best, np.arange(len(best))], 0.0, 1.0)
    known = has & (names >= 0)
    floors = filters.floors[names] if len(filters.floors) else np.zeros(len(texts))
    foreign = known & (sizes >= LEAST_GRAMS) & (scores < FLOOR_SHARE * floors)
    return ([filters.languages[n] if k else UNKNOWN for n, k in zip(names, known)],
            np.where(known, scores, 0.0), foreign)


def with_floors(docs: DataFrame, filters: Filters) -> Filters:
    """``filters`` with the floors that the learning rows ``docs`` show."""
    judged = predicted(docs.select("text", "lang").filter("text is not null and lang is not null"), filters)
    # One row per language; quantiles of a fixed accuracy.
    found = {r[0]: r[1] for r in judged.filter("lang = lang_pred and score > 0").groupBy("lang").agg(
        F.percentile_approx("score", FLOOR_QUANTILE, 10_000)).collect()}
    return replace(filters, floors=np.array([found.get(x, 0.0) for x in filters.languages]))


def predicted(docs: DataFrame, filters: Filters) -> DataFrame:
    """All rows of ``docs`` with ``lang_pred``, ``score`` and ``foreign``, from the text alone.

    Columns of these names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "foreign")
    # 8 bytes for each of 2 ** SLOT_BITS slots and 64 languages: 8 MB, whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        known = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            names, scores, odd = [], [np.empty(0)], [np.empty(0, bool)]
            for low, high, go_on in _pieces(texts):
                found, score, foreign = judge(texts[low:high], known, go_on)
                names += found
                scores.append(score)
                odd.append(foreign)
            yield batch.append_column("lang_pred", pa.array(names, pa.string())).append_column(
                "score", pa.array(np.concatenate(scores), pa.float64())).append_column(
                "foreign", pa.array(np.concatenate(odd), pa.bool_()))

    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()),
                         StructField("score", DoubleType()), StructField("foreign", BooleanType())])
    return docs.mapInArrow(run, schema)


def held_out(doc_id):
    """Whether a document is kept from learning: crc32 of its id, as text, leaves 2 mod 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identified(docs: DataFrame, floors: bool = False) -> DataFrame:
    """``docs`` with ``held_out, lang_pred, score, foreign``, learned from the rows not held out.

    Nothing is foreign without ``floors``, which take one more pass over the learning rows.
    """
    docs = docs.drop("held_out")
    learning = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    filters = learn(learning)
    if floors:
        filters = with_floors(learning, filters)
    return predicted(docs, filters).withColumn("held_out", held_out(F.col("doc_id")))
