"""Secrets found in texts, false findings removed by a random forest.

Candidates are runs of the characters that keys are made of, long and with a digit in them,
and what stands after a word such as ``token`` and a sign of assignment. Each is described
by its length, its character classes and how often they change, how much of it dictionary
words cover, the path it lies at, and the words beside it. A forest trained on labelled
findings tells secrets from the rest.

The fit looks at no more than about ``TRAINING_ROWS`` labelled findings, chosen by hash;
all candidates are scored.

Defined results: a null or empty text has no candidates; a null path is described as an
empty one; repeated rows give their candidates again; if the labels hold one class only,
all candidates get it; an empty table gives no rows. Only doc_id, text and the path column
are looked at.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift.session import without_summary, written

TRAINING_ROWS = 20_000
TREES = 40
DEPTH = 8
LEAST_LENGTH = 12
_NAMES = 32  # hash buckets of each neighbouring word
_PATHS = 16  # hash buckets of the path
_RUN = re.compile(r"[A-Za-z0-9+/_=\-]{%d,}" % LEAST_LENGTH)
# Words before an assignment that make its value a candidate.
_ASSIGNED = re.compile(
    r"(?i)(?:password|passwd|secret|token|api_?key|access_?key|private_?key|credential)s?"
    r"[\"']?\s{0,4}[:=]\s{0,4}[\"']?([^\s\"']{6,})")
_NUMBERS = ("length", "digits", "upper", "lower", "signs", "changes", "entropy", "covered",
            "quoted", "assigned")


@lru_cache(1)
def _dictionary(path: str) -> frozenset[str]:
    """Words of 3 letters or more in a tokenizer file with word ends."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    end = model["end_of_word_suffix"]
    words = (t[: -len(end)] for t in model["vocab"] if t.endswith(end))
    return frozenset(w for w in words if len(w) >= 3 and w.isascii() and w.isalpha())


def _kind(c: str) -> str:
    return "d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s"


def covered(value: str, words: frozenset[str], longest: int = 12) -> float:
    """The part of a value that dictionary words cover, the longest first from the left."""
    value, at, hit = value.lower(), 0, 0
    while at < len(value):
        for size in range(min(longest, len(value) - at), 2, -1):
            if value[at: at + size] in words:
                hit += size
                at += size
                break
        else:
            at += 1
    return hit / len(value)


def described(value: str, words: frozenset[str], before: str, after: str,
              path: str) -> tuple[list[float], list[int]]:
    """A candidate's ``_NUMBERS``, and the hash buckets of its neighbours and its path."""
    kinds = [_kind(c) for c in value]
    n = len(value)
    changes = sum(a != b for a, b in zip(kinds, kinds[1:])) / max(n - 1, 1)
    entropy = -sum(value.count(c) / n * math.log2(value.count(c) / n) for c in set(value))
    left = before.rstrip()
    quoted = before[-1:] in ("\"", "'") and after[:1] == before[-1:]
    assigned = left.rstrip("\"' ").endswith(("=", ":"))
    numbers = [float(n), *(kinds.count(k) / n for k in "duls"), changes, entropy,
               covered(value, words), float(quoted), float(assigned)]
    names = re.findall(r"[^\W\d_]+", before)[-2:]
    names = [""] * (2 - len(names)) + names + (re.findall(r"[^\W\d_]+", after)[:1] or [""])
    buckets = [i * _NAMES + zlib.crc32(name.lower().encode()) % _NAMES
               for i, name in enumerate(names) if name]
    return numbers, buckets + [len(names) * _NAMES + zlib.crc32(path.encode()) % _PATHS]


def _vector():
    """Numbers, then a 1 in each bucket."""
    return array_to_vector(F.concat("numbers", F.transform(
        F.sequence(F.lit(0), F.lit(3 * _NAMES + _PATHS - 1)),
        lambda i: F.array_contains(F.col("buckets"), i).cast("double"))))


def spans(text: str) -> list[tuple[int, int]]:
    """Where candidates lie in a text: each maximal one once, in order."""
    found = {m.span() for m in _RUN.finditer(text) if any(c.isdigit() for c in m.group())}
    found |= {m.span(1) for m in _ASSIGNED.finditer(text)}
    out: list[tuple[int, int]] = []
    for start, end in sorted(found, key=lambda s: (s[0], -s[1])):
        if not out or end > out[-1][1]:
            out.append((start, end))
    return out


def candidates(docs: DataFrame, dictionary: str, path: str) -> DataFrame:
    """``doc_id, start, length, value, before, numbers, buckets`` of all candidates.

    ``before`` holds up to 40 characters; ``dictionary`` is the path of a tokenizer file that
    is the same on all machines.
    """
    schema = ("doc_id long, start long, length long, value string, before string, "
              "numbers array<double>, buckets array<int>")

    def run(batches):
        words = _dictionary(dictionary)
        for batch in batches:
            out = []
            for doc_id, place, text in zip(*(c.to_pylist() for c in batch.columns)):
                for start, end in spans(text or ""):
                    value, before = text[start:end], text[max(start - 40, 0): start]
                    out.append((doc_id, start, end - start, value, before,
                                *described(value, words, before, text[end: end + 40], place or "")))
            columns = list(zip(*out)) or [[]] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                     pa.list_(pa.float64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "start", "length", "value", "before", "numbers", "buckets"])

    return docs.select(F.col("doc_id").cast("long"), F.col(path).cast("string").alias("path"),
                       "text").mapInArrow(run, schema)


def trained(labelled: DataFrame, rows: int = TRAINING_ROWS, trees: int = TREES,
            depth: int = DEPTH, seed: int = 7):
    """A forest over labelled candidates (``label`` 0.0 or 1.0); None if one class is all."""
    counts = {r[0]: r[1] for r in labelled.groupBy("label").count().collect()}
    if len(counts) < 2:
        return next(iter(counts), 0.0)
    # As many of each class as the other allows, within the bound.
    share = F.create_map(*[F.lit(x) for k, n in counts.items()
                           for x in (k, min(1.0, rows / 2 / n))])
    draw = F.pmod(F.xxhash64("doc_id", "start"), F.lit(2**30)) / F.lit(float(2**30))
    sample = labelled.filter(draw < share[F.col("label")]).select(
        "label", _vector().alias("features"))
    return without_summary(RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(written(sample, "sample")))


def scored(found: DataFrame, model) -> DataFrame:
    """``found`` with ``probability`` of being a secret, and ``is_secret``."""
    if isinstance(model, float):
        out = found.withColumn("probability", F.lit(model))
    else:
        rows = found.withColumn("_features", _vector())
        out = model.setFeaturesCol("_features").setPredictionCol("").setRawPredictionCol(
            "").setProbabilityCol("_p").transform(rows).withColumn(
            "probability", vector_to_array("_p")[1]).drop("_p", "_features")
    return out.withColumn("is_secret", F.col("probability") >= 0.5)


def format_label(value, before):
    """1.0 where a value has the form of a key and is assigned to a word for one.

    Stands in for labels where findings have none: a hexadecimal value of 32 digits or more,
    or one of 20 characters or more that mixes upper and lower case and digits.
    """
    form = value.rlike("^[0-9a-fA-F]{32,}$") | (
        (F.length(value) >= 20) & value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]"))
    named = before.rlike(r"(?i)(password|passwd|secret|token|key|credential)s?[\"']?\s*[:=]\s*[\"']?$")
    return (form & named).cast("double")
