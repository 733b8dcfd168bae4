"""Quality rules per document, and verdicts on whole hosts from their failure rates.

Every document is measured and held against a few rules. For each rule, the failures of a
host's documents are counted, and its failure rate is shrunk towards that of all hosts: the
hosts' rates are taken as drawn from a beta distribution whose mean is the overall rate and
whose strength follows from how much rates differ beyond chance (moments of the
beta-binomial). A host of few documents so stays near the mean, one of many near its own
rate. A host whose shrunk rate reaches ``HOST_LIMIT`` under some rule is rejected with all
its documents; a document that fails a base rule is rejected in any case.

Defined results: a null or empty text has no words and fails as too short; a null host is a
host of its own; repeated rows count each; an empty table gives no rows. Only doc_id, text
and the host column are looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift.llm.hashing import window_hashes, word_hashes
from codesift.session import written

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
WINDOW = 3
HOST_LIMIT = 0.5
# Below this correlation hosts differ no more than by chance; the prior is then this strong.
LEAST_CORRELATION = 1e-6



def rules() -> dict:
    """Each rule as a column that is true where a document fails; the first two are base."""
    return {
        "short": F.col("n_words") < LEAST_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "copied_lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
    }


def repeat_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """How many words lie in a window of words that occurs twice or more."""
    key = window_hashes(hashes, window)
    _, of, many = np.unique(key, return_inverse=True, return_counts=True)
    covered = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(many[of] > 1)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def measured(docs: DataFrame, host: str) -> DataFrame:
    """``doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    schema = "doc_id long, host string, " + ", ".join(f"{n} long" for n in names)

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(2):
                raw = text.as_py() or b""
                words = raw.split()
                lines = [line for line in raw.split(b"\n") if line.split()]
                chars = len(b"".join(words).decode())
                out.append((len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS.encode())),
                            len(lines), len(lines) - len(set(lines)), repeat_words(word_hashes(words))))
            columns = np.array(out, np.int64).reshape(-1, len(names)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, columns)],
                ["doc_id", "host", *names])

    return docs.select(F.col("doc_id").cast("long"), F.col(host).cast("string").alias("host"),
                       F.col("text").cast("binary")).mapInArrow(run, schema)


def prior(hosts: DataFrame, failed: str) -> tuple[float, float]:
    """Alpha and beta of the hosts' failure rates, from ``docs`` and a failure count."""
    rate = F.col(failed) / F.col("docs")
    total, fails, n, squares = hosts.agg(
        F.sum("docs"), F.sum(failed), F.count("*"),
        F.sum(F.col("docs").cast("double") * F.col("docs"))).first()
    mean = (fails or 0) / (total or 1)
    chance = mean * (1 - mean)
    correlation = LEAST_CORRELATION
    if n > 1 and chance > 0:
        spread = hosts.agg(F.sum(F.col("docs") * F.pow(rate - F.lit(mean), F.lit(2)))).first()[0]
        room = chance * (total - squares / total - (n - 1))
        if room > 0:
            correlation = min(max((spread - chance * (n - 1)) / room, LEAST_CORRELATION), 1.0)
    strength = 1 / correlation - 1
    return mean * strength, (1 - mean) * strength


def host_verdicts(found: DataFrame) -> DataFrame:
    """``host, docs``, per rule its failures and shrunk rate, and ``rejected``."""
    checks = rules()
    hosts = written(found.groupBy("host").agg(
        F.count("*").alias("docs"),
        *[F.count_if(check).alias(name) for name, check in checks.items()]), "hosts")
    out = hosts
    for name in checks:
        alpha, beta = prior(hosts, name)
        out = out.withColumn(f"{name}_rate", (F.col(name) + F.lit(alpha))
                             / (F.col("docs") + F.lit(alpha) + F.lit(beta)))
    return out.withColumn("rejected", F.greatest(*[F.col(f"{n}_rate") for n in checks]) >= HOST_LIMIT)


def judged(docs: DataFrame, host: str) -> DataFrame:
    """Measures of each document, ``base_failed``, its host's failures, and ``kept``."""
    found = written(measured(docs, host), "measured")
    hosts = written(host_verdicts(found), "verdicts").withColumnRenamed("host", "_host")
    short, repeats = list(rules().values())[:2]
    return found.withColumn("base_failed", short | repeats).join(
        hosts, F.col("host").eqNullSafe(F.col("_host")), "left").withColumn(
        "kept", ~F.col("base_failed") & ~F.col("rejected")).drop("_host")
