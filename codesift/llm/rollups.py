"""Token totals by source, language and tokenizer version, kept up by signed batches.

A change inserts a document's count, deletes it, or revises it. Each becomes a signed
amount, so totals are plain sums: changes are added up within a batch, and a batch holds one
row per group it touches. A batch is a folder that counts once its ``_SUCCESS`` marker is
there, the last thing a Spark write leaves. Committing a batch again is no work and no
change; one that was broken off is written anew. ``compact`` folds committed batches into
one snapshot that remembers their names, so a batch that comes again later is still known.
One writer at a time commits to a folder; a batch name stands for one set of changes.

Defined results: a null source, language or tokenizer is a group of its own; a null count
is 0; changes equal in all columns are one change; a null or unknown kind of change is none;
groups whose documents and tokens both come to 0 are left out; no changes commit an empty
batch; a table without batches gives no rows. Other columns of the changes are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift.llm.common import WORD

GROUP = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"
#: What a token is, by tokenizer version.
TOKENIZERS = {
    "words-1": WORD,
    "words-2": r"[\p{L}\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]",
}


def token_count(text: Column, tokenizer: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKENIZERS[tokenizer])), F.lit(0)).cast("long")


def change(kind: str, rows: DataFrame, tokenizer: str, tokens: Column,
           old_tokens: Column | None = None) -> DataFrame:
    """Changes of one kind from rows of ``doc_id, source, lang``."""
    old = old_tokens if old_tokens is not None else F.lit(None).cast("long")
    return rows.select(F.lit(kind).alias("kind"), "doc_id", "source", "lang",
                       F.lit(tokenizer).alias("tokenizer"), tokens.alias("n_tokens"),
                       old.alias("old_tokens"))


def signed(changes: DataFrame) -> DataFrame:
    """One row per group that the changes touch, with signed ``documents`` and ``tokens``."""
    changes = changes.select("kind", "doc_id", *GROUP, "n_tokens", "old_tokens").distinct()
    new, old = (F.coalesce(c, F.lit(0)) for c in ("n_tokens", "old_tokens"))
    kind = F.col("kind")
    documents = F.when(kind == "insert", 1).when(kind == "delete", -1).otherwise(0)
    tokens = F.when(kind == "insert", new).when(kind == "delete", -new).when(
        kind == "revise", new - old).otherwise(0)
    return changes.groupBy(*GROUP).agg(F.sum(documents).cast("long").alias("documents"),
                                       F.sum(tokens).cast("long").alias("tokens"))


class TokenTotals:
    """Totals kept below a folder that all machines reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self._folder).getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration())

    def _committed(self, kind: str) -> list[str]:
        """Names of the folders of a kind that were written to the end."""
        root = self._path(f"{self._folder}/{kind}")
        if not self._files.exists(root):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(root)]
        return sorted(n for n in names if self._files.exists(
            self._path(f"{self._folder}/{kind}/{n}/_SUCCESS")))

    def _snapshot(self) -> tuple[str | None, set[str]]:
        """The newest snapshot, and the batches that are in it."""
        # A snapshot counts once its list of batches, written last, is there.
        names = self._committed("snapshots/lists")
        if not names:
            return None, set()
        listed = self._spark.read.schema("batch string").parquet(
            f"{self._folder}/snapshots/lists/{names[-1]}")
        return names[-1], {r[0] for r in listed.collect()}

    def batches(self) -> list[str]:
        """Names of all committed batches."""
        return sorted(self._snapshot()[1] | set(self._committed("batches")))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False, and no work, if it was committed before."""
        if not re.fullmatch(r"[A-Za-z0-9-]+", batch):
            raise ValueError("batch names are of letters, digits and dashes")
        if batch in self.batches():
            return False
        signed(changes).write.mode("overwrite").parquet(f"{self._folder}/batches/{batch}")
        return True

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens``."""
        snapshot, inside = self._snapshot()
        folders = [f"{self._folder}/batches/{b}" for b in self._committed("batches")
                   if b not in inside]
        if snapshot:
            folders.append(f"{self._folder}/snapshots/totals/{snapshot}")
        if not folders:
            return self._spark.createDataFrame([], SCHEMA)
        return self._spark.read.schema(SCHEMA).parquet(*folders).groupBy(*GROUP).agg(
            F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).filter(
            "documents <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Fold all committed batches into one snapshot."""
        names, last = self.batches(), self._snapshot()[0]
        name = f"{int(last or 0) + 1:08d}"
        self.totals().write.mode("overwrite").parquet(f"{self._folder}/snapshots/totals/{name}")
        self._spark.createDataFrame([(n,) for n in names], "batch string").write.mode(
            "overwrite").parquet(f"{self._folder}/snapshots/lists/{name}")


def counted(docs: DataFrame) -> DataFrame:
    """``doc_id, source, lang, digest`` and the counts of each document.

    ``all_words`` is of the whole text, ``words`` and ``parts`` of its distinct lines, by the
    first and the second tokenizer.
    """
    lines = F.array_join(F.array_distinct(F.split("text", "\n")), "\n")
    return docs.select(
        "doc_id", "source", "lang", F.sha2(F.col("text"), 256).alias("digest"),
        token_count(F.col("text"), "words-1").alias("all_words"), lines.alias("_lines")).select(
        "doc_id", "source", "lang", "digest", "all_words",
        token_count(F.col("_lines"), "words-1").alias("words"),
        token_count(F.col("_lines"), "words-2").alias("parts"))
