"""The corpus pipeline over ``documents``: reject, clean, dedupe, mix and pack.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its rows are written
and read back as the ``docs`` of the next one. Columns that ``docs`` has besides those of
``documents`` go through all stages but the last, whatever their names.

Rows of an empty table give none at any stage. Nulls, ties and repeated rows have these
results: a document without a letter (a null text too) goes by its language; a null lang or
source teaches or makes up no language, and is a source of its own; a null doc_id is never
a copy of a line or text and stays; rows that repeat a doc_id stay or go together, but in
the line stage, which tells them apart; each row is drawn and packed for itself.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift.llm import langid, linededup, mixing, neardup, packing
from codesift.llm.common import table
from codesift.session import ship_package, written

_ROW = "_row"


def _packed(docs: DataFrame, *own: str) -> DataFrame:
    """The columns ``own``, and all others in one struct, safe from clashing names."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    return docs.select(*own, F.struct(*others, F.lit(0).alias("_")).alias(_ROW))


def _unpacked(rows: DataFrame, like: DataFrame, **own) -> DataFrame:
    return rows.select(*[(own[c] if c in own else F.col(_ROW)[c]).alias(c) for c in like.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or foreign to the language they are nearest to, go.

    Documents too short to tell stay, and so do languages of which no text scores high.
    """
    ship_package(spark)
    rows = langid.identified(_packed(docs, "doc_id", "text", "lang"), floors=True).filter(
        (F.col("lang_pred") != langid.UNKNOWN) & ~F.col("foreign"))
    return _unpacked(rows, docs, doc_id=F.col("doc_id"), text=F.col("text"), lang=F.col("lang"))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines met in an earlier document go, and documents of nothing else."""
    ship_package(spark)
    rows = linededup.without_recurring_lines(
        _packed(docs, "doc_id", "text"), rounds=None).filter("kept")
    text = F.col("clean_text")
    return _unpacked(rows, docs, doc_id=F.col("doc_id"), text=text, n_chars=F.length(text).cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    ship_package(spark)
    found = neardup.near_duplicates(docs.select("doc_id", "text"))
    gone = written(found.filter("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of small sources repeat until the mix is as even as the limits allow."""
    ship_package(spark)
    rows = mixing.drawn(_packed(docs, "doc_id", "text", "source"))
    return _unpacked(rows, docs, doc_id=F.col("doc_id"), text=F.col("text"), source=F.col("source"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences of 2048."""
    ship_package(spark)
    return packing.packed(docs.select("doc_id", "text"),
                          public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_recurring_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Tokenizers cannot be run in SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
