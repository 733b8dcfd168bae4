"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift.llm import collocations, langid, licenses, linededup, merkle, mixing, neardup, packing, quality, rollups, secrets, sharding, syncmers
from codesift.llm.common import table
from codesift.session import new_path, ship_package, written


def _shipped(query):
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return query(spark, folder)

    return run


def op1_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Token totals after loading all documents, deleting copies, revising the counts of
    texts that repeat lines, adding a second tokenizer, and one batch coming twice."""
    docs = written(rollups.counted(table(spark, folder, "documents")), "counted")
    totals = rollups.TokenTotals(spark, new_path(spark, "totals"))
    totals.commit("load", rollups.change("insert", docs, "words-1", F.col("all_words")))
    # Written, so that the join reads both sides straight from a shuffle and can split a text
    # that many rows share.
    firsts = written(docs.groupBy(F.col("digest").alias("_digest")).agg(
        F.min("doc_id").alias("_first")), "firsts")
    known = written(docs.join(firsts, F.col("digest") == F.col("_digest"), "left").withColumn(
        "copy", F.coalesce(F.col("_first") < F.col("doc_id"), F.lit(False))), "known")
    copies, rest = known.filter("copy"), known.filter("not copy")
    deletes = rollups.change("delete", copies, "words-1", F.col("all_words"))
    totals.commit("copies", deletes)
    totals.commit("lines", rollups.change(
        "revise", rest.filter("words <> all_words"), "words-1", F.col("words"), F.col("all_words")))
    totals.compact()
    totals.commit("copies", deletes)
    totals.commit("second", rollups.change("insert", rest, "words-2", F.col("parts")))
    return totals.totals()


def op4_secret_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate secret of the documents, and whether the forest keeps it."""
    found = written(secrets.candidates(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"),
        "source"), "candidates")
    model = secrets.trained(found.withColumn("label", secrets.format_label(
        F.col("value"), F.col("before"))))
    return secrets.scored(found, model).select(
        "doc_id", "start", "length", F.sha2("value", 256).alias("value_sha256"),
        "probability", "is_secret")


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in one of 8 shards of near equal bytes, equal texts together."""
    return sharding.sharded(table(spark, folder, "documents"))


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Closed-syncmer fingerprints of every document, its edit, and their likeness."""
    return syncmers.fingerprints(table(spark, folder, "documents"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return langid.identified(docs).select("doc_id", "held_out", "lang_pred", "score")


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as often as it is drawn, with its epoch, block and the block's turn."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    drawn = written(mixing.drawn(docs).drop("text"), "drawn")
    return mixing.in_turn(drawn).select("doc_id", "source", "n_tokens", "epoch", "block", "turn")


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's token ids, placed in sequences of 2048."""
    return packing.packed(table(spark, folder, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every document, how many recur elsewhere, and the digest of what is left."""
    # As many templates as the lines of a leaf need.
    out = linededup.without_recurring_lines(table(spark, folder, "documents"), rounds=None)
    return out.select("doc_id", "n_lines", "n_dropped", "kept",
                      F.sha2("clean_text", 256).alias("clean_sha256"))


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Component of near-duplicates of every document."""
    return neardup.near_duplicates(table(spark, folder, "documents"))


def op10_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rule measures of every document, and whether it and its source pass."""
    found = quality.judged(table(spark, folder, "documents"), "source")
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept",
                        F.col("docs").alias("host_docs"), F.col("short").alias("host_short"),
                        F.col("repeats").alias("host_repeats"))


def op11_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    return licenses.licensed(table(spark, folder, "documents"))


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf, proof and what its possibly tampered text folds to."""
    docs = table(spark, folder, "documents")
    return merkle.manifest(docs, merkle.without_breaks(docs))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of two and three words of every language."""
    return collocations.collocations(table(spark, folder, "documents"))


QUERIES = {q.__name__: _shipped(q) for q in (
    op1_token_rollup, op2_sharding, op3_fingerprints, op4_secret_forest, op5_language_id, op6_mixing,
    op7_packing, op8_line_dedup, op9_near_duplicates, op10_host_rules, op11_licenses, op12_merkle, op13_collocations)}
