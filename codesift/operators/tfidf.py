"""TF-IDF over code tokens.

Weights follow the smooth form: idf = ln((1 + n) / (1 + df)) + 1, raw counts for
tf, rows scaled to length one. The vocabulary is the most frequent tokens.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift import fixed_values as fixed
from codesift.functions.text import tokens


def with_tokens(df: DataFrame, code: str = "code") -> DataFrame:
    return df.withColumn("tokens", tokens(F.col(code)))


def token_counts(df: DataFrame, column: str = "tokens") -> DataFrame:
    """Corpus frequency and document frequency per token, in one shuffle.

    Each document adds its tokens once with their place in the total and once,
    distinct, in the document count; both fold before the shuffle.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def marked(term, document):
        return lambda t: F.struct(t.alias("token"), term.alias("in_total"),
                                  document.alias("in_document"))

    entries = F.concat(
        F.transform(F.col(column), marked(one, none)),
        F.transform(F.array_distinct(column), marked(none, one)),
    )
    return df.select(F.inline(entries)).groupBy("token").agg(
        F.sum("in_total").alias("term_count"), F.sum("in_document").alias("doc_count")
    )


def top_tokens(counts: DataFrame, size: int = fixed.VOCABULARY_SIZE) -> DataFrame:
    """The most frequent tokens; the token itself breaks ties."""
    return counts.orderBy(F.desc("term_count"), "token").limit(size)


def vocabulary(df: DataFrame, column: str = "tokens",
               size: int = fixed.VOCABULARY_SIZE) -> DataFrame:
    """``token, term_count, doc_count, idf`` of the most frequent tokens."""
    documents = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    idf = F.log((documents + 1.0) / (F.col("doc_count") + 1.0)) + 1.0
    return top_tokens(token_counts(df, column), size).withColumn("idf", idf)


def fitted_tfidf(vocabulary_table: DataFrame, column: str = "tokens",
                 output: str = "tfidf") -> tuple[PipelineModel, list[str]]:
    """A transformer from tokens to a sparse TF-IDF vector, and its token order.

    The vocabulary is a bounded top-k table, so it becomes model state. Counting
    happens within each row: transforming shuffles nothing.
    """
    rows = sorted((r["token"], r["idf"]) for r in vocabulary_table.select("token", "idf").collect())
    words = [token for token, _ in rows]
    # An empty vocabulary is not accepted; a word no token can equal stands in.
    stages = [
        CountVectorizerModel.from_vocabulary(words or [" "], column, "_counts"),
        ElementwiseProduct(scalingVec=Vectors.dense([idf for _, idf in rows] or [0.0]),
                           inputCol="_counts", outputCol="_weights"),
        Normalizer(p=2.0, inputCol="_weights", outputCol=output),
    ]
    return PipelineModel(stages), words


def vector_entries(df: DataFrame, vector: str, keys: list[str]) -> DataFrame:
    """One row per stored entry of a sparse vector: ``index, value``."""
    parts = df.select(*keys, F.unwrap_udt(vector).alias("v"))
    return parts.select(
        *keys, F.inline(F.arrays_zip(F.col("v.indices").alias("index"),
                                     F.col("v.values").alias("value")))
    )


def _named_entries(df: DataFrame, vector: str, row_id: str, words: list[str]) -> DataFrame:
    """Stored entries with the token of each index."""
    names = F.array(*[F.lit(w) for w in words or [" "]])
    return vector_entries(df, vector, [row_id]).select(
        row_id, F.get(names, F.col("index")).alias("token"), "value")


def tfidf_rows(df: DataFrame, row_id: str, column: str = "tokens",
               size: int = fixed.VOCABULARY_SIZE) -> DataFrame:
    """Fit and transform: ``row_id, token, tfidf`` for every nonzero weight."""
    model, words = fitted_tfidf(vocabulary(df, column, size), column)
    vectors = model.transform(df.select(row_id, column)).select(row_id, "tfidf")
    return _named_entries(vectors, "tfidf", row_id, words).select(
        row_id, "token", F.col("value").alias("tfidf"))


def known_tokens(df: DataFrame, row_id: str, vocabulary_table: DataFrame,
                 column: str = "tokens") -> DataFrame:
    """Token lookup: ``row_id, token, n``; tokens outside the vocabulary drop.

    Counted within each row, so there is no join and no shuffle.
    """
    model, words = fitted_tfidf(vocabulary_table, column)
    counted = model.stages[0].transform(df.select(row_id, column)).select(row_id, "_counts")
    return _named_entries(counted, "_counts", row_id, words).select(
        row_id, "token", F.col("value").cast("long").alias("n"))
