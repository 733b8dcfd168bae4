"""Embedding vectors of code by an encoder the user brings."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, FloatType

from codesift import fixed_values as fixed

Encoder = Callable[[list[str], int], np.ndarray]


def no_encoder() -> Encoder:
    """Zero vectors, for when there is no model."""
    return lambda texts, max_tokens: np.zeros((len(texts), fixed.EMBEDDING_SIZE), np.float32)


def with_embedding(df: DataFrame, code: str = "code",
                   make_encoder: Callable[[], Encoder] = no_encoder,
                   batch_size: int = 64) -> DataFrame:
    """Add ``embedding``, one float vector per row.

    ``make_encoder`` is called once per Python worker and gives a function from
    texts and a token limit to an array of one row per text (its first-token
    vectors).
    """

    def make_predict():
        encode = make_encoder()
        return lambda texts: np.asarray(
            encode([t or "" for t in texts], fixed.EMBEDDING_TOKENS), np.float32)

    embed = predict_batch_udf(make_predict, return_type=ArrayType(FloatType()),
                              batch_size=batch_size)
    return df.withColumn("embedding", embed(code))


def letter_encoder(letters: str, weights: DataFrame) -> Callable[[], Encoder]:
    """An encoder without a model: how often each letter comes, times its weight.

    ``weights`` has a row ``at, weight`` per letter. They travel as one file that Spark
    sends to every worker and that each opens once, as the weights of a real encoder would.
    """
    sc = weights.sparkSession.sparkContext
    name = f"weights-{uuid.uuid4().hex}.parquet"
    local = os.path.join(tempfile.mkdtemp(prefix="codesift-weights-"), name)
    pq.write_table(weights.orderBy("at").toArrow(), local)
    sc.addFile(local)

    def make() -> Encoder:
        factors = pq.read_table(SparkFiles.get(name)).column("weight").to_numpy()

        def encode(texts: list[str], max_tokens: int) -> np.ndarray:
            return np.array([[t.count(c) for c in letters] for t in texts], np.float32) * factors

        return encode

    return make
