"""Exact ranks, samples and splits in hash order, without a global sort.

Rows are ordered by a key that starts with evenly spread hex digits, so the first
digits cut the order into buckets of about equal size. Counts per bucket say how
many rows come before each bucket, and only rows of one bucket ever have to be
ordered together. The key holds the row id, so copies of a row never tie.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesift import fixed_values as fixed

# Four hex digits: at most 65,536 buckets, which bounds the bucket tables.
BUCKET_DIGITS = 4


def hash_key(row_id: Column, seed: int = fixed.SEED) -> Column:
    """A text key in random order; equal only for equal ids."""
    text_id = row_id.cast("string")
    return F.concat(F.md5(F.concat(F.lit(f"{seed}:"), text_id)), F.lit(":"), text_id)


def _bucket(key: Column) -> Column:
    return F.substring(key, 1, BUCKET_DIGITS)


def key_cutoff(df: DataFrame, key: Column, counted: Column,
               how_many: Callable[[Column, Column], Column]) -> Column:
    """The key of the k-th counted row, as a scalar subquery.

    ``how_many(counted rows, all rows)`` gives k, and all counted rows are within
    the cutoff if k is at least their number. The cutoff is null if k is zero.
    """
    keyed = df.select(
        key.alias("_key"), F.coalesce(counted, F.lit(False)).alias("_counted"),
        _bucket(key).alias("_bucket"),
    )
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = keyed.groupBy("_bucket").agg(
        F.count_if("_counted").alias("_n"), F.count(F.lit(1)).alias("_rows")
    )
    k = F.least(
        how_many(F.sum("_n").over(everything), F.sum("_rows").over(everything)).cast("long"),
        F.sum("_n").over(everything),
    )
    edge = (
        buckets.select("_bucket", "_n", (F.sum("_n").over(so_far) - F.col("_n")).alias("_before"),
                       k.alias("_k"))
        .filter((F.col("_before") < F.col("_k")) & (F.col("_k") <= F.col("_before") + F.col("_n")))
        .drop("_n")
    )
    # One bucket, so one row to broadcast and one bucket to order.
    ordered = Window.partitionBy("_bucket").orderBy("_key")
    return (
        keyed.filter("_counted")
        .join(F.broadcast(edge), "_bucket")
        .withColumn("_rank", F.row_number().over(ordered))
        .filter(F.col("_rank") == F.col("_k") - F.col("_before"))
        .select("_key")
        .scalar()
    )


def sample_exactly(df: DataFrame, row_id: str, how_many: Callable[[Column, Column], Column],
                   among: Column | None = None, seed: int = fixed.SEED) -> DataFrame:
    """Keep exactly k of the rows ``among`` selects, and all other rows."""
    key = hash_key(F.col(row_id), seed)
    counted = F.lit(True) if among is None else among
    cutoff = key_cutoff(df, key, counted, how_many)
    return df.filter(~F.coalesce(counted, F.lit(False)) | (key <= cutoff))


def with_test_flag(df: DataFrame, row_id: str, fraction: float = fixed.TEST_FRACTION,
                   seed: int = fixed.SEED) -> DataFrame:
    """Mark exactly ceil(fraction * rows) rows as ``is_test``."""
    key = hash_key(F.col(row_id), seed)
    cutoff = key_cutoff(df, key, F.lit(True), lambda n, _: F.ceil(n * F.lit(fraction)))
    return df.withColumn("is_test", F.coalesce(key <= cutoff, F.lit(False)))


def train_test_split(df: DataFrame, row_id: str, fraction: float = fixed.TEST_FRACTION,
                     seed: int = fixed.SEED) -> tuple[DataFrame, DataFrame]:
    flagged = with_test_flag(df, row_id, fraction, seed)
    return (flagged.filter(~F.col("is_test")).drop("is_test"),
            flagged.filter("is_test").drop("is_test"))


def with_rank(df: DataFrame, row_id: str, by: list[str] | None = None, name: str = "rank",
              seed: int = fixed.SEED) -> DataFrame:
    """Rank of every row in hash order, counted from 1 within ``by``.

    The rank is the place within the bucket plus the rows of earlier buckets.
    """
    by = by or []
    keyed = df.withColumn("_key", hash_key(F.col(row_id), seed)).withColumn(
        "_bucket", _bucket(F.col("_key"))
    )
    in_order = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        keyed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .select(*by, "_bucket", F.coalesce(F.sum("_n").over(in_order), F.lit(0)).alias("_before"))
    )
    place = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy("_key"))
    return (
        keyed.withColumn("_place", place)
        .join(before, [*by, "_bucket"])
        .withColumn(name, F.col("_before") + F.col("_place"))
        .drop("_key", "_bucket", "_place", "_before")
    )


def with_folds(df: DataFrame, row_id: str, label: str, folds: int = fixed.FOLDS,
               seed: int = fixed.SEED) -> DataFrame:
    """Add ``fold``: per class, sizes differ by one row at most."""
    ranked = with_rank(df, row_id, [label], "_fold_rank", seed)
    return ranked.withColumn("fold", ((F.col("_fold_rank") - 1) % folds).cast("int")).drop(
        "_fold_rank"
    )


def learning_curve_rows(df: DataFrame, row_id: str, folds: int = fixed.FOLDS,
                        seed: int = fixed.SEED) -> DataFrame:
    """Training rows of every fold with their rank: ``test_fold`` and ``train_rank``.

    A row trains every fold but its own, so there are folds - 1 rows for each;
    give it narrow rows.
    """
    others = F.array(*[F.lit(f) for f in range(folds)])
    copies = df.withColumn("test_fold", F.explode(others)).filter(
        F.col("test_fold") != F.col("fold")
    )
    return with_rank(copies, row_id, ["test_fold"], "train_rank", seed)


def learning_curve_steps(folded: DataFrame, row_id: str, folds: int = fixed.FOLDS,
                         fractions=fixed.LEARNING_CURVE_FRACTIONS,
                         seed: int = fixed.SEED) -> DataFrame:
    """``test_fold, step, train_size, cutoff``: one row per fold and fraction.

    Step rows of a fold are those of other folds with a hash key up to the cutoff,
    so wide training rows are filtered where they are and never copied. Sizes are
    shares of the smallest training set.
    """
    ranked = learning_curve_rows(folded.select(row_id, "fold"), row_id, folds, seed)
    per_fold = folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    smallest = per_fold.agg((F.sum("n") - F.max("n")).alias("n")).scalar()
    steps = F.explode(F.array(*[
        F.struct(F.lit(i).alias("step"), F.floor(F.lit(f) * smallest).alias("train_size"))
        for i, f in enumerate(fractions)]))
    return (
        ranked.withColumn("s", steps).filter(F.col("train_rank") == F.col("s.train_size"))
        .select("test_fold", "s.step", "s.train_size",
                hash_key(F.col(row_id), seed).alias("cutoff"))
    )


def shuffled(df: DataFrame, row_id: str, seed: int = fixed.SEED) -> DataFrame:
    """All rows in hash order (a range-partitioned sort)."""
    return df.orderBy(hash_key(F.col(row_id), seed))
