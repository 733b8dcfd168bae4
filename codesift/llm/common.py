"""What several of the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codesift.session import written

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


# Slots of the filter that ``may_be_in`` sends to all tasks: 2 MB, whatever the tables.
FILTER_SLOTS = 2**24


def may_be_in(df: DataFrame, key: Column, keys: DataFrame, flag: str) -> DataFrame:
    """Add the boolean ``flag``: false only where ``key`` is not among ``keys``, a table of one
    column.

    Hashes of the keys set bits that tasks look up, so that rows that no join can need are left
    out before its shuffle. Other keys may share a bit: a join still has to tell them apart.
    """
    def slot(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(FILTER_SLOTS)) + 1

    given = keys.select(slot(F.col(keys.columns[0])).alias("_slot")).select(
        F.bitmap_bucket_number("_slot").alias("_bucket"), F.bitmap_bit_position("_slot").alias("_bit"))
    # Dealt before they are folded: a half-filled map of a task is larger than its keys.
    bits = given.repartition("_bucket").groupBy("_bucket").agg(
        F.bitmap_construct_agg("_bit").alias("_bits"))
    at = F.bitmap_bit_position(slot(key))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    found = df.join(F.broadcast(bits), F.bitmap_bucket_number(slot(key)) == F.col("_bucket"), "left")
    return found.withColumn(flag, F.coalesce(F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1, F.lit(False))).drop(
        "_bucket", "_bits")


def blocks_for(rows: int) -> int:
    """How many hash blocks a group's rows are dealt over: 64, and one more per million rows."""
    return 64 + rows // 2**20


def with_rank(df: DataFrame, groups: list[str], order: list[str], rank: str,
              blocks: int) -> DataFrame:
    """Add a gapless rank from 0 within each group, in two levels.

    Rows are dealt over hash blocks of a group, numbered there, and shifted by the rows of
    the blocks before. So no task holds a whole group. ``df`` is read twice: pass one that
    is written. Rows equal in ``order`` may stand either way round.
    """
    dealt = df.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    before = Window.partitionBy(*groups).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*groups, "_block").agg(F.count("*").alias("_n")).select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_block").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*groups, "_block").orderBy(*order)
    numbered = dealt.withColumn("_row", F.row_number().over(within))
    on = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    same = F.col("_block") == F.col("_b")
    for condition in on:
        same = same & condition
    return numbered.join(starts, same).withColumn(
        rank, (F.col("_start") + F.col("_row") - 1).cast("long")).drop(
        "_block", "_b", "_row", "_start", *[f"_g{i}" for i in range(len(groups))])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected edges ``(a, b)``: rows ``(id, component)``.

    The component is the smallest id in it. Large-star and small-star steps take turns
    until nothing changes (Kiveris et al., 2014); every step is written to the shared
    folder, so lineage stays short and a lost executor repeats one step at most. Nothing
    but two sums per step reaches the driver; they are taken from what was written, since a
    session that has observed a table cannot send tasks a model with the summary of its fit.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a <> b").distinct(), name)
    seen = None
    while True:
        both = edges.select(F.inline(F.array(
            F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        lowest = both.groupBy("a").agg(F.min("b").alias("_m")).select(
            F.col("a").alias("_a"), F.least("a", "_m").alias("_m"))
        # Edges that come twice go in the other step.
        large = both.join(lowest, F.col("a") == F.col("_a")).filter("b > a").select(
            F.col("b").alias("a"), F.col("_m").alias("b"))
        large = written(large, name)
        lowest = large.groupBy("a").agg(F.min("b").alias("_m")).withColumnRenamed("a", "_a")
        small = large.join(lowest, F.col("a") == F.col("_a")).select(F.inline(F.array(
            F.struct(F.col("b").alias("a"), F.col("_m").alias("b")),
            F.struct("a", F.col("_m").alias("b")))))
        edges = written(small.filter("a <> b").distinct(), name)
        state = edges.agg(F.count("*").alias("n"),
                          F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if state == seen:
            return edges.groupBy("a").agg(F.min("b").alias("component")).select(
                F.col("a").alias("id"), "component").union(
                edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        seen = state


def with_more_edges(label: DataFrame, edges: DataFrame, name: str = "components") -> DataFrame:
    """The components ``(id, component)`` once ``edges`` join some of them.

    Works on the edges between components alone; without any, ``label`` stays as it is.
    """
    for end in ("a", "b"):
        known = label.select(F.col("id").alias("_id"), F.col("component").alias("_c"))
        edges = edges.join(known, F.col(end) == F.col("_id"), "left").withColumn(
            end, F.coalesce("_c", end)).drop("_id", "_c")
    edges = written(edges.select("a", "b").filter("a <> b"), name)
    if edges.isEmpty():
        return label
    moved = written(components(edges, name), name).select(
        F.col("id").alias("_from"), F.col("component").alias("_to"))
    old = label.join(moved, F.col("component") == F.col("_from"), "left").select(
        "id", F.coalesce("_to", "component").alias("component"))
    new = moved.join(label, F.col("_from") == F.col("id"), "left_anti").select(
        F.col("_from").alias("id"), F.col("_to").alias("component"))
    return written(old.union(new), name)
