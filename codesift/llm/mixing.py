"""Sources mixed by temperature, drawn as budgeted permutations of blocks.

A source's weight is its token share raised to an exponent, made to add up to one. The
exponent is the flattest (smallest) one in [0, 1] at which the mix's entropy does not pass a
target and no source is repeated more often than a limit; it is found by bisection, each
step an aggregate over the sources. The token budget is such that the largest source is
drawn exactly once; so every document is drawn at least once and small sources repeat. A
budget in tokens may be given instead; then large sources are drawn in part.

A source's documents are dealt over blocks by hash. An epoch goes through the blocks in an
order of its own; whole epochs come first, then the blocks of one more epoch until the
budget is used up, the last block cut where the next document would pass it.

Defined results: a null source is a source of its own; a null or empty text has no tokens,
and a source without any is drawn once; documents that tie in a block's order are taken
together or not at all; repeated rows are drawn each by itself; an empty table gives no
rows. Columns named ``epoch``, ``block`` or ``n_tokens`` are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codesift.llm.common import WORD, blocks_for
from codesift.session import written

# The entropy may rise by this part of the way from the natural mix to an even one.
LIFT = 0.5
MAX_REPEATS = 2.0
SEED = 17
_STEPS, _WIDTH = 7, 32


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_totals(sized: DataFrame) -> DataFrame:
    """``source, docs, tokens`` from rows of ``source, n_tokens``."""
    return sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"))


def exponent(totals: DataFrame, lift: float = LIFT, max_repeats: float = MAX_REPEATS,
             budget: float | None = None) -> tuple[float, float, float]:
    """The exponent, the sum of powers that makes weights of it, and the token budget."""
    some = totals.filter("tokens > 0")
    total, sources, most, least = some.agg(
        F.sum("tokens"), F.count("*"), F.max("tokens"), F.min("tokens")).first()
    if not sources:
        return 1.0, 1.0, 0.0
    share = F.col("tokens") / F.lit(float(total))

    def sums(exponents):
        row = some.agg(*[f for a in exponents for f in (
            F.sum(F.pow(share, F.lit(a))), F.sum(F.pow(share, F.lit(a)) * F.log(share)))]).first()
        return [(row[2 * i], row[2 * i + 1]) for i in range(len(exponents))]

    def entropy(a, powers, logs):
        return math.log(powers) - a * logs / powers

    def budget_of(a, powers):
        # Without a budget the largest source is drawn once.
        return budget if budget is not None else total * powers * (most / total) ** (1 - a)

    natural = entropy(1.0, *sums([1.0])[0])
    target = natural + lift * (math.log(sources) - natural) + 1e-12

    def fits(a, powers, logs):
        repeats = budget_of(a, powers) / total * (least / total) ** (a - 1) / powers
        return entropy(a, powers, logs) <= target and repeats <= max_repeats + 1e-12

    low, high = 0.0, 1.0
    for _ in range(_STEPS):
        tried = [low + (high - low) * i / _WIDTH for i in range(_WIDTH + 1)]
        first = next((i for i, (a, s) in enumerate(zip(tried, sums(tried))) if fits(a, *s)), _WIDTH)
        if first == 0:
            high = tried[0]
            break
        low, high = tried[first - 1], tried[first]
    powers = sums([high])[0][0]
    return high, powers, budget_of(high, powers)


def _block_key(epoch):
    return F.xxhash64(F.lit(SEED), "source", epoch, "block")


def _doc_key(epoch):
    return F.xxhash64(F.lit(SEED + 1), epoch, "doc_id")


def rules(sized: DataFrame, lift: float = LIFT, max_repeats: float = MAX_REPEATS,
          budget: float | None = None) -> DataFrame:
    """One row per source: ``weight, budget, full, cut_block, cut_doc``.

    ``full`` whole epochs, then blocks below ``cut_block`` in the order of the epoch after
    them, then documents up to ``cut_doc`` of the block at ``cut_block``.
    """
    totals = written(source_totals(sized), "totals")
    alpha, powers, whole = exponent(totals, lift, max_repeats, budget)
    total = totals.agg(F.sum("tokens")).first()[0] or 1
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total)), F.lit(alpha))
                    / F.lit(powers)).otherwise(F.lit(0.0))
    plan = totals.withColumn("weight", weight).withColumn(
        "budget", F.when(F.col("tokens") > 0, F.round(F.col("weight") * F.lit(whole)).cast("long"))
        .otherwise(F.lit(0))).withColumn(
        "full", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens")))
        .otherwise(F.lit(1)).cast("int")).withColumn(
        "rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("full") * F.col("tokens"))
        .otherwise(F.lit(0)))
    plan = written(plan, "plan")
    named = plan.select(F.col("source").alias("_source"), "full", "rest")
    blocks = sized.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")).join(
        named, F.col("source").eqNullSafe(F.col("_source")))
    # As many rows in a source's window as it has blocks.
    turn = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    cut = blocks.withColumn("key", _block_key(F.col("full"))).withColumn(
        "upto", F.sum("tokens").over(turn)).filter("upto > rest").groupBy("source").agg(
        F.min(F.struct("key", "block", (F.col("upto") - F.col("tokens")).alias("before"))).alias("c"))
    cut = written(cut.select(F.col("source").alias("_source"), "c.*"), "cuts")
    edge = sized.join(cut, F.col("source").eqNullSafe(F.col("_source"))
                      & (sized["block"] == cut["block"])).select(
        "source", sized["doc_id"], "n_tokens", "before")
    edge = edge.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    order = Window.partitionBy("source").orderBy("doc_key")
    last = edge.withColumn("doc_key", _doc_key(F.col("full"))).withColumn(
        "upto", F.col("before") + F.sum("n_tokens").over(order)).filter("upto <= rest").groupBy(
        F.col("source").alias("_last")).agg(F.max("doc_key").alias("cut_doc"))
    joined = plan.join(cut.select("_source", F.col("key").alias("cut_block")),
                       F.col("source").eqNullSafe(F.col("_source")), "left").join(
        last, F.col("source").eqNullSafe(F.col("_last")), "left")
    return joined.select("source", "docs", "tokens", "weight", "budget", "full", "cut_block", "cut_doc")


def in_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    return docs.withColumn("block", F.pmod(F.xxhash64("source", "doc_id"), F.lit(blocks)).cast("int"))


def drawn(docs: DataFrame, lift: float = LIFT, max_repeats: float = MAX_REPEATS,
          budget: float | None = None) -> DataFrame:
    """The rows of ``docs``, as often as drawn, with ``n_tokens, block, epoch``.

    Texts stay where they are: a row meets only the rule of its source.
    """
    docs = docs.drop("n_tokens", "block", "epoch")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("n_tokens"))
    sized = written(sized, "sized")
    blocks = blocks_for(sized.count())
    rule = written(rules(in_blocks(sized, blocks), lift, max_repeats, budget), "rules").select(
        F.col("source").alias("_source"), F.col("full").alias("_full"),
        F.col("cut_block").alias("_cut_block"), F.col("cut_doc").alias("_cut_doc"))
    rows = in_blocks(docs.withColumn("n_tokens", word_count(F.col("text"))), blocks).join(
        rule, F.col("source").eqNullSafe(F.col("_source")))
    key = _block_key(F.col("_full"))
    more = F.coalesce((key < F.col("_cut_block")) | ((key == F.col("_cut_block")) & F.coalesce(
        _doc_key(F.col("_full")) <= F.col("_cut_doc"), F.lit(False))), F.lit(False))
    times = F.col("_full") + more.cast("int")
    epochs = F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>"))
    return rows.withColumn("epoch", F.explode(epochs)).select(
        *docs.columns, "n_tokens", "block", "epoch")


def in_turn(rows: DataFrame) -> DataFrame:
    """Drawn rows with ``turn``, the place of their block in their source's epoch."""
    order = Window.partitionBy("source", "epoch").orderBy("key")
    turns = rows.select("source", "epoch", "block").distinct().withColumn(
        "key", _block_key(F.col("epoch"))).withColumn("turn", F.row_number().over(order) - 1).select(
        F.col("source").alias("_s"), F.col("epoch").alias("_e"), F.col("block").alias("_b"), "turn")
    return rows.join(turns, F.col("source").eqNullSafe(F.col("_s")) & (F.col("epoch") == F.col("_e"))
                     & (F.col("block") == F.col("_b"))).drop("_s", "_e", "_b")
