"""Indivisible groups put into shards of equal bytes by Karmarkar-Karp differencing.

Differencing keeps a set of partial partitions, each a group's or a union's split into
equally many parts. It takes the two with the largest spread between their parts and joins
them in opposite order, the largest part of one with the smallest of the other, until one
partition is left.

At scale this goes up a tree. Groups are dealt over buckets of bounded size by hash, and
each bucket is differenced into ``PARTS`` parts; the parts are the items of the next level,
until few enough are left for the last task, which differences them into the shards. A
group far larger than the rest ends up alone in its part, on every level, so it does not
pull others with it. A group's shard follows from its part's, down the tree by joins.

Defined results: null and empty texts form one group; repeated rows (equal doc_id) are
rows of their own; rows with a null doc_id have slots as others do; an empty table gives no
rows. Only doc_id and text are looked at.
"""

from __future__ import annotations

import heapq
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift.llm.common import blocks_for, with_rank
from codesift.session import written

SHARDS = 8
PARTS = 64
BUCKET = 2048  # items differenced in one task, about
LAST = 16_384  # items differenced by the last task, at most


def differenced(sizes: np.ndarray, parts: int) -> np.ndarray:
    """The part, 0 to ``parts`` - 1, of each item; parts of like total size."""
    out = np.zeros(len(sizes), np.int32)
    if not len(sizes):
        return out
    # A partial partition: its parts' sizes, largest first, and how it came about.
    order = count()
    heap = []
    for item, size in enumerate(sizes):
        sums = np.zeros(parts, np.int64)
        sums[0] = size
        heap.append((-int(size), next(order), sums, item))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, one, from_one = heapq.heappop(heap)
        _, _, two, from_two = heapq.heappop(heap)
        sums = one + two[::-1]
        by_size = np.argsort(-sums, kind="stable")
        sums = sums[by_size]
        place = np.empty(parts, np.int32)
        place[by_size] = np.arange(parts, dtype=np.int32)
        heapq.heappush(heap, (int(sums[-1] - sums[0]), next(order), sums,
                              (from_one, from_two, place)))
    # From the last partition down, where each part of each partial one ended up.
    stack = [(heap[0][3], np.arange(parts, dtype=np.int32))]
    while stack:
        origin, ends = stack.pop()
        if isinstance(origin, tuple):
            one, two, place = origin
            stack.append((one, ends[place]))
            stack.append((two, ends[place[::-1]]))
        else:
            out[origin] = ends[0]
    return out


def _level(items: DataFrame, parts: int) -> DataFrame:
    """``item, bucket, part, size`` with each bucket differenced into ``parts``."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        # In an order that depends on the items alone.
        group = group.sort_values(["size", "item"], ascending=[False, True], kind="stable")
        return group.assign(part=differenced(group["size"].to_numpy(), parts))

    return items.groupBy("bucket").applyInPandas(
        run, "item string, size long, bucket long, part int")


def shards_of_groups(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``item, shard`` from ``item, size``; ``item`` is a string, one row each."""
    levels = []
    items = groups.select(F.col("item"), F.col("size").cast("long"))
    while True:
        items = written(items, "items")
        n = items.count()
        last = n <= LAST
        buckets = 1 if last else -(-n // BUCKET)
        dealt = items.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets)).cast("long"))
        level = written(_level(dealt, shards if last else PARTS), "level")
        levels.append(level)
        if last:
            break
        part = F.concat_ws("/", "bucket", "part")
        items = level.groupBy(part.alias("item")).agg(F.sum("size").alias("size"))
    found = levels.pop().select("item", F.col("part").alias("shard"))
    while levels:
        above = found.select(F.col("item").alias("_part"), "shard")
        found = levels.pop().withColumn("_part", F.concat_ws("/", "bucket", "part")).join(
            above, "_part").select("item", "shard")
    return found


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of each document."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = written(docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("item")), "rows")
    # Copies fold before the shuffle: a text of any frequency is one item.
    found = written(shards_of_groups(
        rows.groupBy("item").agg(F.sum("size").alias("size")), shards), "shards")
    placed = written(rows.join(found, "item"), "placed")
    return with_rank(placed, ["shard"], ["doc_id", "item"], "slot", blocks_for(rows.count())).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
