"""A Merkle manifest of a table, and a recursive query that climbs it from every leaf.

Leaves are rows; those of a source stand in the order of their ids and form a tree of
``ARITY`` children a node, and the subroots of the sources, in the order of their names,
form one more. The levels are built one after the other, each a third of the one before,
and stored as rows of nodes that know their parent and the digests of their siblings. A
Spark recursive query then climbs from all leaves at once, one level a step: it appends
the siblings it meets and folds its own digest with them. Steps near the root meet few
nodes many times; these are plain equi-joins, whose hot keys adaptive execution splits.

Digests are lowercase hex wherever they are hashed or returned, and bytes where stored.

Defined results: a null in any column is hashed as ``-``; an empty text is ``0:``; rows of
one id in a source stand in the order of their digests, so repeated rows are leaves side
by side and ties change nothing; rows without an id come first in their source and are
never tampered with; a null source is a source of its own, the first; a lone leaf is its
subroot, a lone source's subroot the root; an empty table gives no rows. Columns besides
the five of ``documents`` are ignored, and so none can clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesift.session import written

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# The tree over the sources; those of sources are numbered from 0.
TOP = -1


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def as_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def framed(value: Column) -> Column:
    """A value with its length in bytes before it, so that no two rows read alike."""
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(fields: dict[str, Column]) -> Column:
    return digest(F.concat(*[framed(fields[f]) for f in FIELDS]))


def without_breaks(docs: DataFrame) -> Column:
    """The text that a check meets: of half the ids, line breaks are gone."""
    hit = F.crc32(docs["doc_id"].cast("string")) % 2 == 0
    return F.when(hit, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"])


def in_order(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``pos``, from 0 without gaps in each group, and a unique ``row``.

    Rows are dealt over ranges of (group, order), so a group of any size is spread; the
    place in a range and the rows of the group in the ranges before give the place.
    """
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(
        rows.repartitionByRange(count, group, *order).sortWithinPartitions(group, *order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("row", F.monotonically_increasing_id()), "ordered")
    before = Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = written(
        dealt.groupBy(F.col(group).alias("_g"), F.col("_range").alias("_r")).agg(
            F.min("row").alias("_first"), F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))), "ranges")
    return dealt.join(ranges, dealt[group].eqNullSafe(ranges["_g"]) & (
        dealt["_range"] == ranges["_r"])).withColumn(
        "pos", F.col("_start") + F.col("row") - F.col("_first")).drop(
        "_range", "_g", "_r", "_first", "_n", "_start")


def _runs(level: DataFrame, kept: list[str]) -> DataFrame:
    """The runs of a level, rows ``tree, size, up, nodes, digest``: at most ``ARITY`` nodes each."""
    runs = level.groupBy("tree", "size", F.floor(F.col("pos") / ARITY).alias("up")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", *kept))).alias("nodes"))
    whole = F.concat_ws("", F.transform("nodes", lambda n: as_text(n["digest"])))
    return runs.withColumn("digest", digest(whole))


def _linked(runs: DataFrame, level: int, kept: list[str]) -> DataFrame:
    """The nodes of the runs, each with its parent and the digests ``before`` and ``after`` it.

    The parent of a source's last run is the place of the source in the tree on top.
    """
    to_top = (F.ceil(F.col("size") / F.lit(ARITY ** (level + 1))) <= 1) & (F.col("tree") != TOP)

    def joined(of) -> Column:
        return F.aggregate(F.filter("nodes", of), F.unhex(F.lit("")),
                           lambda a, n: F.concat(a, n["digest"]))

    rows = runs.select("tree", "size", "up", "nodes", F.explode("nodes").alias("n"))
    return rows.select(
        "tree", F.lit(level).alias("level"), F.col("n.pos").alias("pos"),
        joined(lambda x: x["pos"] < F.col("n.pos")).alias("before"),
        joined(lambda x: x["pos"] > F.col("n.pos")).alias("after"),
        F.when(to_top, TOP).otherwise(F.col("tree")).cast("long").alias("up_tree"),
        F.when(to_top, 0).otherwise(level + 1).alias("up_level"),
        F.when(to_top, F.col("tree")).otherwise(F.col("up")).cast("long").alias("up_pos"),
        *[F.col(f"n.{c}").alias(c) for c in kept])


def _tree(level: DataFrame, largest: int, kept: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The lowest nodes, all others, and the last ``tree, digest``, of trees that grow side by side.

    ``level`` holds ``tree, size, pos, digest`` and the columns to keep on the lowest nodes;
    ``largest`` is the greatest size. Each level is written, then read by the next one.
    """
    lowest, others, ended = None, [], [level.filter("size = 1").select("tree", "digest")]
    number = 0
    while -(-largest // ARITY**number) > 1:
        grown = F.ceil(F.col("size") / F.lit(ARITY**number))
        runs = written(_runs(level.filter(grown > 1), [] if number else kept), "runs")
        nodes = _linked(runs, number, [] if number else kept)
        if number:
            others.append(nodes)
        else:
            lowest = nodes
        level = runs.select("tree", "size", F.col("up").alias("pos"), "digest")
        number += 1
        done = F.ceil(F.col("size") / F.lit(ARITY**number)) == 1
        ended.append(level.filter(done).select("tree", "digest"))

    def union(parts: list[DataFrame]) -> DataFrame | None:
        whole = None
        for part in parts:
            whole = part if whole is None else whole.unionByName(part)
        return whole

    return lowest, union(others), union(ended)


def _climbed(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """``row, fold, proof`` of each leaf: what it folds to at the root, and its siblings' digest."""
    spark = leaves.sparkSession
    names = {n: f"merkle_{n}_{uuid.uuid4().hex}" for n in ("leaves", "nodes")}
    leaves.createOrReplaceTempView(names["leaves"])
    nodes.createOrReplaceTempView(names["nodes"])
    fold = ("unhex(sha2(concat(lower(hex({t}.before)), lower(hex({d})), lower(hex({t}.after))), 256))")
    limit = "spark.sql.cteRecursionRowLimit"  # would stop the query at a million rows
    usual = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        return written(spark.sql(f"""
            WITH RECURSIVE climb(row, step, tree, level, pos, fold, siblings) AS (
              SELECT row, 0, up_tree, up_level, up_pos,
                CASE WHEN l.before IS NULL THEN met ELSE {fold.format(t='l', d='l.met')} END,
                concat(l.before, l.after)
              FROM {names['leaves']} l
              UNION ALL
              SELECT c.row, c.step + 1, n.up_tree, n.up_level, n.up_pos,
                {fold.format(t='n', d='c.fold')}, concat(n.before, n.after)
              FROM climb c JOIN {names['nodes']} n
                ON n.tree = c.tree AND n.level = c.level AND n.pos = c.pos)
            SELECT row, max_by(fold, step) AS fold, sha2(array_join(transform(
                array_sort(collect_list(struct(step, siblings))), s -> lower(hex(s.siblings))), ''),
                256) AS proof
            FROM climb GROUP BY row"""), "climbed")
    finally:
        spark.conf.set(limit, usual)
        for name in names.values():
            spark.catalog.dropTempView(name)


def manifest(docs: DataFrame, met: Column) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of each row.

    ``met`` is the text that a check meets in place of the stored one.
    """
    fields = {f: docs[f] for f in FIELDS}
    rows = docs.select(docs["doc_id"], docs["source"], leaf_digest(fields).alias("digest"),
                       leaf_digest({**fields, "text": met}).alias("met"))
    placed = in_order(rows, "source", ["doc_id", "digest"])
    sizes = written(placed.groupBy("source").agg(F.count("*").alias("size")), "sizes")
    sources = written(in_order(sizes.withColumn("_all", F.lit(0)), "_all", ["source"]).select(
        F.col("source").alias("_source"), F.col("pos").alias("tree"), "size"), "sources")
    spark, kept = docs.sparkSession, ["row", "doc_id", "met"]
    many, largest = sources.agg(F.count("*"), F.max("size")).first()
    if not many:
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, "
                                     "proof_sha256 string, folded_root string, verified boolean")
    leaves = written(placed.join(sources, placed["source"].eqNullSafe(sources["_source"])).select(
        "tree", "size", "pos", "digest", *kept), "leaves")
    lowest, nodes, subroots = _tree(leaves, largest, kept)
    subroots = written(subroots, "subroots")
    top = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(many).alias("size"),
                          F.col("tree").alias("pos"), "digest")
    low, high, last = _tree(top, many, [])
    root = last.first()["digest"].hex()  # one row
    none = F.lit(None).cast("binary")
    alone = leaves.filter("size = 1").select(
        none.alias("before"), none.alias("after"), F.lit(TOP).cast("long").alias("up_tree"),
        F.lit(0).alias("up_level"), F.col("tree").alias("up_pos"), "row", "met")
    start = alone if lowest is None else alone.unionByName(lowest.select(alone.columns))
    above = [part for part in (nodes, low, high) if part is not None]
    empty = leaves.limit(0).select(
        "tree", F.lit(0).alias("level"), "pos", none.alias("before"), none.alias("after"),
        F.col("tree").alias("up_tree"), F.lit(0).alias("up_level"), F.col("pos").alias("up_pos"))
    whole = empty
    for part in above:
        whole = whole.unionByName(part)
    climbed = _climbed(start, written(whole, "nodes"))
    folded = as_text(F.col("fold"))
    return leaves.join(climbed, "row").join(
        subroots.select("tree", F.col("digest").alias("subroot")), "tree").select(
        "doc_id", as_text(F.col("digest")).alias("leaf"), as_text(F.col("subroot")).alias("subroot"),
        F.lit(root).alias("root"), F.col("proof").alias("proof_sha256"),
        folded.alias("folded_root"), (folded == root).alias("verified"))
