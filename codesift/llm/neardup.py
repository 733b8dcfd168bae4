"""Near-duplicate documents by an LSH forest, confirmed on full shingle sets.

Copies first: documents of equal word sequences form one class, so a text with a third of
all rows is one row from then on. Each class gets minhashes, cut into several trees; a
tree's order of classes is the order of its minhashes. Classes that share the first two
values of a tree form a region; a crowded region is parted by the next value, as deep as
the tree goes, and then by hash with a link between the parts. Within a region, neighbours
in the tree's order share the longest prefixes and become candidates by their minhash
estimate: first the ``NEAR`` before a class, of which the best partner is confirmed on the
whole sets, then the others where they join components; at last, across the components
found so far, the ``FAR`` before it, all confirmed (but in crowded regions without any link by
then). So a
group of many near copies costs a few pairs for each, never all pairs of a region.

Regions of more than ``FAR + 1`` classes have pairs that never were neighbours. Where such
a region still holds several components after all that, an exact join of its classes
follows: two sets reach the threshold only if they share a shingle among the first of each
in one order of all shingles (rare ones first), as many as the threshold lets a set lose
and one more. Prefixes met in several components give the pairs across these, first with
the most typical class of each prefix, then all of them, confirmed on the whole sets. A
set meets sets of its own size or larger by an even shorter prefix, so what many sets of
one size share without being alike makes no pairs; the sets of a frequent shingle meet in
blocks, each pair of blocks on its own. A region that is one component by then has no
pair that could join anything, however many copies it holds.

Defined results: a null or wordless text has an empty set and stands alone; a document of
fewer than ``WIDTH`` words is one shingle; a null doc_id stands alone with a null
component and is kept; repeated rows share a component and are all kept if their id is the
component's; an empty table gives no rows. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesift.llm.common import components, with_more_edges
from codesift.llm.hashing import ODD, mixed, window_hashes, word_hashes
from codesift.session import written

WIDTH = 5
PERCENT = 75
TREES = 16
DEPTH = 6
FIRST_DEPTH = 2
REGION = 256
NEAR = 2
FAR = 32
# Shingles that are ordered by how often they come; any others go before these, by hash.
# The order decides how many pairs are looked at, never which are found.
ORDERED = 2**18
COMMON = 16
# Sets that meet in one task over one shingle, at most; beyond it they meet block by block.
BLOCK = 512
# Standard errors that an estimate from TREES * DEPTH minhashes may lie below the threshold.
SLACK = 4.0
_CHUNK = 4096


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A to Z in lower case."""
    return text.lower().split()


def shingle_set(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(width, len(words))))


def _keys() -> tuple[np.ndarray, np.ndarray]:
    """One xor and one odd factor per minhash, from a fixed rule."""
    n = TREES * DEPTH
    base = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * ODD)
    return base[:n, None], base[n:, None] | np.uint64(1)


def minhashes(shingles: np.ndarray) -> np.ndarray:
    """The least hash of the set under each of TREES * DEPTH orders, as 32-bit numbers."""
    mask, factor = _keys()
    least = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), _CHUNK):
        np.minimum(least, ((shingles[None, i: i + _CHUNK] ^ mask) * factor).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def profiles(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, words_key, minhash`` of each document; no key without words."""
    schema = "doc_id long, n_shingles long, words_key string, minhash array<int>"

    def run(batches):
        import xxhash

        for batch in batches:
            sizes, keys, hashes = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py() or b"")
                shingles = shingle_set(words)
                sizes.append(len(shingles))
                keys.append(xxhash.xxh3_128_hexdigest(b" ".join(words)) if words else None)
                hashes.append(minhashes(shingles) if words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.string()),
                 pa.array(hashes, pa.list_(pa.int32()))],
                ["doc_id", "n_shingles", "words_key", "minhash"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        run, schema)


def _regions(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows ``id, n, tree, region, rest``: each class in its region of each tree. And rows
    ``id, region`` of the regions with more classes than all neighbours of one."""
    trees = F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.struct(t.alias("tree"), F.slice("minhash", t * DEPTH + 1, DEPTH).alias("label"))))
    rows = classes.select("id", "n", trees.alias("t")).select("id", "n", "t.tree", "t.label").select(
        "id", "n", "tree",
        F.xxhash64("tree", *[F.element_at("label", i + 1) for i in range(FIRST_DEPTH)])
        .alias("region"),
        F.slice("label", FIRST_DEPTH + 1, DEPTH).alias("rest"))

    def sized(part: DataFrame) -> DataFrame:
        sizes = part.groupBy("region").agg(F.count("*").alias("size")).filter("size > 1")
        return part.drop("size").join(sizes, "region")

    rows = written(sized(rows), "regions")
    beyond = rows.filter(F.col("size") > FAR + 1).select("id", "region")
    settled = rows.filter(F.col("size") <= REGION)
    crowded = rows.filter(F.col("size") > REGION)
    for depth in range(DEPTH - FIRST_DEPTH):
        if crowded.isEmpty():
            break
        crowded = written(sized(crowded.withColumn(
            "region", F.xxhash64("region", F.element_at("rest", depth + 1)))), "regions")
        settled = settled.union(crowded.select(settled.columns).filter(F.col("size") <= REGION))
        crowded = crowded.filter(F.col("size") > REGION)
    # As deep as the tree goes and still crowded: parts by hash, each with the region's
    # smallest class in it as the link between them.
    parts = F.ceil(F.col("size") / REGION)
    least = crowded.groupBy("region").agg(F.min(F.struct("id", "n", "tree", "rest", "size")).alias("m"))
    links = least.select("region", "m.*").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    split = crowded.withColumn("part", F.pmod(F.xxhash64("id", "tree"), parts)).unionByName(
        links).distinct().withColumn("region", F.xxhash64("region", "part")).drop("part")
    return settled.select("id", "n", "tree", "region", "rest").union(
        split.select("id", "n", "tree", "region", "rest")), beyond


def ordered(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id, n, short, region, rest``: classes in their regions, with short minhashes. And
    ``id, region`` of the crowded ones, before any was parted."""
    short = classes.select(F.col("id").alias("_id"), F.transform(
        "minhash", lambda x: x.bitwiseAND(F.lit(0x7F)).cast("byte")).alias("short"))
    rows, beyond = _regions(classes)
    rows = rows.select("id", "n", "region", "rest")
    return rows.join(short, F.col("id") == F.col("_id")).drop("_id"), beyond


def candidates(rows: DataFrame, reach: int) -> DataFrame:
    """``a, b, same``: pairs of ``rows`` that are neighbours in a region and look alike.

    Each class meets the ``reach`` classes before it in its region. Pairs of one component
    (``component``), pairs whose sizes rule the threshold out, and pairs of which far too few
    minhashes agree go no further.
    """
    total, share = TREES * DEPTH, PERCENT / 100
    least = total * share - SLACK * (total * share * (1 - share)) ** 0.5
    order = Window.partitionBy("region").orderBy("rest", "id")
    own = F.struct("id", "n", "short", "component")
    places = [f"_p{i}" for i in range(1, reach + 1)]
    rows = rows.select("id", "n", "short", "component", *[
        F.lag(own, i + 1).over(order).alias(p) for i, p in enumerate(places)])

    def met(other):
        same = F.aggregate(F.zip_with("short", other["short"], lambda x, y: (x == y).cast("int")),
                           F.lit(0), lambda s, x: s + x)
        near = (other["component"] != F.col("component")) & (
            100 * F.least("n", other["n"]) >= PERCENT * F.greatest("n", other["n"]))
        return F.struct(other["id"].alias("id"), F.when(near, same).alias("same"))

    pairs = rows.select("id", F.explode(F.filter(
        F.array(*[met(F.col(p)) for p in places]), lambda p: p["same"] >= least)).alias("p"))
    return pairs.select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b"),
                        F.col("p.same").alias("same")).distinct()


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, shingles`` (sorted 64-bit numbers as bytes) of the documents in ``ids``."""

    def run(batches):
        for batch in batches:
            sets = [shingle_set(words_of(t.as_py())).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])

    # A repeated id would give several sets; the words of its class decide.
    return docs.join(ids, docs["doc_id"] == ids["id"]).select(
        F.col("id"), F.col("text").cast("binary")).mapInArrow(run, "id long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose whole sets reach the threshold."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                at = np.searchsorted(x, y)
                both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_sb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select(
        "a", "b", "_sa", "_sb").mapInArrow(run, "a long, b long")


def _prefixes(sets: DataFrame) -> DataFrame:
    """``id, n, component, typical, key, at``: the first shingles of each set, with their places.

    ``typical`` is how often the set's shingles come, by the mean of the logarithms.
    """
    def shingles(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = [x.as_py() for x in batch.column(0)[low: low + 64]]
                keys, n = np.unique(np.frombuffer(b"".join(part), np.uint64), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

    counts = sets.select("shingles").mapInArrow(shingles, "key long, n long").groupBy("key").agg(
        F.sum("n").alias("n")).filter(F.col("n") > COMMON)
    found = counts.orderBy(F.desc("n"), "key").limit(ORDERED).toArrow()  # 16 bytes each
    keys = found["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    shared = sets.sparkSession.sparkContext.broadcast(
        (keys[order], found["n"].to_numpy()[order].astype(np.int64)))

    def run(batches):
        common, counts = shared.value
        for batch in batches:
            for row, component, data in zip(batch.column(0), batch.column(1), batch.column(2)):
                own = np.frombuffer(data.as_py(), np.uint64)
                often = np.zeros(len(own), np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                    often = np.where(common[at] == own, counts[at], 0)
                # A partner holds this many of the set at least.
                held = -(-PERCENT * len(own) // 100)
                first = own[np.lexsort((own, often))][: len(own) - held + 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first), row.as_py(), np.int64)),
                     pa.array(np.full(len(first), len(own), np.int64)),
                     pa.array(np.full(len(first), component.as_py(), np.int64)),
                     pa.array(np.full(len(first), np.log1p(often).mean())),
                     pa.array(first.view(np.int64)), pa.array(np.arange(len(first)))],
                    ["id", "n", "component", "typical", "key", "at"])

    return sets.select("id", "component", "shingles").mapInArrow(
        run, "id long, n long, component long, typical double, key long, at long")


def _labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    """``rows`` with the ``component`` of each ``id``."""
    label = label.select(F.col("id").alias("_id"), F.col("component").alias("_label"))
    return rows.drop("component").join(label, F.col("id") == F.col("_id"), "left").withColumn(
        "component", F.coalesce("_label", "id")).drop("_id", "_label")


def _several(rows: DataFrame, group: str) -> DataFrame:
    """The rows of the groups that hold more than one component."""
    wanted = rows.groupBy(group).agg(
        F.min("component").alias("_low"), F.max("component").alias("_high")).filter(
        "_low < _high").select(F.col(group).alias("_group"))
    return rows.join(wanted, F.col(group) == F.col("_group"), "left_semi")


def _may_link(x: str, y: str) -> Column:
    """Whether sets may reach the threshold if this is the first shingle that they share.

    What two sets of these sizes must share is no more than what is left of both from here on.
    """
    need = PERCENT * (F.col(f"{x}.n") + F.col(f"{y}.n"))
    left_over = F.least(F.col(f"{x}.n") - F.col(f"{x}.at"), F.col(f"{y}.n") - F.col(f"{y}.at"))
    return ((F.col(f"{x}.component") != F.col(f"{y}.component"))
            & (100 * F.least(f"{x}.n", f"{y}.n") >= PERCENT * F.greatest(f"{x}.n", f"{y}.n"))
            & ((100 + PERCENT) * left_over >= need))


def met_at_hubs(rows: DataFrame) -> DataFrame:
    """Pairs of each class with the most typical class of a prefix shingle."""
    hubs = rows.groupBy("key").agg(
        F.max(F.struct("typical", "id", "n", "component", "at")).alias("m")).select(
        F.col("key").alias("_key"), "m.id", "m.n", "m.component", "m.at")
    both = rows.alias("x").join(hubs.alias("y"), F.col("x.key") == F.col("y._key"))
    return both.filter(_may_link("x", "y")).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def met_in_blocks(rows: DataFrame) -> DataFrame:
    """All pairs over shared prefix shingles that the bounds let through, in blocks."""
    # The smaller set of a pair is met by fewer of its shingles: its partner is no smaller,
    # so they share more than any two sets that hold the smaller one may.
    smaller = rows.filter(
        (100 + PERCENT) * (F.col("n") - F.col("at")) >= 2 * PERCENT * F.col("n"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("_all")).join(
        smaller.groupBy("key").agg(F.count("*").alias("_small")), "key")
    blocks = sizes.select(
        F.col("key").alias("_key"), F.ceil(F.col("_all") / BLOCK).alias("_wide"),
        F.ceil(F.col("_small") / BLOCK).alias("_high"))

    def dealt(part: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in a block of its own side, once for every block of the other."""
        part = part.join(blocks, F.col("key") == F.col("_key"))
        mine = F.pmod(F.xxhash64("id"), F.col(own))
        return part.withColumn(own, mine).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))).drop("_key")

    x, y = dealt(rows, "_wide", "_high").alias("x"), dealt(smaller, "_high", "_wide").alias("y")
    both = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x._wide") == F.col("y._wide"))
                  & (F.col("x._high") == F.col("y._high"))
                  & ((F.col("y.n") < F.col("x.n"))
                     | ((F.col("y.n") == F.col("x.n")) & (F.col("y.id") < F.col("x.id"))))
                  & _may_link("x", "y"))
    return both.select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def _without_quiet(rows: DataFrame) -> DataFrame:
    """The rows but those of crowded regions in which nothing is linked so far.

    Their far neighbours would be looked at for nothing: the exact join has all their pairs.
    """
    region = Window.partitionBy("region")
    linked = F.max(F.col("component") != F.col("id")).over(region)
    few = F.count("*").over(region) <= FAR + 1
    return rows.withColumn("_open", linked | few).filter("_open").drop("_open")


def with_rest_of_links(crowded: DataFrame, sets: DataFrame, label: DataFrame) -> DataFrame:
    """``label`` once the links that still join components of crowded regions are in it."""
    if crowded.isEmpty():
        return label
    open_rows = written(_several(written(_labelled(crowded, label), "crowded"), "region").select(
        "id", "component").distinct(), "open")
    if open_rows.isEmpty():
        return label
    own = sets.join(open_rows.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id")).drop("_id")
    rows = written(_several(written(_prefixes(written(own, "open_sets")), "prefixes"), "key"), "mixed")
    met = written(met_at_hubs(rows), "pairs")
    more = with_more_edges(label, confirmed(met, sets))
    if more is not label:
        rows = written(_several(written(_labelled(rows, more), "mixed"), "key"), "mixed")
    others = written(met_in_blocks(rows).join(met, ["a", "b"], "left_anti"), "pairs")
    return with_more_edges(more, confirmed(others, sets))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each document."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    found = written(profiles(docs), "profiles")
    classes = written(
        found.filter("words_key is not null and doc_id is not null").groupBy("words_key").agg(
            F.min("doc_id").alias("id"), F.max(F.struct("n_shingles", "minhash")).alias("m"))
        .select("words_key", "id", F.col("m.n_shingles").alias("n"), "m.minhash"), "classes")
    rows, crowded = ordered(classes)
    rows, crowded = written(rows, "ordered"), written(crowded, "crowded")
    sets = written(_sets(docs, rows.select("id").union(crowded.select("id")).distinct()), "sets")
    # Close neighbours first, the best one of each class, then those in another component:
    # most links then lie within a component, where they change nothing more. Only what is
    # still in another one is looked for among many more neighbours.
    close = written(candidates(rows.withColumn("component", F.col("id")), NEAR), "pairs")
    ends = close.select("a", "b", "same", F.explode(F.array("a", "b")).alias("end"))
    best = ends.groupBy("end").agg(F.max(F.struct("same", "a", "b")).alias("m"))
    chosen = written(best.select("m.a", "m.b").distinct(), "chosen")
    links = written(confirmed(chosen, sets), "links")

    label = written(components(links), "label")
    others = close.join(chosen, ["a", "b"], "left_anti")
    for end in ("a", "b"):
        others = others.join(label.select(F.col("id").alias(end), F.col("component").alias(f"_{end}")), end, "left")
    others = others.filter(F.coalesce("_a", "a") != F.coalesce("_b", "b"))
    label = with_more_edges(label, confirmed(others, sets))
    wide = candidates(_without_quiet(_labelled(rows, label)), FAR).join(close, ["a", "b"], "left_anti")
    label = with_more_edges(label, confirmed(written(wide, "pairs"), sets))
    whole = with_rest_of_links(crowded, sets, label)
    named = classes.select("words_key", F.col("id").alias("_class"))
    named = named.join(whole.select(F.col("id").alias("_class"), "component"), "_class", "left")
    named = named.select(F.col("words_key"), F.coalesce("component", "_class").alias("_component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return found.select("doc_id", "n_shingles", "words_key").join(named, "words_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
