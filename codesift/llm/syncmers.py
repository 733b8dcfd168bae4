"""Document fingerprints from closed syncmers, in DataFrame operations only.

A text is taken as its UTF-8 bytes. Of all its runs of ``K`` bytes, those are chosen whose
smallest inner run of ``S`` bytes, by hash, is the first or the last one inside it. Whether
a run is chosen depends on the run alone, not on what is around it: two texts that share a
passage choose the same anchors in it, wherever it stands. So the anchors of a text put
together from two others are those of the two that lie within the parts taken, and the
few across the seam; they need not be searched for again.

The fingerprint holds the hashes of a text's anchors in order, 8 hexadecimal digits each; a
text that has no anchor (all those under ``K`` bytes) has a hash of the whole text in their
place, an empty one the empty string. Likeness is the share of two texts' distinct anchor
hashes that they have in common, 1 if both are empty.

Defined results: a null text counts as empty; documents are put in order by doc_id, then
text, and a null doc_id sorts first; a document that is alone is its own next one; an empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesift.llm.common import let

K = 20
S = 5
_INNER = K - S + 1  # a multiple of four
_LOW = 0xFFFFFFFF
_FIRST_KEY = -(2**63)


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - by, F.lit(0)))


def _least(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.least(x, y))


def anchors(raw: Column) -> Column:
    """The closed syncmers of some bytes, in order, as longs: place * 2 ** 32 + hash."""

    def of(text: Column) -> Column:
        n = F.octet_length(text)
        inner = F.transform(F.sequence(F.lit(1), n - S + 1),
                            lambda i: F.xxhash64(F.substring(text, i, F.lit(S))))

        def chosen(edges: Column, fours: Column) -> Column:
            # The smaller edge is the least of all inner runs: of each four, one after the
            # other, which most places fail at once.
            def closed(i: Column) -> Column:
                edge = F.get(edges, i - 1)
                tests = [edge <= F.get(fours, i + (j - 1)) for j in range(0, _INNER, 4)]
                return reduce(lambda x, y: x & y, tests)

            return F.transform(
                F.filter(F.sequence(F.lit(1), n - K + 1), closed),
                lambda i: F.shiftleft((i - 1).cast("long"), 32).bitwiseOR(
                    F.hash(F.substring(text, i, F.lit(K))).cast("long").bitwiseAND(F.lit(_LOW))))

        def of_hashes(h: Column) -> Column:
            return let(_least(h, _shifted(h, _INNER - 1)), lambda edges: let(
                _least(h, _shifted(h, 1)), lambda twos: let(
                    _least(twos, _shifted(twos, 2)), lambda fours: chosen(edges, fours))))

        return F.when(n >= K, let(inner, of_hashes)).otherwise(F.array().cast("array<long>"))

    return let(raw, of)


def hashes_of(found: Column) -> Column:
    return F.transform(found, lambda v: v.bitwiseAND(F.lit(_LOW)))


def _or_whole(hashes: Column, text: Column) -> Column:
    """A text without anchors has a hash of the whole in their place."""
    whole = F.when(text == "", F.array().cast("array<long>")).otherwise(
        F.array(F.hash(text).cast("long").bitwiseAND(F.lit(_LOW))))
    return F.when(F.size(hashes) > 0, hashes).otherwise(whole)


def _digits(hashes: Column) -> Column:
    return F.lower(F.array_join(F.transform(hashes, lambda v: F.lpad(F.hex(v), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Shared part of two arrays' distinct values; 1 if both are empty."""
    both, all_ = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(all_ == 0, F.lit(1.0)).otherwise(both / all_)


def _bucket(key: Column, splits: list[int]) -> Column:
    """How many splits lie below the key, by halving."""
    if not splits:
        return F.lit(0)
    ordered = F.lit(splits)
    steps = [1 << i for i in reversed(range(len(splits).bit_length()))]
    return F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(
        (at + step <= len(splits)) & (key > F.get(ordered, at + step - 1)), at + step).otherwise(at))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, found, next_text, next_found`` of documents in descending doc_id.

    ``found`` holds the anchors. Documents go to ranges of doc_id, one per shuffle partition;
    the first of each range also goes to the one before as a guest, so that each range knows
    what comes after it. Texts are shuffled once. Only the limits of ranges and their first
    ids, a few numbers each, reach the driver.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST_KEY))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / parts for i in range(1, parts)]
    ids = docs.select(key.alias("key"))
    splits = sorted(set(ids.agg(F.percentile_approx("key", cuts, 100 * parts)).first()[0] or [])
                    ) if cuts else []
    firsts = sorted((r[0], r[1]) for r in ids.groupBy(
        _bucket(F.col("key"), splits).alias("b")).agg(F.max("key")).collect())
    # The first of a range is the guest of the range below it; the very first, of the lowest.
    hosts = [(firsts[i - 1][1], b) for i, (b, _) in enumerate(firsts)]
    # A range each, so no more rows than shuffle partitions.
    guests = F.broadcast(spark.createDataFrame(hosts, "_guest long, _host int"))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"),
                       key.alias("key")).join(guests, F.col("key") == F.col("_guest"), "left")
    home = F.struct(_bucket(F.col("key"), splits).alias("bucket"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("_host").alias("bucket"), F.lit(True).alias("guest"))
    rows = rows.select("doc_id", "text", "key", F.explode(
        F.when(F.col("_host").isNull(), F.array(home)).otherwise(F.array(home, visit))).alias("p")
        ).select("doc_id", "text", "key", "p.bucket", "p.guest")
    rows = rows.repartition(parts, "bucket").withColumn(
        "found", anchors(F.col("text").cast("binary")))
    order = Window.partitionBy("bucket").orderBy("guest", F.desc("key"), F.desc("text"))
    return rows.withColumn("next_text", F.lead("text").over(order)).withColumn(
        "next_found", F.lead("found").over(order)).filter(~F.col("guest")).select(
        "doc_id", "text", "found", "next_text", "next_found")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edit, and how alike they and the next one are.

    In the edit, the last third of the code points gives way to the first as many of the
    next document.
    """
    rows = with_next(docs)
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn(
        "_kept", F.substring("text", F.lit(1), n - third)).withColumn(
        "_put", F.substring("next_text", F.lit(1), third))
    kept, put = F.octet_length("_kept"), F.octet_length("_put")
    seam = F.concat(
        F.substring(F.col("_kept").cast("binary"), F.greatest(kept - (K - 2), F.lit(1)), F.lit(K - 1)),
        F.substring(F.col("_put").cast("binary"), F.lit(1), F.lit(K - 1)))

    def within(found: str, size: Column) -> Column:
        return F.filter(found, lambda v: F.shiftright(v, 32) + K <= size)

    edited = F.concat("_kept", "_put")
    rows = rows.select(
        "doc_id", "n_chars", edited.alias("_edited"),
        _or_whole(hashes_of(F.col("found")), F.col("text")).alias("_own"),
        _or_whole(hashes_of(F.col("next_found")), F.col("next_text")).alias("_next"),
        hashes_of(F.concat(let(kept, lambda size: within("found", size)), anchors(seam),
                           let(put, lambda size: within("next_found", size)))).alias("_mixed"))
    rows = rows.withColumn("_mixed", _or_whole(F.col("_mixed"), F.col("_edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        _digits(F.col("_own")).alias("fingerprint"),
        _digits(F.col("_mixed")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_mixed")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"))
