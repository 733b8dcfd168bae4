"""Rule scan: which rules hit which lines.

Two forms of the same result:

* ``finding_rows`` explodes the lines and gives one row per (line, rule). Use it
  when findings are aggregated; it needs no shuffle before the aggregation.
* ``with_findings`` keeps one row per document with the findings nested in an
  array. Nothing is exploded or regrouped, so nesting needs no shuffle either.

Rules are expressions, not a joined table, so patterns compile once per task. Only a table of
more rules than one pass takes is joined, by pieces of the texts that its rules need.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from codesift import fixed_values as fixed
from codesift.functions import text
from codesift.operators.rules import GRAM, RULES_PER_PASS, Rule, indexed_rules, rule_batches, rule_table
from codesift.session import written

FINDING_TYPE = (
    "array<struct<line:int,content:string,rule_id:int,type:string,severity:string,"
    "cwe:string,owasp:string,description:string,remediation:string>>"
)
METADATA = ("type", "severity", "cwe", "owasp", "description", "remediation")
# Characters that most rules hold and many lines do not.
_MARKS = "(=+."
# Slots of the table that tells which pieces of lines may be a rule's.
SLOT_BITS = 20
# Characters of lines worked on at a time within a task.
CHARACTERS = 1_000_000


def may_hit(value: Column, rules: list[Rule]) -> Column:
    """False only if no rule can hit the text; a plain byte search.

    Guards that share a mark are looked for only where the mark itself occurs.
    """
    guards = {rule.guard for rule in rules}
    if None in guards:
        return F.lit(True)
    # A guard that holds another guard adds nothing.
    short = [g for g in sorted(guards) if not any(o != g and o in g for o in guards)]
    by_mark: dict[str, list[str]] = {}
    for guard in short:
        by_mark.setdefault(next((m for m in _MARKS if m in guard), ""), []).append(guard)

    def found(texts: list[str]) -> Column:
        return reduce(Column.__or__, (F.contains(value, F.lit(t)) for t in texts))

    return reduce(Column.__or__, (
        found([mark]) & found(texts) if mark and len(texts) > 1 else found(texts)
        for mark, texts in by_mark.items()))


def hit_rules(line: Column, rules: list[Rule]) -> Column:
    """Ids of the rules that hit a line, in rule order."""
    return F.array_compact(
        F.array(*[F.when(rule.matches(line), F.lit(rule.rule_id)) for rule in rules])
    )


def numbered_lines(df: DataFrame, keys: list[str], code: str = "code") -> DataFrame:
    """One row per line: keys, ``line`` counted from 1, and ``content``."""
    return df.select(*keys, F.posexplode(text.lines(F.col(code))).alias("_at", "content")).select(
        *keys, (F.col("_at") + 1).alias("line"), "content"
    )


def piece_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key for every run of ``GRAM`` characters, and the number of its text."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    of = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    n = max(len(codes) - GRAM + 1, 0)
    key = np.zeros(n, np.uint64)
    for i in range(GRAM):
        key = (key + codes[i: i + n]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    inside = of[:n] == of[GRAM - 1:]
    return key[inside], of[:n][inside]


def _slots(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _line_groups(texts: list[str]):
    """Ranges of lines of about ``CHARACTERS`` characters."""
    low = total = 0
    for at, line in enumerate(texts, start=1):
        total += len(line)
        if total >= CHARACTERS or at == len(texts):
            yield low, at
            low, total = at, 0


def _indexed_hits(lines: DataFrame, keys: list[str], index: DataFrame) -> DataFrame:
    """Hits of indexed rules: the pieces of a line meet those of the rules, and a pattern
    runs only on lines that hold the text it needs.

    Pieces of lines that no rule has go in the tasks, by a table of a bit a slot."""
    def keyed(batches):
        for batch in batches:
            key, _ = piece_keys(batch.column("gram").to_pylist())
            yield batch.append_column("_key", pa.array(key.view(np.int64)))

    index = written(index.mapInArrow(
        keyed, StructType([*index.schema.fields, StructField("_key", LongType())])), "pieces")

    def placed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(_slots(batch.column(0).to_numpy().view(np.uint64)))], ["slot"])

    # At most 2 ** SLOT_BITS rows, however many rules there are.
    slots = index.select("_key").mapInArrow(placed, "slot long").distinct().toArrow()
    table = np.zeros(2**SLOT_BITS, bool)
    table[slots["slot"].to_numpy()] = True
    shared = lines.sparkSession.sparkContext.broadcast(table)

    def near(batches):
        known = shared.value
        for batch in batches:
            texts = batch.column("content").to_pylist()
            for low, high in _line_groups(texts):
                key, of = piece_keys(texts[low:high])
                here = known[_slots(key)]
                found = np.unique(np.stack([of[here], key[here].view(np.int64)]), axis=1)
                yield batch.take(pa.array(low + found[0])).append_column("_key", pa.array(found[1]))

    met = lines.filter(F.char_length("content") >= GRAM).mapInArrow(
        near, StructType([*lines.schema.fields, StructField("_key", LongType())])).join(index, "_key")
    holds = F.contains("content", "needed") & (F.col("regex").isNull() | F.expr("content rlike regex"))
    return met.filter(holds).select(*keys, "line", "content", "rule_id")


def hit_rows(df: DataFrame, keys: list[str], rules: DataFrame | list[Rule] | None = None,
             code: str = "code") -> DataFrame:
    """One row per (line, rule) hit: keys, ``line``, raw ``content``, ``rule_id``.

    A table of many rules is met by an index; the corpus is then read once for all rules that
    need some text, whatever their number.
    """
    lines = numbered_lines(df, keys, code)
    parts = []
    if isinstance(rules, DataFrame) and rules.limit(RULES_PER_PASS + 1).count() > RULES_PER_PASS:
        index = written(indexed_rules(rules), "rules")
        parts.append(_indexed_hits(lines, keys, index.filter("gram is not null")))
        without = index.filter("gram is null").select("rule_id")
        rules = rules.join(without, "rule_id", "left_semi")
    for batch in rule_batches(rules):
        parts.append(
            lines.filter(may_hit(F.col("content"), batch)).select(
                *keys, "line", "content",
                F.explode(hit_rules(F.col("content"), batch)).alias("rule_id"),
            )
        )
    if not parts:
        return lines.withColumn("rule_id", F.lit(None).cast("int")).filter(F.lit(False))
    return reduce(DataFrame.unionByName, parts)


def with_rule_metadata(hits: DataFrame, rules: DataFrame | list[Rule] | None = None) -> DataFrame:
    """Join type, severity and the other rule columns on ``rule_id``.

    A plain join: Spark broadcasts the rules where they are small, and adaptive execution
    splits a rule that has most of the hits.
    """
    table = rules if isinstance(rules, DataFrame) else rule_table(hits.sparkSession, rules)
    return hits.join(table.drop("pattern"), "rule_id")


def finding_rows(df: DataFrame, keys: list[str],
                 rules: DataFrame | list[Rule] | None = None, code: str = "code") -> DataFrame:
    """One row per finding with its stripped snippet and rule metadata."""
    hits = hit_rows(df, keys, rules, code).withColumn("content", text.snippet(F.col("content")))
    return with_rule_metadata(hits, rules)


def _per_line(code: Column, batches: list[list[Rule]], of_batch) -> Column:
    """What ``of_batch(batch, line, line number)`` gives, flattened over all lines."""

    def of_line(line: Column, at: Column) -> Column:
        found = [F.when(may_hit(line, b), of_batch(b, line, (at + 1).cast("int"))) for b in batches]
        return F.flatten(F.array_compact(F.array(*found)))

    return F.flatten(F.transform(text.lines(code), of_line))


def findings_column(code: Column, rules: DataFrame | list[Rule] | None = None) -> Column:
    """All findings of a text as an array, ordered by line and then rule."""
    batches = list(rule_batches(rules))
    known = [rule for batch in batches for rule in batch]
    place = {rule.rule_id: i for i, rule in enumerate(known)}
    metadata = F.array(*[
        F.struct(F.lit(rule.rule_id).alias("rule_id"),
                 *[F.lit(getattr(rule, name)).alias(name) for name in METADATA])
        for rule in known
    ])

    def places(batch: list[Rule], line: Column, number: Column) -> Column:
        hits = F.array_compact(F.array(*[
            F.when(rule.matches(line), F.lit(place[rule.rule_id])) for rule in batch]))
        return F.transform(hits, lambda hit: F.struct(
            number.alias("line"), text.snippet(line).alias("content"), hit.alias("place")))

    def finding(hit: Column) -> Column:
        rule = F.get(metadata, hit["place"])
        return F.struct(
            hit["line"].alias("line"), hit["content"].alias("content"),
            rule["rule_id"].alias("rule_id"), *[rule[name].alias(name) for name in METADATA])

    if not batches:
        return F.array().cast(FINDING_TYPE)
    return F.transform(_per_line(code, batches, places), finding).cast(FINDING_TYPE)


def with_danger_count(df: DataFrame, rules: DataFrame | list[Rule] | None = None,
                      code: str = "code") -> DataFrame:
    """Add only the number of findings."""
    batches = list(rule_batches(rules))
    if not batches:
        return df.withColumn("danger_count", F.lit(0))
    found = _per_line(F.col(code), batches, lambda batch, line, _: hit_rules(line, batch))
    return df.withColumn("danger_count", F.size(found))


def with_findings(df: DataFrame, rules: DataFrame | list[Rule] | None = None,
                  code: str = "code") -> DataFrame:
    """Add ``findings`` and ``danger_count`` to every row, empty ones included."""
    return df.withColumn("findings", findings_column(F.col(code), rules)).withColumn(
        "danger_count", F.size("findings")
    )


def weak_label(findings: Column) -> Column:
    return (F.size(findings) > 0).cast("int")


def weak_cwe(findings: Column) -> Column:
    """Distinct CWEs joined by ``;`` in sorted order, "None" without findings."""
    cwes = F.array_sort(F.array_distinct(F.transform(findings, lambda f: f["cwe"])))
    return F.when(F.size(findings) > 0, F.array_join(cwes, ";")).otherwise(fixed.NO_CWE)


def nest_findings(files: DataFrame, finding_table: DataFrame, keys: list[str]) -> DataFrame:
    """Attach a table of finding rows to its files; files without findings stay.

    For findings that arrive as a table of their own; a scan nests them in place
    with ``with_findings``.
    """
    columns = ["line", "rule_id"] + [
        c for c in finding_table.columns if c not in keys + ["line", "rule_id"]
    ]
    nested = finding_table.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*columns))).alias("findings")
    )
    return files.join(nested, keys, "left").withColumn(
        "findings", F.coalesce("findings", F.array())
    )
