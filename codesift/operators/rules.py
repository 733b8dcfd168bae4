"""The rule base: default rules, user rules, and rules as a table."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift import fixed_values as fixed
from codesift.functions.patterns import java_pattern, literal_text, needed_text
from codesift.sources.tables import small_table

RULE_SCHEMA = (
    "rule_id int, pattern string, type string, severity string, cwe string, "
    "owasp string, description string, remediation string"
)
# Rules evaluated per pass over a line; longer rule bases take several passes.
RULES_PER_PASS = 500

# Characters of a rule's needed text by which long rule bases are indexed.
GRAM = 4

# The same language in a form that reads a line once, by the id of the default rule. As
# written, that rule takes time quadratic in the line. Whatever follows any keyword also
# follows the first one, so it is enough to look behind the first keyword, without
# retrying, for a plus sign and a word character.
_ONE_PASS_FORM = {
    32: r"(?diu)^(?>.*?(?:SELECT|INSERT|UPDATE|DELETE))(?=.*\+).*[\p{L}\p{N}_]",
}
# A text that every match of the same rule holds; it stands in both of its alternatives.
_ONE_PASS_NEEDS = {32: "+"}


@dataclass(frozen=True)
class Rule:
    """One rule. ``needs`` is a text that every matching line holds, where the pattern does
    not tell; ``one_pass`` is the pattern in Java's spelling, where there is a quicker one."""

    rule_id: int
    pattern: str
    type: str
    severity: str = fixed.NOT_AVAILABLE
    cwe: str = fixed.NOT_AVAILABLE
    owasp: str = fixed.NOT_AVAILABLE
    description: str = ""
    remediation: str = ""
    needs: str | None = None
    one_pass: str | None = None

    @property
    def guard(self) -> str | None:
        return literal_text(self.pattern) or self.needs or needed_text(self.pattern)

    def matches(self, line: Column) -> Column:
        literal = literal_text(self.pattern)
        if literal is not None:
            return F.contains(line, F.lit(literal))
        found = line.rlike(self.one_pass or java_pattern(self.pattern))
        return F.contains(line, F.lit(self.guard)) & found if self.guard else found

    def row(self) -> tuple:
        return (self.rule_id, self.pattern, self.type, self.severity, self.cwe,
                self.owasp, self.description, self.remediation)


def default_rules() -> list[Rule]:
    return [
        Rule(i, *values, needs=_ONE_PASS_NEEDS.get(i), one_pass=_ONE_PASS_FORM.get(i))
        for i, values in enumerate(fixed.RULES, start=1)
    ]


def rule_table(spark: SparkSession, rules: list[Rule] | None = None) -> DataFrame:
    """The rule base as a table, one row per rule."""
    rules = default_rules() if rules is None else rules
    return small_table(spark, [r.row() for r in rules], RULE_SCHEMA)


def rule_batches(rules: DataFrame | list[Rule] | None) -> Iterator[list[Rule]]:
    """Rules in batches of bounded size.

    A rule table is read batch by batch, so its length is not limited by what one
    expression or the driver can hold.
    """
    if rules is None:
        rules = default_rules()
    if isinstance(rules, DataFrame):
        names = [c for c in RULE_SCHEMA.replace(",", "").split()[::2] if c in rules.columns]
        metadata = [c for c in ("severity", "cwe", "owasp") if c in names]
        source = (
            rules.select(*names)
            .fillna(fixed.NOT_AVAILABLE, subset=metadata)
            .orderBy("rule_id")
            .toLocalIterator()
        )
        stream = (Rule(**row.asDict()) for row in source)
    else:
        stream = iter(rules)
    while batch := list(islice(stream, RULES_PER_PASS)):
        yield batch


def indexed_rules(rules: DataFrame) -> DataFrame:
    """``rule_id, gram, needed, regex`` of a rule table of any length, worked out in tasks.

    ``gram`` is a piece of the text that every match holds; ``regex`` is null where that text
    is the whole rule. Rules that need no text of ``GRAM`` characters have no gram.
    """
    def run(batches):
        for batch in batches:
            rows = []
            for rule_id, pattern in zip(batch["rule_id"], batch["pattern"]):
                rule = Rule(int(rule_id), pattern, "")
                needed = rule.guard if rule.guard and len(rule.guard) >= GRAM else None
                regex = None if literal_text(pattern) is not None else java_pattern(pattern)
                # The middle of a text is rarer than its ends, which tend to be signs.
                at = (len(needed) - GRAM) // 2 if needed else 0
                rows.append((rule.rule_id, needed[at: at + GRAM] if needed else None, needed, regex))
            yield pd.DataFrame(rows, columns=["rule_id", "gram", "needed", "regex"])

    return rules.select("rule_id", "pattern").mapInPandas(
        run, "rule_id int, gram string, needed string, regex string")
