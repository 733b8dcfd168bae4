"""Recurring lines dropped by a log-template tree, in DataFrame operations only.

Two things make a line recur. *Equal lines*: tokens that are the same in two documents or
more; lines of few tokens recur by chance, so they take ``SHORT_DOCUMENTS``, unless they
are long by characters, as lines of scripts without blanks are. *Templates*: a line goes
down a tree of fixed depth, by its number of tokens, then by its leading tokens, where a
token that holds a digit counts as variable and reads ``<*>``. In a leaf the line that comes
first (by document, then place) is a template; a line that agrees with it in at least
``SIMILARITY`` of the positions after the leading ones belongs to it, what differs being its
variable fields. Lines that do not belong to it go on to the next round, up to ``ROUNDS``
templates a leaf; after these, equal tokens make a template. Without a limit of rounds they
go on until every line belongs to a template. As different lines meet in a
template, it recurs from ``TEMPLATE_DOCUMENTS`` documents on. Lines of which most tokens
are variable tell too little: only equal ones recur.

A recurring line stays in the document where its like is met first and goes from the others.

Defined results: a null or empty text has no lines and stays as it is; a document left
without any line that holds a token, though it had some, is not kept; rows of one doc_id
count as one document but lose lines each for itself, so equal rows stay equal and other
texts of the id lose nothing by them; rows with a null doc_id stay as they are and count
nowhere; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesift.llm.common import let, may_be_in
from codesift.session import written

DEPTH = 4
LEAST_TOKENS = 5
LONG_CHARACTERS = 20
SIMILARITY = 70  # percent of positions after the leading ones
ROUNDS = 3
# Without a limit of rounds, the lines of a leaf that find their templates among each other
# in one step.
FIRST_LINES = 256
EQUAL_DOCUMENTS = 2
SHORT_DOCUMENTS = 10
TEMPLATE_DOCUMENTS = 5
VARIABLE = "<*>"
# The fewest tokens of which some may differ, by SIMILARITY of those after the leading ones.
_LOOSE_TOKENS = DEPTH + 4
# White space that parts tokens within a line.
_BLANK = r"[\x20\x09\x0B-\x0D]+"
_TOKEN = r"[^\x20\x09-\x0D]"


def raw_tokens(line: Column) -> Column:
    return F.filter(F.split(line, _BLANK), lambda t: t != "")


def line_tokens(line: Column) -> Column:
    """Tokens of a line, those with a digit as ``VARIABLE``."""
    tokens = raw_tokens(line)
    return F.when(line.rlike("[0-9]"), F.transform(
        tokens, lambda t: F.when(t.rlike("[0-9]"), VARIABLE).otherwise(t))).otherwise(tokens)


def _leaf(tokens: Column) -> Column:
    return F.xxhash64(F.size(tokens), F.slice(tokens, 1, DEPTH))


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, row, line, leaf, equal, key``: the lines with a token, by hashes of their tokens.

    ``row`` tells rows of one id apart. ``equal`` is of the tokens as they are, ``key`` of the
    masked ones, null where these tell too little. Two hashes of 64 bits always go together,
    so that unequal lines are not taken for equal ones. ``short`` marks lines of few tokens.
    """
    # Taken before lines are: what stands next to a generator is worked out for every line.
    rows = docs.filter("doc_id is not null").select(
        "doc_id", F.xxhash64("text").alias("row"), F.split("text", "\n").alias("lines"))
    lines = rows.select("doc_id", "row", F.posexplode("lines").alias("line", "text")).filter(
        F.col("text").rlike(_TOKEN))
    raw = lines.select("doc_id", "row", "line", raw_tokens(F.col("text")).alias("raw"),
                       F.col("text").rlike("[0-9]").alias("digits"), F.char_length("text").alias("long"))
    masked = F.transform("raw", lambda t: F.when(t.rlike("[0-9]"), VARIABLE).otherwise(t))
    tokens = raw.select("doc_id", "row", "line", F.xxhash64("raw").alias("equal"), "digits", "long",
                        F.when(F.col("digits"), masked).otherwise(F.col("raw")).alias("tokens"))
    variable = F.size(F.filter("tokens", lambda t: t == VARIABLE))
    few = F.size("tokens") < LEAST_TOKENS
    telling = ~few & (2 * variable <= F.size("tokens"))
    key = F.when(F.col("digits"), F.xxhash64("tokens")).otherwise(F.col("equal"))
    return tokens.select(
        "doc_id", "row", "line", _leaf(F.col("tokens")).alias("leaf"), "equal",
        F.when(telling, key).alias("key"),
        (telling & (F.size("tokens") >= _LOOSE_TOKENS)).alias("loose"),
        (few & (F.col("long") < LONG_CHARACTERS)).alias("short"))


def _equal_lines(lines: DataFrame) -> DataFrame:
    """``leaf, equal, home`` of the lines that recur as they are."""
    per_document = lines.groupBy("leaf", "equal", "doc_id").agg(F.min("short").alias("short"))
    least = F.when(F.min("short"), SHORT_DOCUMENTS).otherwise(EQUAL_DOCUMENTS)
    return per_document.groupBy("leaf", "equal").agg(
        F.min("doc_id").alias("home"), F.count("*").alias("n"), least.alias("least")).filter(
        "n >= least").select("leaf", "equal", "home")


def _agree(tokens: Column, template: Column) -> Column:
    """Whether a line belongs to a template of its leaf."""
    same = F.size(F.filter(F.zip_with(
        F.slice(tokens, DEPTH + 1, F.size(tokens)), F.slice(template, DEPTH + 1, F.size(template)),
        lambda a, b: a == b), lambda s: s))
    return 100 * same >= SIMILARITY * (F.size(tokens) - DEPTH)


def _templates(rest: DataFrame, first: int) -> DataFrame:
    """``_leaf, _templates``: the lines among the ``first`` ones of each leaf that belong to
    none before them, in order."""
    rank = F.row_number().over(Window.partitionBy("leaf").orderBy("at"))
    ahead = rest.withColumn("_rank", rank).filter(F.col("_rank") <= first).groupBy("leaf").agg(
        F.array_sort(F.collect_list(F.struct("at", "key", "tokens"))).alias("_ahead"))
    if first == 1:
        return ahead.select(F.col("leaf").alias("_leaf"), F.col("_ahead").alias("_templates"))
    chosen = F.aggregate("_ahead", F.slice("_ahead", 1, 1), lambda held, line: F.when(
        F.exists(held, lambda t: _agree(line["tokens"], t["tokens"])), held).otherwise(
        F.concat(held, F.array(line))))
    return ahead.select(F.col("leaf").alias("_leaf"), chosen.alias("_templates"))


def _alike(docs: DataFrame, kinds: DataFrame, rounds: int | None) -> DataFrame:
    """``leaf, key, n, template``: the kinds of lines that have others in their leaf, each with
    the key of the template it belongs to, or its own."""
    leaves = kinds.filter("loose").groupBy(F.col("leaf").alias("_leaf")).agg(
        F.count("*").alias("kinds"), F.sum("n").alias("n")).filter(
        (F.col("kinds") > 1) & (F.col("n") >= TEMPLATE_DOCUMENTS))
    # Their tokens are taken from one line of each kind.
    wanted = written(kinds.join(leaves.select("_leaf"), F.col("leaf") == F.col("_leaf"), "left_semi").groupBy(
        F.col("at.doc_id").alias("_id"), F.col("at.row").alias("_own")).agg(
        F.collect_set(F.struct("at.line", "leaf", "key", "n")).alias("_wanted")), "wanted")
    asked = may_be_in(docs.select("doc_id", "text"), F.col("doc_id"), wanted.select("_id"), "_asked").filter("_asked")
    texts = asked.join(
        wanted, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_own")))
    shown = texts.select("doc_id", let(F.split("text", "\n"), lambda lines: F.transform(
        "_wanted", lambda w: F.struct(
            w["leaf"].alias("leaf"), w["key"].alias("key"), w["n"].alias("n"), w["line"].alias("line"),
            F.get(lines, w["line"]).alias("text")))).alias("w")).select("doc_id", F.inline("w"))
    # Equal rows show the same line more than once.
    rest = written(shown.select("leaf", "key", "n", F.struct("doc_id", "line", "key").alias("at"),
                                line_tokens(F.col("text")).alias("tokens")).distinct(), "shown")
    found, done = None, 0
    while rounds is None or done < rounds:
        done += 1
        templates = _templates(rest, FIRST_LINES if rounds is None else 1)
        # A line belongs to the first template that it agrees with.
        own = F.get(F.filter("_templates", lambda t: _agree(F.col("tokens"), t["tokens"])), 0)["key"]
        judged = written(rest.join(templates, F.col("leaf") == F.col("_leaf")).select(
            "leaf", "key", "n", "at", "tokens", own.alias("template")), "judged")
        part = judged.filter("template is not null").select("leaf", "key", "n", "template")
        found = part if found is None else found.union(part)
        rest = judged.filter("template is null").drop("template")
        if rest.isEmpty():
            return found
    return found.union(rest.select("leaf", "key", "n", F.col("key").alias("template")))


def _template_lines(docs: DataFrame, lines: DataFrame, rounds: int | None) -> DataFrame:
    """``leaf, key, home`` of the lines whose template recurs."""
    met = written(lines.filter("key is not null").groupBy("leaf", "key", "doc_id").agg(
        F.min(F.struct("line", "row")).alias("at"), F.max("loose").alias("loose")), "met")
    kinds = written(met.groupBy("leaf", "key").agg(
        F.min(F.struct("doc_id", "at.line", "at.row")).alias("at"), F.max("loose").alias("loose"),
        F.count("*").alias("n")), "kinds")
    # A template is named by its leaf and the key of the line it stands for.
    alike = written(_alike(docs, kinds, rounds), "alike")
    # A kind that is like no other is its own template, so it has to recur by itself.
    alone = kinds.filter(F.col("n") >= TEMPLATE_DOCUMENTS).join(
        alike.select(F.col("leaf").alias("_leaf"), F.col("key").alias("_key")),
        (F.col("leaf") == F.col("_leaf")) & (F.col("key") == F.col("_key")), "left_anti")
    named = alike.union(alone.select("leaf", "key", "n", F.col("key").alias("template")))
    named = written(named, "templates")
    # Too few documents even if all were different ones; only the others are counted.
    likely = named.groupBy(F.col("leaf").alias("_leaf"), F.col("template").alias("_template")).agg(
        F.sum("n").alias("_n")).filter(F.col("_n") >= TEMPLATE_DOCUMENTS)
    named = written(named.join(likely, (F.col("leaf") == F.col("_leaf")) & (
        F.col("template") == F.col("_template")), "left_semi"), "likely")
    keys = named.select(F.col("leaf").alias("_leaf"), F.col("key").alias("_key"), "template")
    asked = may_be_in(met.select("leaf", "key", "doc_id"), F.col("key"), keys.select("_key"), "_asked").filter("_asked")
    counted = asked.join(keys, (F.col("leaf") == F.col("_leaf")) & (F.col("key") == F.col("_key"))).select(
        "leaf", "template", "doc_id").distinct().groupBy("leaf", "template").agg(
        F.min("doc_id").alias("home"), F.count("*").alias("n")).filter(F.col("n") >= TEMPLATE_DOCUMENTS)
    recurring = counted.select(F.col("leaf").alias("_leaf"), F.col("template").alias("_template"), "home")
    return named.join(recurring, (F.col("leaf") == F.col("_leaf")) & (
        F.col("template") == F.col("_template"))).select("leaf", "key", "home")


def dropped_lines(docs: DataFrame, rounds: int | None = ROUNDS) -> DataFrame:
    """``doc_id, row, lines``: the numbers of the lines that each row loses."""
    lines = written(_lines(docs), "lines")
    equal = written(_equal_lines(lines), "equal")
    templates = written(_template_lines(docs, lines, rounds), "recurring")

    def later(recurring: DataFrame, key: str) -> DataFrame:
        asked = may_be_in(lines.select("leaf", key, "doc_id", "row", "line"), F.col(key),
                          recurring.select(key), "_asked").filter("_asked")
        return asked.join(recurring, ["leaf", key]).filter("doc_id > home").select("doc_id", "row", "line")

    gone = later(equal, "equal").union(later(templates, "key"))
    return gone.groupBy("doc_id", "row").agg(F.collect_set("line").alias("lines"))


def without_recurring_lines(docs: DataFrame, rounds: int | None = ROUNDS) -> DataFrame:
    """Add ``clean_text, n_lines, n_dropped, kept`` to the rows of ``docs``.

    Other columns stay as they are; those of these four names are replaced. ``rounds`` limits
    the templates of a leaf; with None there are as many as its lines need.
    """
    docs = docs.drop("clean_text", "n_lines", "n_dropped", "kept")
    gone = written(dropped_lines(docs.select(F.col("doc_id").cast("long"), "text"), rounds), "gone").select(
        F.col("doc_id").alias("_lost_id"), F.col("row").alias("_lost_row"), F.col("lines").alias("_lost"))
    lines = F.split("text", "\n")
    left = let(lines, lambda all_lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("_lost")),
        lambda i: F.get(all_lines, i)), "\n"))
    clean = F.when(F.col("_lost").isNull(), F.col("text")).otherwise(left)
    # Documents that lose nothing are not shuffled.
    known = may_be_in(docs, F.col("doc_id").cast("long"), gone.select("_lost_id"), "_asked")
    joined = known.filter("_asked").join(gone, (F.col("doc_id") == F.col("_lost_id")) & (
        F.xxhash64("text") == F.col("_lost_row")), "left").unionByName(
        known.filter(~F.col("_asked")), allowMissingColumns=True)
    return joined.withColumn("clean_text", clean).select(
        *[f"`{c}`" for c in docs.columns], "clean_text",
        F.when(F.col("text") == "", 0).otherwise(F.coalesce(F.size(lines), F.lit(0)))
        .cast("long").alias("n_lines"),
        F.coalesce(F.size("_lost"), F.lit(0)).cast("long").alias("n_dropped"),
        (F.col("_lost").isNull() | F.col("clean_text").rlike(_TOKEN)).alias("kept"))
