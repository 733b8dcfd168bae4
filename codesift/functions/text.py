"""Text columns: decoding, cleaning, lines, tokens and brace depth.

All are built-in expressions, so they run inside the JVM and reach the whole
text of every row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codesift import fixed_values as fixed

# Members of a character class: Unicode word and white-space characters. Both
# spellings mean the same in Java and RE2.
WORD_CLASS = r"\p{L}\p{N}_"
SPACE_CLASS = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"
# The white-space characters themselves, for trimming (a line holds no newline).
SPACE_CHARS = (
    "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)
_REPLACEMENT = "\ufffd"
_STASHED_REPLACEMENT = "\x00\x01\x00"


def without_comments(code: Column) -> Column:
    """Drop what follows ``//``, then what follows ``#``, up to the line end."""
    return F.regexp_replace(F.regexp_replace(code, r"(?d)//.*", ""), r"(?d)#.*", "")


def clean_code(code: Column) -> Column:
    """Drop comments, fold white space, trim; null gives ''."""
    folded = F.regexp_replace(without_comments(code), f"[{SPACE_CLASS}]+", " ")
    return F.coalesce(F.trim(folded), F.lit(""))


def lines(code: Column) -> Column:
    """Lines of a text; the empty text has one line."""
    return F.split(F.coalesce(code, F.lit("")), "\n", -1)


def snippet(line: Column) -> Column:
    """The stripped line, cut to the snippet length."""
    return F.substring(F.btrim(line, F.lit(SPACE_CHARS)), 1, fixed.SNIPPET_CHARS)


def tokens(code: Column) -> Column:
    """Lower-cased word tokens of code without comments.

    White space ends a token whether or not it is folded, so the clean text need
    not be made first.
    """
    lowered = F.lower(F.coalesce(without_comments(code), F.lit("")))
    return F.array_remove(F.split(lowered, f"[^{WORD_CLASS}]+"), "")


def brace_depth(code: Column) -> Column:
    """Deepest nesting of braces; a closing brace never goes below zero."""
    braces = F.split(F.regexp_replace(F.coalesce(code, F.lit("")), r"[^{}]+", ""), "")
    zero = F.lit(0)
    start = F.struct(zero.alias("depth"), zero.alias("deepest"))

    def step(state: Column, brace: Column) -> Column:
        depth = (
            F.when(brace == "{", state["depth"] + 1)
            .when(brace == "}", F.greatest(zero, state["depth"] - 1))
            .otherwise(state["depth"])
        )
        return F.struct(
            depth.alias("depth"), F.greatest(state["deepest"], depth).alias("deepest")
        )

    return F.aggregate(braces, start, step, lambda state: state["deepest"])


def normalize_newlines(text: Column) -> Column:
    """Turn ``\\r\\n`` and a lone ``\\r`` into ``\\n``."""
    return F.regexp_replace(text, "\r\n?", "\n")


def decode_dropping(content: Column) -> Column:
    """Bytes as UTF-8, leaving out what is not valid (mining)."""
    raw = content.cast("string")
    # A replacement character that is really in the file must stay.
    stashed = F.replace(raw, F.lit(_REPLACEMENT), F.lit(_STASHED_REPLACEMENT))
    dropped = F.replace(F.make_valid_utf8(stashed), F.lit(_REPLACEMENT), F.lit(""))
    restored = F.replace(dropped, F.lit(_STASHED_REPLACEMENT), F.lit(_REPLACEMENT))
    return F.when(F.is_valid_utf8(raw), raw).otherwise(restored)


def decode_fallback(content: Column) -> Column:
    """Bytes as UTF-8, or as Latin-1 when they are not valid UTF-8 (scanning)."""
    return F.coalesce(
        F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1")
    )


def extension(path: Column) -> Column:
    """File extension with its dot, '' if there is none.

    A leading dot of the file name does not start an extension.
    """
    return F.regexp_extract(path, r"[^./][^/]*?(\.[^./]*)$", 1)


def repository_name(url: Column) -> Column:
    """Last segment of a repository URL without ``.git``."""
    return F.replace(F.element_at(F.split(url, "/"), -1), F.lit(".git"), F.lit(""))


def truthy(value: Column) -> Column:
    """1 for the texts that mean "vulnerable", else 0."""
    text = F.lower(value.cast("string"))
    return F.when(text.isin(*fixed.TRUTHY_TEXTS), 1).otherwise(0)


def status(prediction: Column) -> Column:
    return F.when(prediction == 1, "VULNERABLE").otherwise("SAFE")


def two_decimals(value: Column) -> Column:
    """A number with two decimals; exact halves go to the even digit.

    The double is rounded by its exact binary value: single and rest precision
    parts times 100 are both exact, so a near half is never taken for a half.
    """
    size = F.abs(value.cast("double"))
    high = size.cast("float").cast("double")
    scaled, rest = high * 100, (size - high) * 100
    whole = F.floor(scaled + rest)
    over = scaled - whole - 0.5
    up = (over > -rest) | ((over == -rest) & (whole % 2 == 1))
    digits = whole + up.cast("long")
    sign = F.when(value < 0, "-").otherwise("")
    return F.format_string(
        "%s%d.%02d", sign, F.floor(digits / 100), F.pmod(digits, F.lit(100)))


def percent(value: Column) -> Column:
    return F.concat(two_decimals(value.cast("double") * 100), F.lit("%"))


def message(status_text: Column, confidence: Column) -> Column:
    return F.format_string("File is %s with %s confidence.", status_text, two_decimals(confidence))


def timestamp_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def clip(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def perturbed(score: Column, seed: int = fixed.SEED,
              sd: float = fixed.PERTURBATION_SD) -> Column:
    """A score with Gaussian noise, clipped to [0, 1] (drift rehearsal)."""
    return clip(score + sd * F.randn(seed))


def is_critical(severity: Column) -> Column:
    return severity.isin("Critical", "High")


def or_not_available(value: Column) -> Column:
    return F.coalesce(value, F.lit(fixed.NOT_AVAILABLE))
