"""Rule patterns are written once and spelled for each regular-expression engine.

The written form follows Unicode text matching: ``\\w`` is any letter, digit or
underscore of any script, ``.`` stops at a newline only, and ``(?i)`` folds case
for all scripts. Java (Spark) and RE2 (the SQL used in tests) need their own
spelling of that.
"""

from __future__ import annotations

import re
from re import _constants, _parser

from codesift.functions.text import SPACE_CLASS, WORD_CLASS

_WORD_EDGE = f"(?:(?<=[{WORD_CLASS}])(?![{WORD_CLASS}])|(?<![{WORD_CLASS}])(?=[{WORD_CLASS}]))"
_SHORTHANDS = {
    "w": WORD_CLASS, "s": SPACE_CLASS, "d": r"\p{Nd}",
}
_PLAIN = re.compile(r"(?:\\[^\w\s]|[^\\.^$*+?{}\[\]|()])+")


def literal_text(pattern: str) -> str | None:
    """The one text a pattern stands for, or None if it is a real pattern."""
    if _PLAIN.fullmatch(pattern):
        return re.sub(r"\\(.)", r"\1", pattern)
    return None


def needed_text(pattern: str) -> str | None:
    """The longest text that every match of a pattern holds, of equal ones the last, if any.

    Only what stands in a row at the top of the pattern counts: not what may be absent,
    repeats or has alternatives. Under ``(?i)`` letters may differ in case and are left out.
    """
    parsed = _parser.parse(pattern)
    folds = bool(parsed.state.flags & re.IGNORECASE)
    best = run = ""
    for kind, value in parsed:
        fixed = kind is _constants.LITERAL and not (folds and chr(value).isalpha())
        one_of = kind is _constants.IN and len(value) == 1 and value[0][0] is _constants.LITERAL
        if fixed:
            run += chr(value)
        elif one_of and not (folds and chr(value[0][1]).isalpha()):
            run += chr(value[0][1])
        else:
            run = ""
        best = run if len(run) >= len(best) and run else best
    return best or None


def _spelled(pattern: str, java: bool) -> str:
    out, in_class, i = [], False, 0
    while i < len(pattern):
        char = pattern[i]
        if char == "\\" and i + 1 < len(pattern):
            code = pattern[i + 1]
            if code in _SHORTHANDS:
                out.append(_SHORTHANDS[code] if in_class else f"[{_SHORTHANDS[code]}]")
            elif code in "WSD" and not in_class:
                out.append(f"[^{_SHORTHANDS[code.lower()]}]")
            elif code == "b" and not in_class and java:
                out.append(_WORD_EDGE)
            else:
                out.append(char + code)
            i += 2
            continue
        if char == "[" and in_class and java:
            out.append(r"\[")
        else:
            out.append(char)
        if char == "[" and not in_class:
            in_class = True
            for first in ("^", "]"):
                if pattern[i + 1 : i + 2] == first:
                    out.append(first if first == "^" else r"\]")
                    i += 1
        elif char == "]":
            in_class = False
        i += 1
    return "".join(out)


def java_pattern(pattern: str) -> str:
    folds = pattern.startswith("(?i)")
    body = _spelled(pattern[4:] if folds else pattern, java=True)
    return ("(?diu)" if folds else "(?d)") + body


def re2_pattern(pattern: str) -> str:
    return _spelled(pattern, java=False)
