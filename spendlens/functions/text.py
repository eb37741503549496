"""Text helpers: clean-up chains and pattern tests on columns."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv

_LEADING_LITERAL = re.compile(r"(?:\\b)?([a-z0-9&/ ]+)")
_PLAIN = re.compile(r"[a-z0-9ก-๙&/ -]+")


# A clean-up step that leaves a text without uneven white space as it is, and what it would change.
_SPACES, _UNEVEN = (r"\s+", " "), r"\s\s|[^\S ]"


def clean_text(col: Column) -> Column:
    """Merchant descriptor in lower case without noise, outlet words, place
    tails and long numbers. NULL becomes ''. Many texts have nothing to replace: one test
    for all patterns together finds them, where each replacement costs a good part of it."""
    text = F.lower(F.trim(F.coalesce(col, F.lit(""))))
    changed = any_of([f"(?:{_UNEVEN if step == _SPACES else step[0]})" for step in dict.fromkeys(fv.CLEANUP_STEPS)])
    replaced = text
    for pattern, replacement in fv.CLEANUP_STEPS:
        replaced = F.regexp_replace(replaced, pattern, replacement)
    return F.when(text.rlike(changed), F.trim(replaced)).otherwise(text)


def clean_text_basic(col: Column) -> Column:
    """Lower case, keep letters (Latin and Thai), digits and a few signs."""
    text = F.lower(F.coalesce(col, F.lit("")))
    for pattern, replacement in fv.BASIC_CLEANUP_STEPS:
        text = F.regexp_replace(text, pattern, replacement)
    return F.trim(text)


def any_of(patterns: list[str]) -> str:
    """One alternation out of a pattern list."""
    return "|".join(patterns)


def alternatives(pattern: str) -> list[str] | None:
    """Split a pattern on the bars that are outside any bracket. A pattern that
    is one plain group is opened first. None if the pattern uses something this
    does not follow: inline flags, quoting, nested classes or open brackets."""
    if re.search(r"\\[QE]|\(\?[a-zA-Z]*[)-]|\(\?[a-zA-Z]+:", pattern):
        return None
    inner = re.fullmatch(r"\(((?:[^()?\\\[]|\\.)(?:[^()\\\[]|\\.)*)\)", pattern)
    if inner:
        pattern = inner.group(1)
    parts, depth, in_class, start, i = [], 0, False, 0, 0
    while i < len(pattern):
        char = pattern[i]
        if char == "\\":
            i += 2
            continue
        if in_class:
            if char == "[":
                return None
            # A bracket right after the opening one is a plain character.
            in_class = char != "]" or pattern[i - 1] == "[" or pattern[i - 2:i] == "[^"
        elif char == "[":
            in_class = True
        elif char == "(":
            depth += 1
        elif char == ")":
            depth -= 1
        elif char == "|" and depth == 0:
            parts.append(pattern[start:i])
            start = i + 1
        i += 1
    return None if in_class or depth else parts + [pattern[start:]]


def _required_literal(alternative: str) -> str:
    """Text that a match of this alternative has to start with ('' if unknown)."""
    found = _LEADING_LITERAL.match(alternative)
    if not found:
        return ""
    literal = found.group(1)
    follows = alternative[found.end():found.end() + 1]
    return literal[:-1] if follows and follows in "?*+{" else literal


def _skip_class(pattern: str, i: int) -> int:
    """The place after the character class that opens at ``i``."""
    i += 2 if pattern[i + 1:i + 2] == "^" else 1
    i += pattern[i:i + 1] == "]"
    while i < len(pattern) and pattern[i] != "]":
        i += 2 if pattern[i] == "\\" else 1
    return i + 1


def _skip_group(pattern: str, i: int) -> int:
    """The place after the group that opens at ``i``."""
    depth = 0
    while i < len(pattern):
        if pattern[i] == "[":
            i = _skip_class(pattern, i)
            continue
        depth += (pattern[i] == "(") - (pattern[i] == ")")
        i += 2 if pattern[i] == "\\" else 1
        if depth == 0:
            break
    return i


def longest_literal(alternative: str) -> str:
    """The longest run of plain characters that every match of the alternative holds; ''
    if there is none or the alternative uses an escape that this does not know."""
    runs, run, i = [], "", 0
    while i < len(alternative):
        char = alternative[i]
        if char == "\\":
            char = alternative[i + 1:i + 2]
            i += 2
            if char.isalnum():
                if char not in "sSdDwWbB":
                    return ""
                runs.append(run)
                run = ""
                continue
        elif char in "[(":
            i = _skip_class(alternative, i) if char == "[" else _skip_group(alternative, i)
            runs.append(run)
            run = ""
            continue
        elif char in ".^$?*+{":
            # A quantifier may take the character before it away; one or more leaves it.
            runs.append(run if char in ".^$+" else run[:-1])
            run = ""
            i = alternative.find("}", i) + 1 if char == "{" and "}" in alternative[i:] else i + 1
            continue
        else:
            i += 1
        run += char
    return max([*runs, run], key=len)


def required_literals(pattern: str) -> list[str]:
    """One literal for each alternative: a text that matches holds one of them. [''] if
    nothing is known."""
    parts = alternatives(pattern)
    found = [longest_literal(part) for part in parts or [""]]
    return found if all(found) else [""]


def _tests(named: list[tuple[str, str]]) -> Column:
    """Constant array of (name, guard, regex): a text passes an entry if it holds
    the guard and, where a regex is left to test, matches it. A pattern that could
    not be split has no guard."""
    entries = []
    for name, pattern in named:
        parts = alternatives(pattern)
        if parts is None:
            entries.append({"name": name, "guard": "", "regex": pattern})
            continue
        for part in parts:
            if _PLAIN.fullmatch(part):
                entries.append({"name": name, "guard": part, "regex": None})
            else:
                entries.append({"name": name, "guard": _required_literal(part), "regex": part})
    return constant(entries, "array<struct<name:string,guard:string,regex:string>>")


def constant(value, ddl: str) -> Column:
    """A nested constant as one expression; Spark folds it before execution."""
    return F.from_json(F.lit(json.dumps(value)), ddl)


def matching(text: str, named: list[tuple[str, str]]) -> Column:
    """Names of all patterns that the text matches (``rlike``), in list order.

    Substring search costs a fraction of a regex search, and a text matches very
    few of the patterns. So plain words are tested with ``contains`` alone, and a
    regex runs only after the literal it has to start with was found. Patterns
    are data, not expressions, so hundreds of them still plan like one.
    """
    passed = F.filter(_tests(named), lambda test: F.contains(F.col(text), test["guard"]) & (
        test["regex"].isNull() | F.rlike(F.col(text), test["regex"])))
    return F.array_distinct(F.transform(passed, lambda test: test["name"]))
