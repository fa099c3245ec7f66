"""Unix name patterns as Spark predicates.

``*`` any text, ``?`` one character, ``[seq]`` / ``[!seq]`` character sets. Patterns without a
wildcard, and plain prefixes, become comparisons that Parquet scans can push down.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\[!?\]?[^\]]*\]|.", re.DOTALL)


def _char_set(token: str) -> str:
    body, negate = token[1:-1], ""
    if body.startswith("!"):
        body, negate = body[1:], "^"
    return "[" + negate + re.sub(r"([\\\[\]&^~])", r"\\\1", body) + "]"


def _translate(pattern: str, any_run: str, any_one: str) -> str:
    out = []
    for token in _TOKEN.findall(pattern):
        if token == "*":
            out.append(any_run)
        elif token == "?":
            out.append(any_one)
        elif len(token) > 1:
            out.append(_char_set(token))
        else:
            out.append(re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", token))
    return "".join(out)


def has_wildcard(pattern: str) -> bool:
    return any(c in pattern for c in "*?[")


def name_regex(pattern: str) -> str:
    """Regex for a name pattern; wildcards match every character."""
    return r"(?s)\A" + _translate(pattern, ".*", ".") + r"\z"


def path_regex(pattern: str) -> str:
    """Regex for a path pattern: wildcards stay within one segment and skip hidden segments."""
    segments = []
    for segment in pattern.split("/"):
        guard = r"(?!\.)" if has_wildcard(segment) and not segment.startswith(".") else ""
        segments.append(guard + _translate(segment, "[^/]*", "[^/]"))
    return r"(?s)\A" + "/".join(segments) + r"\z"


def matches_any(name: Column, patterns: Iterable[str]) -> Column:
    """True where ``name`` matches at least one name pattern."""
    plain, tests = [], []
    for pattern in patterns:
        if not has_wildcard(pattern):
            plain.append(pattern)
        elif pattern == "*":
            tests.append(name.isNotNull())
        elif pattern.endswith("*") and not has_wildcard(pattern[:-1]):
            tests.append(name.startswith(pattern[:-1]))
        else:
            tests.append(name.rlike(name_regex(pattern)))
    if plain:
        tests.insert(0, name.isin(plain))
    return reduce(or_, tests) if tests else F.lit(False)


def path_matches(path: Column, pattern: str) -> Column:
    """True where ``path`` matches one path pattern."""
    if not has_wildcard(pattern):
        return path == F.lit(pattern)
    return path.rlike(path_regex(pattern))
