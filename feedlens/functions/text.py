"""String functions with JVM ``String`` semantics, as built-in Column expressions.

All of these stay inside whole-stage codegen: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens.config import WHITESPACE_RE


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Java ``String.trim`` strips every char from U+0000 to U+0020 (a rule, not a list).
_JAVA_TRIM_CHARS = "".join(chr(c) for c in range(0x21))


def java_trim(col: Column | str) -> Column:
    """``String.trim``: strip chars <= U+0020 at both ends.

    Spark's one-argument ``trim`` strips spaces only; the two-argument form
    with the explicit character set is exact and scans only the two ends
    (no regex over the whole text).
    """
    return F.trim(_c(col), F.lit(_JAVA_TRIM_CHARS))


def has_visible_char(col: Column | str) -> Column:
    """``java_trim(x) <> ''`` without building the trimmed copy: some char > U+0020."""
    return _c(col).rlike(r"[^\x00-\x20]")


def java_lower(col: Column | str) -> Column:
    """``String.toLowerCase``; Spark's ``lower`` uses the same full JVM case mapping."""
    return F.lower(_c(col))


def whitespace_split(col: Column | str) -> Column:
    """``split("\\s+")`` with Java's ``\\s`` class; may hold empty strings at the ends."""
    return F.split(_c(col), WHITESPACE_RE)


def word_set(col: Column | str) -> Column:
    """Distinct lowercase whitespace tokens of one field (punctuation kept)."""
    return F.array_distinct(whitespace_split(java_lower(col)))


def tokens(col: Column | str) -> Column:
    """Non-empty lowercase whitespace tokens, in order, with repeats."""
    return F.array_remove(whitespace_split(java_lower(col)), "")


def utf16_length(col: Column | str) -> Column:
    """``String.length``: UTF-16 code units (a supplementary char counts 2)."""
    return (F.octet_length(F.encode(_c(col), "UTF-16BE")) / 2).cast("bigint")


def non_empty(col: Column | str) -> Column:
    """``nonEmpty``; NULL is not kept (the reference has no null guard)."""
    return _c(col) != F.lit("")


def first_line(col: Column | str) -> Column:
    """Text before the first LF (whole text when there is none)."""
    return F.substring_index(_c(col), "\n", 1)


def after_first_line(col: Column | str) -> Column:
    """Text after the first LF; empty when there is none."""
    c = _c(col)
    pos = F.instr(c, "\n")
    return F.when(pos > 0, c.substr(pos + 1, F.length(c))).otherwise(F.lit(""))
