"""Text expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.config import CURRENCY_MARKS, PLACEHOLDER_WORDS, PLACEHOLDERS

# Characters removed from both ends of a cell: every Unicode white space and the four ASCII separators.
WHITESPACE = "".join(
    chr(c)
    for c in (
        0x20, *range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)


def ref(name: str) -> Column:
    """Column by exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def fold(c: Column) -> Column:
    """Key under which spellings that differ by case or outer blanks meet."""
    return F.lower(strip(c))


def is_placeholder(c: Column, words: Iterable[str] = PLACEHOLDERS) -> Column:
    return c.isin(*words)


def is_missing(c: Column) -> Column:
    return c.isNull() | is_placeholder(c)


def null_placeholders(c: Column, trimmed: bool = False) -> Column:
    return F.when(~is_placeholder(strip(c) if trimmed else c), c)


def null_placeholder_words(c: Column) -> Column:
    return F.when(~fold(c).isin(*PLACEHOLDER_WORDS), c)


def drop_currency(c: Column, marks: Sequence[str] = CURRENCY_MARKS) -> Column:
    pattern = "|".join(re.escape(m) for m in marks)
    return strip(F.regexp_replace(c, pattern, ""))


def drop_separators(c: Column, signs: str = "€$£") -> Column:
    """Currency signs, commas and all white space removed (commas are not read as decimal points)."""
    return F.regexp_replace(c, rf"[{signs},\s]", "")


def any_of(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out
