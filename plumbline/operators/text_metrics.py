"""Figures read out of free text: findings written as prose, scores, report lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import any_of, strip

# Results depend on these exact patterns and prefixes.
DUPLICATE_PATTERNS = (r"Removed\s+(\d+)\s+exact duplicate row", r"(\d+)\s+exact duplicates")
OUTLIER_PATTERNS = (r"(\d+)\s+IQR outliers", r"(\d+)\s+outliers")
MISSING_PATTERN = r"(\d+(?:\.\d+)?)%\s+missing"
NAMING_WORDS = r"snake_case|uppercase|hyphen|naming"
CROSS_WORDS = r"cross-column mismatch|inconsistent with"
SCORE_PATTERNS = (
    r"(?:score|punteggio)[^\d]*(\d{1,3}(?:\.\d+)?)\s*/\s*100",
    r"\b(\d{1,3}(?:\.\d+)?)\s*/\s*100\b",
)
GRADE_PATTERN = r"\bgrade[:\s]+([A-F][+-]?)\b"
TECHNICAL_PREFIXES = (
    "[schema team]",
    "[completeness team]",
    "[consistency team]",
    "[anomaly team]",
    "[remediation team]",
    "fixes applied:",
    "fixed csv:",
    "final cleaned dataset:",
)


def _numbers(text: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(text, F.lit("(?i)" + pattern), F.lit(1))
    return F.filter(F.transform(found, lambda m: m.try_cast("double")), lambda x: x.isNotNull())


def captured_sum(text: Column, patterns: Sequence[str]) -> Column:
    """Sum of the whole parts of all numbers the patterns capture, over the whole text; null beyond 64 bits."""
    total = F.lit(0).cast("long")
    for pattern in patterns:
        captured = F.aggregate(
            _numbers(text, pattern), F.lit(0).cast("long"), lambda acc, x: F.try_add(acc, x.try_cast("long"))
        )
        total = F.try_add(total, captured)
    return total


def captured_mean(text: Column, pattern: str) -> Column:
    """Mean of the captured numbers, null without any."""
    found = _numbers(text, pattern)
    return F.try_divide(F.aggregate(found, F.lit(0.0), lambda acc, x: acc + x), F.size(found).cast("double"))


def hits(text: Column, words: str) -> Column:
    return F.regexp_count(text, F.lit("(?i)" + words))


def text_figures(df: DataFrame, column: str) -> DataFrame:
    """The table with the figures a findings text states about missing cells, duplicates, outliers and names."""
    text = F.col(column)
    return df.withColumns(
        {
            "duplicate_rows": captured_sum(text, DUPLICATE_PATTERNS),
            "outliers": captured_sum(text, OUTLIER_PATTERNS),
            "missing_pct": captured_mean(text, MISSING_PATTERN),
            "naming_hits": hits(text, NAMING_WORDS),
            "cross_column": hits(text, CROSS_WORDS) > 0,
        }
    )


def stated_score(text: Column) -> Column:
    """Score a text gives out of 100, as written; empty if none. A labelled score is preferred."""
    labelled = F.regexp_extract(text, "(?i)" + SCORE_PATTERNS[0], 1)
    return F.when(labelled != "", labelled).otherwise(F.regexp_extract(text, SCORE_PATTERNS[1], 1))


def stated_grade(text: Column) -> Column:
    return F.regexp_extract(text, "(?i)" + GRADE_PATTERN, 1)


def without_lines(text: Column, prefixes: Sequence[str] = TECHNICAL_PREFIXES) -> Column:
    """Text without the lines that start with a prefix (case and indentation ignored), trimmed."""
    lines = F.split(text, r"\r\n|\n|\r", -1)
    kept = F.filter(lines, lambda line: ~any_of([strip(F.lower(line)).startswith(p) for p in prefixes]))
    return strip(F.array_join(kept, "\n"))
