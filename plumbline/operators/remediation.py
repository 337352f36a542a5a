"""Remediation: carrying out suggestions, capping and grouping extremes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import DEFAULTS, Thresholds
from plumbline.functions.text import ref, strip
from plumbline.operators.anomaly import rare_categories
from plumbline.operators.cells import measure, number_of
from plumbline.operators.changes import Fixed
from plumbline.operators.counted import of_columns, total, weighted
from plumbline.operators.duplicates import drop_duplicate_rows
from plumbline.operators.quantiles import exact_quantiles
from plumbline.operators.schema_fixes import rename_snake_case
from plumbline.operators.scoring import DEDUPLICATE, PRESERVE, SNAKE_CASE, TRIM
from plumbline.session import cut


def trim_text(df: DataFrame) -> DataFrame:
    """Outer white space removed from text columns; nulls stay null."""
    text = {n for n, k in df.dtypes if k == "string"}
    return df.select(*[strip(ref(c)).alias(c) if c in text else ref(c) for c in df.columns])


def apply_suggestions(
    df: DataFrame, suggested: DataFrame, t: Thresholds = DEFAULTS, counted: DataFrame | None = None
) -> tuple[Fixed, DataFrame]:
    """Apply suggestions marked ``auto_apply`` in order; the others come back as the list to review. ``counted`` are the
    ``counted_cells`` of the table."""
    fixed = Fixed(df, "remediation")
    for row in sorted(suggested.filter("auto_apply").collect(), key=lambda r: r["place"]):  # at most one per rule
        action = row["action"]
        if action == TRIM:
            text = [n for n, k in fixed.df.dtypes if k == "string"]
            if counted is not None and fixed.df is df:
                value = F.col("value")
                read = weighted(of_columns(counted, text), {"padded": total(value != strip(value))})
                m = {c: read[c]["padded"] if c in read else 0 for c in text}
            else:
                m = measure(fixed.df, {c: F.count_if(ref(c) != strip(ref(c))) for c in text})
            for c in text:
                fixed.note("trim", c, m[c])
            fixed.df, fixed.stored = trim_text(fixed.df), False
        elif action == SNAKE_CASE:
            before = fixed.df.columns
            fixed.df = rename_snake_case(fixed.df)  # as stored as it was
            for old, new in zip(before, fixed.df.columns):
                fixed.note("rename_column", old, int(old != new))
        elif action == DEDUPLICATE:
            before = measure(fixed.df, {"n": F.count(F.lit(1))})["n"]
            fixed.df, fixed.stored = cut(drop_duplicate_rows(fixed.df)), True
            fixed.rows_removed = before - fixed.df.count()
            fixed.note("drop_duplicate_rows", "ALL", fixed.rows_removed)
        elif action == PRESERVE:
            fixed.note("keep_missing", "ALL", 1)
        else:
            fixed.note("unsupported_action", action, 1)
    return fixed, suggested.filter("NOT auto_apply")


def cap_at_percentile(df: DataFrame, columns: Sequence[str], p: float = 0.99, t: Thresholds = DEFAULTS) -> DataFrame:
    """Documented variant: numbers above a percentile are lowered to it; missing cells stay missing."""
    values = {c: number_of(df, c) for c in columns}
    limits = exact_quantiles(df, values, [p], t=t)
    return df.withColumns({c: F.when(values[c] > q[0], q[0]).otherwise(values[c]) for c, q in limits.items()})


def group_rare(df: DataFrame, columns: Sequence[str] | None = None, word: str = "Other", t: Thresholds = DEFAULTS) -> DataFrame:
    """Documented variant: rare values of categorical columns become one word.

    A categorical column has at most ``rare_max_distinct`` values, so its rare ones fit in an ``IN`` list.
    """
    rare: dict[str, list[str]] = {}
    for r in rare_categories(df, t).filter(F.col("value").isNotNull()).collect():
        if columns is None or r["column"] in columns:
            rare.setdefault(r["column"], []).append(r["value"])
    return df.withColumns({c: F.when(ref(c).isin(*vs), word).otherwise(ref(c)) for c, vs in rare.items()}) if rare else df


