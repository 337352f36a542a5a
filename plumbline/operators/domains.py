"""Value counts of columns with few distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame

from plumbline.config import DEFAULTS, Thresholds
from plumbline.operators.cells import empty
from plumbline.operators.counted import counts_of
from plumbline.operators.scan import Scan, scan


def domain_counts(
    df: DataFrame, cap: int, t: Thresholds = DEFAULTS, seen: Scan | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """(column, value, cnt), nulls included, of columns that may have at most ``cap`` distinct values.

    A sketch rules out columns estimated far above the cap, which would flood the value counts; whoever asks still
    compares the exact count with the cap. What is left is small: at most a few times ``cap`` rows per column. ``counted``
    are the ``counted_cells`` of the table.
    """
    seen = seen or scan(df, ("about_distinct",))
    columns = [c for c in seen.columns if seen.of(c, "about_distinct") <= cap * t.domain_slack]
    return counts_of(df, columns, counted) if columns else empty(df, "`column` string, value string, cnt bigint")
