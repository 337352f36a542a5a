"""Cells with their counts: small domains value by value, everything else cell by cell."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DEFAULTS, Thresholds
from plumbline.operators.cells import cells, columns_of, empty, value_counts
from plumbline.operators.scan import Scan, counted_columns, scan
from plumbline.session import cut


def one_by_one(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, cnt) with a row per cell."""
    return cells(df, columns).withColumn("cnt", F.lit(1).cast("long"))


def counted_cells(df: DataFrame, columns: Sequence[str] | None = None, t: Thresholds = DEFAULTS, seen: Scan | None = None) -> DataFrame:
    """(column, value, cnt): rows that add up to the cells of the columns, nulls included.

    Values of columns of at most about ``counted_values`` different ones are counted and stored, so whatever is read off a
    value is read once for each. The cells of all other columns come as they are, a row each, and move nowhere. The sketch
    that tells them apart changes the number of rows, never their sum. ``counted_columns`` tells which are counted."""
    columns = columns_of(df, columns)
    if not columns:
        return empty(df, "`column` string, value string, cnt bigint")
    seen = seen or scan(df, ("about_distinct",), columns)
    small = [c for c in columns if seen.of(c, "about_distinct") <= t.counted_values]
    large = [c for c in columns if c not in set(small)]
    parts = ([cut(value_counts(df, small))] if small else []) + ([one_by_one(df, large)] if large else [])
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    out.counted_columns = frozenset(small)
    return out


def of_columns(counted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The counted cells of some columns."""
    return counted.where(F.col("column").isin(list(columns)))


def counts_of(df: DataFrame, columns: Sequence[str], counted: DataFrame | None = None) -> DataFrame:
    """The ``value_counts`` of the columns, taken from the ``counted_cells`` of the table where these have them."""
    known = counted_columns(counted)
    have, rest = [c for c in columns if c in known], [c for c in columns if c not in known]
    if not have:
        return value_counts(df, rest)
    out = of_columns(counted, have).select("column", "value", "cnt")
    return out.unionByName(value_counts(df, rest)) if rest else out


def weighted(cells: DataFrame, figures: Mapping[str, Column]) -> dict[str, dict[str, Any]]:
    """Figures by column over counted cells, read to the driver: one row per column."""
    rows = cells.groupBy("column").agg(*[f.alias(n) for n, f in figures.items()]).collect()
    return {r["column"]: {n: r[n] for n in figures} for r in rows}


def total(condition: Column) -> Column:
    """Number of cells that meet a condition."""
    return F.coalesce(F.sum(F.when(condition, F.col("cnt"))), F.lit(0))
