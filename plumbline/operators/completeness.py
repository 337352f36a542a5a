"""Missing cells: per column, per row, and the patterns they form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DEFAULTS, Thresholds
from plumbline.functions.numbers import pct, rounded, share
from plumbline.functions.text import any_of, is_missing, is_placeholder, ref
from plumbline.operators.cells import columns_of, per_column, small_frame
from plumbline.operators.counted import of_columns, total, weighted
from plumbline.sources.tables import text_layer


def missing_counts(
    df: DataFrame, columns: Sequence[str] | None = None, placeholders: bool = True, counted: DataFrame | None = None
) -> DataFrame:
    """(column, ordinal, row_count, null_count) of every column; placeholder cells count as null if asked. ``counted`` are
    the ``counted_cells`` of the table."""
    columns = columns_of(df, columns)
    test = is_missing if placeholders else (lambda c: c.isNull())
    if counted is not None:
        figures = weighted(of_columns(counted, columns), {"row_count": F.sum("cnt"), "null_count": total(test(F.col("value")))})
        rows = [(c, i, *(figures[c].values() if c in figures else (0, 0))) for i, c in enumerate(columns)]
        return small_frame(df, rows, "`column` string, ordinal int, row_count bigint, null_count bigint")
    return per_column(
        text_layer(df.select(*[ref(c) for c in columns])),
        columns,
        {"row_count": lambda c: F.count(F.lit(1)), "null_count": lambda c: F.count_if(test(ref(c)))},
    )


def missing_by_column(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Columns with missing cells, with count and percentage. ``counts`` are the ``missing_counts``, here and below."""
    return (missing_counts(df) if counts is None else counts).filter("null_count > 0").withColumn("null_pct", pct(F.col("null_count"), F.col("row_count")))


def missing_split(df: DataFrame) -> DataFrame:
    """True nulls and placeholder cells apart, and both together."""
    columns = columns_of(df, None)
    counted = per_column(
        text_layer(df),
        columns,
        {
            "row_count": lambda c: F.count(F.lit(1)),
            "true_nulls": lambda c: F.count_if(ref(c).isNull()),
            "placeholders": lambda c: F.count_if(is_placeholder(ref(c))),
        },
    )
    return counted.withColumn("combined_pct", pct(F.col("true_nulls") + F.col("placeholders"), F.col("row_count")))


def rows_with_missing(df: DataFrame) -> DataFrame:
    """One row: number of rows, rows with a missing cell, and their percentage."""
    layer = text_layer(df)
    missing = any_of([is_missing(ref(c)) for c in layer.columns])
    return layer.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(missing).alias("rows_with_any_null")
    ).withColumn("rows_pct", pct(F.col("rows_with_any_null"), F.col("total_rows")))


def completeness_by_column(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Percentage of present cells per column; null for an empty table."""
    complete = (F.lit(1.0) - share(F.col("null_count"), F.col("row_count"))) * 100
    return (missing_counts(df) if counts is None else counts).withColumn("completeness_pct", rounded(complete, 2))


def completeness_overall(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """One row: mean of the rounded column rates, cell-level rate, and the class of the former."""
    return (
        completeness_by_column(df, counts)
        .agg(
            rounded(F.avg("completeness_pct"), 2).alias("overall_completeness_pct"),
            rounded((F.lit(1.0) - share(F.sum("null_count"), F.sum("row_count"))) * 100, 2).alias("cell_completeness_pct"),
        )
        .withColumn("completeness_class", completeness_class(F.col("overall_completeness_pct")))
    )


def completeness_class(rate: Column) -> Column:
    return (
        F.when(rate >= 95, "EXCELLENT").when(rate >= 80, "GOOD").when(rate >= 60, "MODERATE").when(rate < 60, "POOR")
    )


def missing_band(rate: Column) -> Column:
    """Band of a column's missing percentage."""
    return F.when(rate >= 95, ">=95").when(rate >= 50, "50-95").when(rate >= 5, "5-50").when(rate < 5, "<5")


def severity_from(rate: Column) -> Column:
    """Severity where the lower edge belongs to the worse class."""
    return F.when(rate >= 95, "CRITICAL").when(rate >= 20, "HIGH").when(rate >= 5, "MODERATE").when(rate < 5, "LOW")


def severity_above(rate: Column) -> Column:
    """Severity where CRITICAL starts above 95 and 95 itself is HIGH."""
    return F.when(rate > 95, "CRITICAL").when(rate >= 20, "HIGH").when(rate >= 5, "MODERATE").when(rate < 5, "LOW")


def missing_severity(df: DataFrame, placeholders: bool = True) -> DataFrame:
    """Every column with its missing percentage and both severities, worst first."""
    rate = F.col("null_pct")
    return (
        missing_counts(df, placeholders=placeholders)
        .withColumn("null_pct", pct(F.col("null_count"), F.col("row_count")))
        .withColumn("completeness_pct", rounded(F.lit(100.0) - rate, 2))
        .withColumn("severity", severity_from(rate))
        .withColumn("severity_strict", severity_above(rate))
        .withColumn("band", missing_band(rate))
        .orderBy(F.desc("null_pct"), "ordinal")
    )


def sparse_columns(df: DataFrame, t: Thresholds = DEFAULTS, counts: DataFrame | None = None) -> DataFrame:
    """Columns whose missing share exceeds the threshold, and what to do with them."""
    missing = share(F.col("null_count"), F.col("row_count"))
    return (
        (missing_counts(df) if counts is None else counts)
        .filter(missing > t.sparse)
        .withColumn("missing_pct", rounded(missing * 100, 2))
        .withColumn("bucket", F.when(missing > t.ultra_sparse, "removal candidate").otherwise("high sparsity"))
    )


def co_missing(df: DataFrame) -> DataFrame:
    """Rows by the set of columns missing in them.

    The pattern text is built per row and counted with partial aggregation, so what is shuffled is the number of
    patterns and not of rows.
    """
    layer = text_layer(df)
    pattern = F.concat_ws(",", *[F.when(is_missing(ref(c)), c) for c in layer.columns])
    return layer.select(pattern.alias("missing_columns")).groupBy("missing_columns").agg(F.count(F.lit(1)).alias("rows"))


def missing_indicators(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_is_missing`` (1 or 0) per column."""
    return df.withColumns({f"{c}_is_missing": ref(c).isNull().cast("int") for c in columns})
