"""All checks of a table in one long findings frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DEFAULTS, Thresholds
from plumbline.operators import anomaly, completeness, consistency, duplicates, schema
from plumbline.operators.counted import counted_cells
from plumbline.operators.domains import domain_counts
from plumbline.operators.scan import PERIOD_FIGURES, scan
from plumbline.session import cut


def _long(
    check: str,
    df: DataFrame,
    metric: str,
    column: Column | None = None,
    column_b: Column | None = None,
    severity: Column | None = None,
    examples: Column | None = None,
) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select(
        F.lit(check).alias("check"),
        (column if column is not None else F.col("column")).alias("column"),
        (column_b if column_b is not None else none).alias("column_b"),
        F.lit(metric).alias("metric"),
        F.col(metric).cast("double").alias("value"),
        (severity if severity is not None else none).alias("severity"),
        (examples if examples is not None else F.lit(None)).cast("array<string>").alias("examples"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    """One job for all checks of a stage, kept in reliable storage: a few rows per column."""
    return cut(reduce(DataFrame.unionByName, parts))


def schema_findings(df: DataFrame, t: Thresholds = DEFAULTS, counted: DataFrame | None = None) -> DataFrame:
    """Types, names and repeated columns. ``counted`` are the ``counted_cells`` of the table, here and below."""
    counted = counted_cells(df, t=t) if counted is None else counted
    parts = [
        _long("type_contamination", schema.type_contamination(df, t, counted=counted), "bad_count", severity=F.col("severity"), examples=F.col("examples")),
        _long("date_contamination", schema.date_contamination(df, t, counted=counted), "bad_count", severity=F.col("severity"), examples=F.col("examples")),
        _long("naming", schema.naming_violations(df), "cells", examples=F.array("issue")),
        _long("duplicate_columns", schema.duplicate_columns(df, t, counted), "jaccard", column_b=F.col("column_b")),
    ]
    return _union(parts)


def completeness_findings(df: DataFrame, t: Thresholds = DEFAULTS, counted: DataFrame | None = None) -> DataFrame:
    """Missing cells per column and row, and the overall rate."""
    counts = completeness.missing_counts(df, counted=counted_cells(df, t=t) if counted is None else counted)  # one row per column
    missing = completeness.missing_by_column(df, counts)
    parts = [
        _long("missing", missing, "null_pct", severity=completeness.severity_from(F.col("null_pct"))),
        _long("rows_with_missing", completeness.rows_with_missing(df), "rows_with_any_null", column=F.lit("ALL")),
        _long("sparse", completeness.sparse_columns(df, t, counts), "missing_pct", severity=F.col("bucket")),
        _long("completeness", completeness.completeness_overall(df, counts), "overall_completeness_pct", column=F.lit("ALL"), severity=F.col("completeness_class")),
    ]
    return _union(parts)


def consistency_findings(df: DataFrame, t: Thresholds = DEFAULTS, counted: DataFrame | None = None) -> DataFrame:
    """Formats, spellings, mappings, periods, signs and duplicates. One scan feeds all checks that pick columns."""
    counted = counted_cells(df, t=t) if counted is None else counted
    seen = scan(df, (*PERIOD_FIGURES, "about_distinct", "about_numbers", *consistency.SIGN_FIGURES), counted=counted)
    counts = cut(domain_counts(df, t.variant_max_distinct, t, seen, counted))
    cased = consistency.case_variants(df, t, counts=counts).groupBy("column").agg(F.sum("variants").alias("variants"))
    mapped = consistency.code_label_consistency(df, t, seen=seen, counted=counted)
    periods = consistency.period_mismatches(df, t, seen)
    parts = [
        _long("mixed_formats", consistency.mixed_formats(df, counted=counted), "formats", examples=F.map_keys("distribution")),
        _long("whitespace", consistency.whitespace_variants(df, t, counts), "padded_cells"),
        _long("case", cased, "variants"),
        _long("code_label", mapped, "inconsistent", F.col("code_column"), F.col("label_column")),
        _long("period", periods, "mismatch_count", F.col("period_column"), F.col("other_column"), examples=F.concat(F.array("part"), F.col("examples"))),
        _long("negative", consistency.negative_values(df, t, seen), "negatives", severity=F.col("priority"), examples=F.col("examples").cast("array<string>")),
        _long("exact_duplicates", duplicates.exact_duplicates(df).filter("duplicate_rows > 0"), "duplicate_rows", F.lit("ALL")),
        _long("near_duplicates", duplicates.near_duplicates(df, t=t, counted=counted).filter("affected_rows > 0"), "affected_rows", F.lit("ALL"), F.col("key_columns")),
    ]
    return _union(parts)


def anomaly_findings(df: DataFrame, t: Thresholds = DEFAULTS, counted: DataFrame | None = None) -> DataFrame:
    """Outliers and odd categories."""
    counted = counted_cells(df, t=t) if counted is None else counted
    seen = scan(df, ("filled", "numbers", "min", "max", "mean", "std", "std_population", "about_distinct"), counted=counted)
    counts = cut(domain_counts(df, t.rare_max_distinct, t, seen, counted))
    outliers = anomaly.numeric_outliers(df, t, seen=seen, counted=counted)
    parts = [
        _long("iqr_outliers", outliers.filter("iqr_outliers > 0"), "iqr_outliers", severity=F.col("severity_strict")),
        _long("zscore_outliers", outliers.filter("z_outliers > 0"), "z_outliers"),
        _long("rare_value", anomaly.rare_categories(df, t, counts), "cnt", examples=F.array("value")),
        _long("invalid_marker", anomaly.invalid_markers(df, t, counts), "cnt", examples=F.array("value")),
    ]
    return _union(parts)


def all_findings(df: DataFrame, t: Thresholds = DEFAULTS, counted: DataFrame | None = None) -> DataFrame:
    """Every check on one table."""
    checks = (schema_findings, completeness_findings, consistency_findings, anomaly_findings)
    counted = counted_cells(df, t=t) if counted is None else counted
    return reduce(DataFrame.unionByName, [check(df, t, counted) for check in checks])
