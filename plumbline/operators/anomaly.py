"""Numeric outliers and odd categories."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.config import DEFAULTS, INVALID_MARKERS, PLACEHOLDER_WORDS, Thresholds
from plumbline.functions.numbers import pct, share, to_number
from plumbline.functions.text import fold, null_placeholder_words, ref
from plumbline.operators.cells import (
    cells,
    columns_of,
    empty,
    measure,
    number_of,
    small_frame,
    top_values,
    value_counts,
)
from plumbline.operators.counted import of_columns, total, weighted
from plumbline.operators.digests import commonest, digest_counts, gated
from plumbline.operators.domains import domain_counts
from plumbline.operators.quantiles import counted_quantiles, exact_quantiles
from plumbline.operators.scan import Scan, counted_among, scan
from plumbline.session import cut

OUTLIER_SCHEMA = (
    "`column` string, n_values bigint, mean double, std double, min double, max double, lower_fence double, "
    "upper_fence double, iqr_outliers bigint, z_outliers bigint, iqr_pct double, severity string, severity_strict string"
)


def outlier_severity(rate: float) -> str:
    return "HIGH" if rate > 15 else "MODERATE" if rate > 5 else "LOW"


def outlier_severity_strict(rate: float) -> str:
    return "HIGH" if rate > 10 else "MODERATE" if rate >= 1 else "LOW"


_MOMENTS = ("filled", "numbers", "min", "max", "mean", "std", "std_population")


def numeric_figures(
    df: DataFrame, t: Thresholds = DEFAULTS, native_only: bool = False, seen: Scan | None = None
) -> dict[str, dict]:
    """Counts and moments of the columns that are numeric in enough cells, from one pass."""
    columns = columns_of(df, None)
    if native_only:
        columns = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    seen = seen or scan(df, _MOMENTS, columns)
    return {
        c: {"rows": seen.rows} | seen.values[c]
        for c in columns
        if seen.of(c, "filled") >= t.outlier_min_values and seen.numeric_ratio(c) >= t.numeric_ratio
    }


def fences(
    df: DataFrame, figures: dict[str, dict], t: Thresholds = DEFAULTS, counted: DataFrame | None = None
) -> dict[str, tuple[float, float]]:
    """Lower and upper fence of each column: quartiles widened by ``iqr_factor`` times their distance. ``counted`` are the
    ``counted_cells`` of the table, here and below."""
    by_value = counted_among(df, list(figures), counted)
    rest = [c for c in figures if c not in set(by_value)]
    bounds = {c: (figures[c]["numbers"], figures[c]["min"], figures[c]["max"]) for c in rest}
    quartiles = exact_quantiles(df, {c: number_of(df, c) for c in rest}, (0.25, 0.75), bounds, t)
    if by_value:
        quartiles |= counted_quantiles(counted, by_value, (0.25, 0.75), t)
    return {
        c: (q1 - t.iqr_factor * (q3 - q1), q3 + t.iqr_factor * (q3 - q1)) for c in figures if c in quartiles for q1, q3 in [quartiles[c]]
    }


def numeric_outliers(
    df: DataFrame,
    t: Thresholds = DEFAULTS,
    native_only: bool = False,
    population_std: bool = False,
    by_iqr_only: bool = False,
    seen: Scan | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Columns with values outside the quartile fences or more than ``z_limit`` deviations from the mean.

    The alternate check looks at numeric-typed columns only (``native_only``), divides by the population deviation
    and reports only columns with fence outliers (``by_iqr_only``).
    """
    figures = numeric_figures(df, t, native_only, seen)
    limits = fences(df, figures, t, counted)
    metrics: dict[str, Column] = {}
    deviation = {c: figures[c]["std_population" if population_std else "std"] for c in limits}
    by_value = counted_among(df, list(limits), counted)
    for c, (low, high) in limits.items():
        if c in by_value:
            continue
        x = number_of(df, c)
        metrics[f"iqr {c}"] = F.count_if((x < low) | (x > high))
        if deviation[c]:
            metrics[f"z {c}"] = F.count_if(F.abs((x - figures[c]["mean"]) / deviation[c]) > t.z_limit)
    m = measure(df, metrics) if metrics else {}
    if by_value:

        def of_column(values: dict[str, float | None]) -> Column:
            return F.element_at(F.create_map(*[F.lit(x) for c in by_value for x in (c, F.lit(values[c]).cast("double"))]), F.col("column"))

        x = F.col("x")
        low, high = (of_column({c: limits[c][i] for c in by_value}) for i in range(2))
        off = F.abs((x - of_column({c: figures[c]["mean"] for c in by_value})) / of_column({c: deviation[c] or None for c in by_value}))
        cells_read = of_columns(counted, by_value).select("column", "cnt", to_number(F.col("value")).alias("x"))
        figures_read = weighted(cells_read, {"iqr": total((x < low) | (x > high)), "z": total(off > t.z_limit)})
        m |= {f"{k} {c}": n for c, read in figures_read.items() for k, n in read.items()}
    rows = []
    for c, (low, high) in limits.items():
        f, iqr, z = figures[c], m[f"iqr {c}"], m.get(f"z {c}", 0)
        if iqr or (z and not by_iqr_only):
            rate = round(iqr / f["rows"] * 100, 2)
            rows.append(
                (
                    c, f["numbers"], round(f["mean"], 2), round(f["std"], 2), round(f["min"], 2), round(f["max"], 2),
                    round(low, 2), round(high, 2), iqr, z, rate, outlier_severity(rate), outlier_severity_strict(rate),
                )
            )
    return small_frame(df, rows, OUTLIER_SCHEMA)


def deviations(figures: dict[str, dict], t: Thresholds = DEFAULTS) -> dict[str, tuple[float, float]]:
    """The values ``z_limit`` standard deviations below and above the mean of each column that varies."""
    return {
        c: (f["mean"] - t.z_limit * f["std"], f["mean"] + t.z_limit * f["std"]) for c, f in figures.items() if f["std"]
    }


def largest_outliers(df: DataFrame, t: Thresholds = DEFAULTS, by_deviation: bool = False) -> DataFrame:
    """(column, examples): the five largest fence outliers of each column, copies kept; or of those more than
    ``z_limit`` deviations from the mean."""
    figures = numeric_figures(df, t)
    limits = deviations(figures, t) if by_deviation else fences(df, figures, t)
    columns = list(limits)
    if not columns:
        return small_frame(df, [], "`column` string, examples array<double>")

    def limit(i: int) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for c, pair in limits.items() for x in (c, pair[i])]), F.col("column"))

    x = to_number(F.col("value"))
    outside = (
        cells(df, columns).select("column", x.alias("x")).filter((F.col("x") < limit(0)) | (F.col("x") > limit(1)))
    )
    return top_values(outside, t.examples, [F.desc("x")], value="x")


def outlier_flags(df: DataFrame, columns: Sequence[str] | None = None, t: Thresholds = DEFAULTS) -> DataFrame:
    """Add ``<column>_outlier_flag`` (1 outside the fences, else 0; null counts as 0) per column.

    Without ``columns``: for every numeric-typed column whose share of outliers is HIGH.
    """
    if columns is None:
        found = numeric_outliers(df, t, native_only=True, population_std=True, by_iqr_only=True)
        columns = [r["column"] for r in found.filter("severity = 'HIGH'").collect()]
    figures = {c: f for c, f in numeric_figures(df, t).items() if c in set(columns)}
    flags = {}
    for c, (low, high) in fences(df, figures, t).items():
        x = number_of(df, c)
        flags[f"{c}_outlier_flag"] = F.when((x < low) | (x > high), 1).otherwise(0)
    return df.withColumns(flags) if flags else df


# --- categories --------------------------------------------------------------


def _categories(df: DataFrame, t: Thresholds, counts: DataFrame | None) -> DataFrame:
    """Value counts, nulls included, of columns with few distinct values that are not numbers; with row totals."""
    counts = domain_counts(df, t.rare_max_distinct, t) if counts is None else counts
    value, cnt = F.col("value"), F.col("cnt")
    fitting = (
        counts.groupBy("column")
        .agg(
            F.sum("cnt").alias("row_count"),
            F.sum(F.when(value.isNotNull(), cnt).otherwise(0)).alias("filled"),
            F.sum(F.when(to_number(value).isNotNull(), cnt).otherwise(0)).alias("numbers"),
            F.count("value").alias("cardinality"),
        )
        .filter(share(F.col("numbers"), F.col("filled")) < t.numeric_ratio)
        .filter(F.col("cardinality") <= t.rare_max_distinct)
    )
    return counts.join(F.broadcast(fitting), "column")  # one row per column


def rare_categories(df: DataFrame, t: Thresholds = DEFAULTS, counts: DataFrame | None = None) -> DataFrame:
    """Values, null among them, in fewer than 0.5 % of the rows of a categorical column."""
    counts = _categories(df, t, counts)
    return counts.filter(share(F.col("cnt"), F.col("row_count")) < t.rare_share).select(
        "column", "value", "cnt", pct(F.col("cnt"), F.col("row_count"), 3).alias("pct")
    )


def rare_values(df: DataFrame, t: Thresholds = DEFAULTS, columns: Sequence[str] | None = None, k: int = 10) -> DataFrame:
    """Alternate check: values of text columns below 0.5 % of the filled cells, whatever the number of values; the ``k``
    commonest of them in each column, ties by value."""
    if columns is None:
        columns = [n for n, k in df.dtypes if k == "string"]
    counts, filled = common_counts(df, columns, k + math.ceil(1 / t.rare_share), t)
    in_order = Window.partitionBy("column").orderBy(F.desc("cnt"), "value")
    return (
        counts.join(F.broadcast(filled), "column")  # one row per column
        .filter(share(F.col("cnt"), F.col("filled")) < t.rare_share)
        .withColumn("place", F.row_number().over(in_order))
        .filter(F.col("place") <= k)
        .select("column", "value", "cnt", pct(F.col("cnt"), F.col("filled"), 3).alias("pct"))
    )


def common_counts(df: DataFrame, columns: Sequence[str], k: int, t: Thresholds = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """((column, value, cnt), figures of the columns): counts of all filled values of small domains, and of at least the
    ``k`` commonest of larger ones, whose text is not moved otherwise.

    A share of the rows can only be reached by as many values as go into one, so the rest of a large column is rare."""
    small, large = gated(df, columns, t)
    value, cnt = F.col("value"), F.col("cnt")
    filled = value.isNotNull()
    counts = value_counts(df, small) if small else empty(df, "`column` string, value string, cnt bigint")
    marked = counts.select("column", "cnt", filled.alias("is_filled"), to_number(value).isNotNull().alias("is_number"))
    if large:
        digests = cut(digest_counts(df, large, {"is_filled": filled, "is_number": to_number(value).isNotNull()}))
        name = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(large) for x in (i, c)]), F.col("at")).alias("column")
        marked = marked.unionByName(digests.select(name, "cnt", "is_filled", "is_number"))
        counts = counts.unionByName(commonest(df, digests, large, k))
    figures = marked.groupBy("column").agg(
        F.sum("cnt").alias("row_count"),
        F.sum(F.when(F.col("is_filled"), cnt).otherwise(0)).alias("filled"),
        F.sum(F.when(F.col("is_number"), cnt).otherwise(0)).alias("numbers"),
        F.count_if("is_filled").alias("cardinality"),
    )
    return counts.filter(filled), figures


def invalid_markers(df: DataFrame, t: Thresholds = DEFAULTS, counts: DataFrame | None = None) -> DataFrame:
    """Markers such as ``n.d.`` that are still in a categorical column."""
    counts = _categories(df, t, counts)
    return counts.filter(F.col("value").isin(*INVALID_MARKERS)).select(
        "column", "value", "cnt", pct(F.col("cnt"), F.col("row_count"), 3).alias("pct")
    )


def placeholder_words(df: DataFrame) -> DataFrame:
    """Alternate check: placeholder words in text columns, compared in lower case. Filtered before any shuffle."""
    columns = [n for n, k in df.dtypes if k == "string"]
    rows = measure(df, {"rows": F.count(F.lit(1))})["rows"]
    return (
        cells(df, columns)
        .filter(fold(F.col("value")).isin(*PLACEHOLDER_WORDS))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .withColumn("pct", pct(F.col("cnt"), F.lit(rows)))
    )


def clear_placeholder_words(df: DataFrame) -> DataFrame:
    """The table with those words made null."""
    text = {n for n, k in df.dtypes if k == "string"}
    return df.select(*[null_placeholder_words(ref(c)).alias(c) if c in text else ref(c) for c in df.columns])


def dominant_category(df: DataFrame, t: Thresholds = DEFAULTS, counts: DataFrame | None = None) -> DataFrame:
    """Distinct values, commonest value and its share per categorical column."""
    counts = _categories(df, t, counts)
    return (
        counts.filter(F.col("value").isNotNull())
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("distinct_values"),
            F.min(F.struct((-F.col("cnt")).alias("neg"), "value")).alias("top"),
            F.max("row_count").alias("row_count"),
        )
        .select(
            "column",
            "distinct_values",
            F.col("top.value").alias("dominant"),
            (-F.col("top.neg")).alias("dominant_count"),
            pct(-F.col("top.neg"), F.col("row_count")).alias("dominant_pct"),
        )
    )


def frequent_values(df: DataFrame, t: Thresholds = DEFAULTS, k: int = 5, numeric_ratio: float = 0.8) -> DataFrame:
    """Documented variant: the ``k`` commonest values of columns with under 50 distinct values or under 5 % distinct."""
    counts, figures = common_counts(df, columns_of(df, None), k, t)
    cnt = F.col("cnt")
    fitting = figures.filter(share(F.col("numbers"), F.col("filled")) < numeric_ratio).filter(
        (F.col("cardinality") < t.rare_max_distinct) | (share(F.col("cardinality"), F.col("row_count")) < t.categorical_ratio)
    )
    kept = counts.join(F.broadcast(fitting), "column")  # one row per column
    w = Window.partitionBy("column").orderBy(F.desc("cnt"), F.asc("value"))
    return (
        kept.withColumn("place", F.row_number().over(w))
        .filter(F.col("place") <= k)
        .select("column", "place", "value", "cnt", pct(cnt, F.col("row_count"), 3).alias("pct"))
    )


def anomaly_rates(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Anomalous cells per column: fence outliers of numeric columns and rare values of categorical ones."""
    rows = measure(df, {"rows": F.count(F.lit(1))})["rows"]
    outliers = numeric_outliers(df, t).select("column", F.col("iqr_outliers").alias("anomalies"))
    rare = rare_categories(df, t).groupBy("column").agg(F.sum("cnt").alias("anomalies"))
    return (
        outliers.unionByName(rare)
        .filter("anomalies > 0")
        .withColumn("rate_pct", pct(F.col("anomalies"), F.lit(rows)))
        .orderBy(F.desc("rate_pct"), "column")
    )
