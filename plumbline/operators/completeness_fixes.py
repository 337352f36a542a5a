"""Completeness fixes: placeholders to null, empty columns dropped, optional fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.config import DEFAULTS, Thresholds
from plumbline.functions.text import is_placeholder, null_placeholders, ref
from plumbline.operators.cells import columns_of, measure
from plumbline.operators.changes import Fixed
from plumbline.operators.counted import of_columns, total, weighted
from plumbline.operators.quantiles import exact_quantiles


def _text(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}


def clear_placeholders(df: DataFrame) -> DataFrame:
    """Cells that are a placeholder as a whole become null."""
    text = _text(df)
    return df.select(*[null_placeholders(ref(c)).alias(c) if c in text else ref(c) for c in df.columns])


def fix_completeness(df: DataFrame, t: Thresholds = DEFAULTS, inclusive: bool = False, counted: DataFrame | None = None) -> Fixed:
    """Placeholders to null, then drop columns over 95 % missing (from 95 % on if ``inclusive``).

    Other nulls are kept: nothing is imputed, their number is reported. ``counted`` are the ``counted_cells`` of the table.
    """
    text = _text(df)
    # NaN is a missing cell as text, but no null: such columns are read as they are.
    read = text if counted is not None else set()
    metrics = {"rows": F.count(F.lit(1))}
    for c in columns_of(df, None):
        if c in read:
            continue
        metrics[f"null {c}"] = F.count_if(ref(c).isNull())
        if c in text:
            metrics[f"placeholder {c}"] = F.count_if(is_placeholder(ref(c)))
    m = measure(df, metrics)
    figures = weighted(of_columns(counted, sorted(read)), {"null": total(F.col("value").isNull()), "placeholder": total(is_placeholder(F.col("value")))}) if read else {}
    m |= {f"{k} {c}": figures[c][k] if c in figures else 0 for c in read for k in ("null", "placeholder")}
    fixed = Fixed(clear_placeholders(df), "completeness")
    kept_nulls = 0
    for c in columns_of(df, None):
        placeholders = m.get(f"placeholder {c}", 0)
        fixed.note("placeholder_to_null", c, placeholders)
        missing = m[f"null {c}"] + placeholders
        rate = missing / m["rows"] if m["rows"] else 0.0
        empty = round(rate * 100, 2) >= t.ultra_sparse * 100 if inclusive else rate > t.ultra_sparse
        if empty:
            fixed.df = fixed.df.drop(ref(c))
            fixed.note("drop_sparse_column", c, missing)
        else:
            kept_nulls += missing
    fixed.note("keep_missing", "ALL", kept_nulls)
    return fixed


def impute_median(df: DataFrame, t: Thresholds = DEFAULTS, max_share: float = 0.15) -> Fixed:
    """Fill nulls of numeric-typed columns with the median where at most 15 % are null."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    m = measure(df, {"rows": F.count(F.lit(1))} | {c: F.count(ref(c)) for c in numeric})
    rows = m["rows"]
    chosen = [c for c in numeric if rows and 0 < (rows - m[c]) / rows <= max_share]
    medians = exact_quantiles(df, {c: ref(c).cast("double") for c in chosen}, [0.5], t=t)
    fixed = Fixed(df, "remediation")
    fixed.df = df.withColumns({c: F.coalesce(ref(c).cast("double"), F.lit(q[0])) for c, q in medians.items()}) if medians else df
    for c in chosen:
        fixed.note("median_imputation", c, rows - m[c])
    return fixed


def fill_unknown(df: DataFrame, columns: Sequence[str] | None = None, word: str = "Unknown") -> DataFrame:
    """Documented variant: nulls of text columns become a word."""
    chosen = set(columns) if columns is not None else _text(df)
    return df.select(*[F.coalesce(ref(c), F.lit(word)).alias(c) if c in chosen else ref(c) for c in df.columns])


def fill_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Documented variant: nulls become the commonest value of the column (of equals, the smallest)."""
    from plumbline.operators.cells import value_counts

    commonest = (
        value_counts(df, list(columns))
        .filter(F.col("value").isNotNull())
        .groupBy("column")
        .agg(F.min(F.struct((-F.col("cnt")).alias("neg"), "value")).alias("top"))
        .select("column", "top.value")
        .collect()  # one row per column
    )
    return df.withColumns({r["column"]: F.coalesce(ref(r["column"]), F.lit(r["value"])) for r in commonest}) if commonest else df
