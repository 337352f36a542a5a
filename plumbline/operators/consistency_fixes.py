"""Consistency fixes: dates, periods, spellings, duplicate rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import DEFAULTS, Thresholds
from plumbline.functions.dates import layout, period, picture, with_dates, with_read
from plumbline.functions.numbers import share
from plumbline.functions.text import fold, ref, strip
from plumbline.operators.cells import cells, columns_of, measure
from plumbline.operators.changes import Fixed
from plumbline.operators.counted import of_columns
from plumbline.operators.consistency import case_variant_rows, fragmented_dates
from plumbline.operators.digests import spelled_differently
from plumbline.operators.duplicates import drop_duplicate_rows
from plumbline.operators.profile import TableProfile, date_cells
from plumbline.operators.scan import counted_columns
from plumbline.session import cut


def date_columns(df: DataFrame, profile: TableProfile | None, t: Thresholds = DEFAULTS) -> list[str]:
    """Columns profiled as dates, and columns without a profile that are mostly dates."""
    columns = columns_of(df, None)
    known = {c: profile.of(c) for c in columns} if profile else {}
    unknown = [c for c in columns if known.get(c) is None]
    dated = {c for c, p in known.items() if p is not None and p.semantic_type == "date"}
    if unknown:
        found = (
            with_dates(cells(df, unknown))
            .groupBy("column", "layout")
            .agg(F.count("value").alias("filled"), F.count("date").alias("dates"))
            .groupBy("column")
            .agg(share(date_cells(t), F.sum("filled")).alias("ratio"))
            .filter(F.col("ratio") >= t.date_ratio)
            .collect()
        )
        dated |= {r["column"] for r in found}
    return [c for c in columns if c in dated]


def normalize_dates(df: DataFrame, columns: Sequence[str], keep_unreadable: bool = True) -> DataFrame:
    """Dates as ``yyyy-MM-dd``, the time of day dropped. Unreadable cells stay as they are, or become null."""
    names = list(df.columns)
    steps = df.withColumns({f"__text{i}": strip(ref(c)) for i, c in enumerate(columns)}) if columns else df
    if columns:
        steps = steps.withColumns({f"__layout{i}": layout(picture(ref(f"__text{i}"))) for i in range(len(columns))})
    fixed = {}
    for i, c in enumerate(columns):
        steps = with_read(steps, f"__text{i}", f"__layout{i}", f"__date{i}")
        iso = ref(f"__date{i}").cast("string")
        fixed[c] = F.coalesce(iso, ref(c)) if keep_unreadable else iso
    return steps.withColumns(fixed).select(*[ref(c) for c in names]) if columns else df


def normalize_fragmented_dates(df: DataFrame) -> DataFrame:
    """Alternate fix: columns with two or more date formats become ISO dates, anything unreadable null."""
    columns = [r["column"] for r in fragmented_dates(df).select("column").collect()]
    return normalize_dates(df, columns, keep_unreadable=False)


def normalize_periods(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Documented variant: period spellings as YYYYMM; other cells stay."""
    return df.withColumns({c: F.coalesce(period(strip(ref(c))), ref(c)) for c in columns})


def canonical_forms(df: DataFrame, columns: Sequence[str], counted: DataFrame | None = None) -> DataFrame:
    """(column, folded, canonical): commonest spelling of every group of trimmed values that differ by case.

    Of equally common spellings the smallest wins. Groups with one spelling have no entry, and their text is not moved.
    ``counted`` are the ``counted_cells`` of the table; of their counted columns only values are moved.
    """
    by_value = [c for c in columns if c in counted_columns(counted)]
    rest = [c for c in columns if c not in set(by_value)]
    spelled = spelled_differently(df.select(*[strip(ref(c)).alias(c) for c in rest]), rest, F.lower) if rest or not by_value else None
    if by_value:
        values = of_columns(counted, by_value).where(F.col("value").isNotNull())
        trimmed = values.groupBy("column", strip(F.col("value")).alias("value")).agg(F.sum("cnt").alias("cnt"))
        spelled = trimmed if spelled is None else trimmed.unionByName(spelled)
    return (
        spelled
        .groupBy("column", F.lower("value").alias("folded"))
        .agg(
            F.count(F.lit(1)).alias("spellings"),
            F.min(F.struct((-F.col("cnt")).alias("neg"), "value")).alias("top"),
        )
        .filter("spellings > 1")
        .select("column", "folded", F.col("top.value").alias("canonical"))
    )


def canonical_case(df: DataFrame, columns: Sequence[str], counted: DataFrame | None = None) -> DataFrame:
    """Trim the columns and give every value its commonest spelling.

    The spelling table holds only values written in several ways. It is written, so the optimiser knows its bytes and
    broadcasts it if small; otherwise each column is joined by shuffle, where its one row per key lets adaptive
    execution split hot values. ``counted`` are the ``counted_cells`` of these columns.
    """
    columns = list(columns)
    if not columns:
        return df
    forms = cut(canonical_forms(df, columns, counted))
    varied = {r["column"] for r in forms.select("column").distinct().collect()}
    names = list(df.columns)
    out = df.withColumns({c: strip(ref(c)) for c in columns})
    for i, c in enumerate(columns):
        if c not in varied:
            continue
        lookup = forms.filter(F.col("column") == c).select(
            F.col("folded").alias(f"__folded{i}"), F.col("canonical").alias(f"__canonical{i}")
        )
        out = out.join(lookup, F.lower(ref(c)) == F.col(f"__folded{i}"), "left")
        out = out.withColumn(c, F.coalesce(F.col(f"__canonical{i}"), ref(c))).drop(f"__folded{i}", f"__canonical{i}")
    return out.select(*[ref(c) for c in names])


def lower_variants(df: DataFrame) -> DataFrame:
    """Alternate fix: columns with spellings that differ by case or blanks are trimmed and lower-cased."""
    columns = [n for n, k in df.dtypes if k == "string"]
    varied = case_variant_rows(df.select(*[ref(c) for c in columns])).select("column").distinct().collect()
    return df.withColumns({r["column"]: fold(ref(r["column"])) for r in varied}) if varied else df


def fix_consistency(
    df: DataFrame, profile: TableProfile | None = None, t: Thresholds = DEFAULTS, counted: DataFrame | None = None
) -> Fixed:
    """Dates to ISO, spellings unified in categorical and text columns, duplicate rows dropped. ``counted`` are the
    ``counted_cells`` of the table."""
    fixed = Fixed(df, "consistency")
    text = {n for n, k in df.dtypes if k == "string"}
    dates = [c for c in date_columns(df, profile, t) if c in text]
    worded = [
        c
        for c in columns_of(df, None)
        if c in text
        and c not in dates
        and profile is not None
        and (p := profile.of(c)) is not None
        and p.semantic_type in ("categorical", "text")
    ]
    # Old and new values side by side, so that one pass counts what changes.
    kept = df.withColumns({f"__was {c}": ref(c) for c in dates + worded}) if dates or worded else df
    out = cut(canonical_case(normalize_dates(kept, dates), worded, counted))
    metrics = {"rows": F.count(F.lit(1))}
    metrics |= {c: F.count_if(~ref(c).eqNullSafe(ref(f"__was {c}"))) for c in dates + worded}
    m = measure(out, metrics)
    for c in dates:
        fixed.note("normalize_date", c, m[c])
    for c in worded:
        fixed.note("standardize_text", c, m[c])
    fixed.df, fixed.stored = cut(drop_duplicate_rows(out.select(*[ref(c) for c in df.columns]), written=True)), True
    fixed.rows_removed = m["rows"] - fixed.df.count()
    fixed.note("drop_duplicate_rows", "ALL", fixed.rows_removed)
    return fixed
