"""Consistency checks: formats, spellings, code-to-label mappings, periods, signs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.config import AMOUNT_KEYWORDS, DATE_SHAPES, DATE_SHAPES_ALTERNATE, DEFAULTS, Thresholds
from plumbline.functions.dates import picture, shape
from plumbline.functions.numbers import pct, share, to_number
from plumbline.functions.text import fold, ref, strip
from plumbline.operators.cells import (
    cells,
    columns_of,
    empty,
    measure,
    number_of,
    small_frame,
)
from plumbline.operators.counted import counts_of, one_by_one
from plumbline.operators.digests import spelled_differently, value_digest
from plumbline.operators.domains import domain_counts
from plumbline.operators.scan import EXAMPLE_CLASSES, NEGATIVE_EXAMPLES, PERIOD_FIGURES, Scan, example_class, scan


# --- formats -----------------------------------------------------------------


def format_distribution(
    df: DataFrame, shapes: Sequence[tuple[str, str]] = DATE_SHAPES, columns: Sequence[str] | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """(column, format, cells) over all filled cells; cells without a date format are ``other``. ``counted`` are
    the ``counted_cells`` of these columns."""
    return (
        (one_by_one(df, columns) if counted is None else counted)
        .filter(F.col("value").isNotNull())
        .select("column", "cnt", strip(F.col("value")).alias("text"))
        .select("column", "cnt", "text", picture(F.col("text")).alias("picture"))
        .select("column", "cnt", shape(F.col("text"), F.col("picture"), shapes).alias("format"))
        .groupBy("column", "format")
        .agg(F.sum("cnt").alias("cells"))
    )


def mixed_formats(df: DataFrame, shapes: Sequence[tuple[str, str]] = DATE_SHAPES, min_share: float = 0.5, counted: DataFrame | None = None) -> DataFrame:
    """Columns mostly in date formats, but in more than one."""
    named = F.col("format") != "other"
    return (
        format_distribution(df, shapes, counted=counted)
        .groupBy("column")
        .agg(
            share(F.sum(F.when(named, F.col("cells")).otherwise(0)), F.sum("cells")).alias("date_share"),
            F.count_if(named).alias("formats"),
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("format", "cells")))).alias("distribution"),
        )
        .filter((F.col("date_share") > min_share) & (F.col("formats") > 1))
    )


def fragmented_dates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Alternate check: columns with two or more date formats of the short list, whatever their share."""
    return (
        format_distribution(df, DATE_SHAPES_ALTERNATE, columns)
        .filter("format <> 'other'")
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("formats"), F.sum("cells").alias("cells"))
        .filter("formats >= 2")
    )


def period_outliers(df: DataFrame, min_share: float = 0.8) -> DataFrame:
    """Documented variant: columns with more than 80 % YYYYMM codes (years 1900-2099) and cells that are none."""
    is_code = strip(F.col("value")).rlike(r"^(19|20)\d{2}(0[1-9]|1[0-2])$")
    return (
        cells(df)
        .groupBy("column")
        .agg(F.count("value").alias("filled"), F.count_if(is_code).alias("codes"))
        .filter((share(F.col("codes"), F.col("filled")) > min_share) & (F.col("filled") > F.col("codes")))
        .select("column", "filled", (F.col("filled") - F.col("codes")).alias("not_period"))
    )


def date_outliers(df: DataFrame, min_share: float = 0.6) -> DataFrame:
    """Documented variant: columns with more than 60 % of their cells in one of the date formats, and cells in none."""
    dated = F.coalesce(F.sum(F.when(F.col("format") != "other", F.col("cells"))), F.lit(0))
    return (
        format_distribution(df)
        .groupBy("column")
        .agg(F.sum("cells").alias("filled"), dated.alias("dated"))
        .filter((share(F.col("dated"), F.col("filled")) > min_share) & (F.col("filled") > F.col("dated")))
        .select("column", "filled", (F.col("filled") - F.col("dated")).alias("not_date"))
    )


def mixed_case_style(df: DataFrame, max_share: float = 0.7) -> DataFrame:
    """Documented variant: text columns where no case style (upper, lower, title) covers more than 70 % of cells."""
    v = F.col("value")
    letters = v.rlike("[A-Za-z]")
    per = cells(df).groupBy("column").agg(
        F.count("value").alias("filled"),
        F.count_if(letters).alias("worded"),
        F.count_if(letters & (v == F.upper(v))).alias("upper_cells"),
        F.count_if(letters & (v == F.lower(v))).alias("lower_cells"),
        F.count_if(letters & (v == F.initcap(v))).alias("title_cells"),
    )
    best = F.greatest("upper_cells", "lower_cells", "title_cells")
    return per.filter(
        (share(F.col("worded"), F.col("filled")) > 0.5) & (share(best, F.col("worded")) <= max_share)
    ).select("column", "worded", "upper_cells", "lower_cells", "title_cells")


# --- spellings ---------------------------------------------------------------


def _small_counts(df: DataFrame, cap: int, t: Thresholds, counts: DataFrame | None) -> DataFrame:
    """Value counts of columns with at most ``cap`` distinct values, nulls left out."""
    counts = (domain_counts(df, cap, t) if counts is None else counts).filter(F.col("value").isNotNull())
    fitting = counts.groupBy("column").agg(F.count(F.lit(1)).alias("cardinality")).filter(F.col("cardinality") <= cap)
    return counts.join(F.broadcast(fitting), "column")  # one row per column


def whitespace_variants(df: DataFrame, t: Thresholds = DEFAULTS, counts: DataFrame | None = None) -> DataFrame:
    """Small-domain columns where values coincide once trimmed; with the cells that carry outer blanks."""
    counts = _small_counts(df, t.variant_max_distinct, t, counts)
    trimmed = strip(F.col("value"))
    return (
        counts.groupBy("column", trimmed.alias("trimmed"))
        .agg(
            F.count(F.lit(1)).alias("raw_values"),
            F.sum(F.when(F.col("value") != trimmed, F.col("cnt")).otherwise(0)).alias("padded_cells"),
        )
        .groupBy("column")
        .agg(
            F.sum("raw_values").alias("raw_values"),
            F.count(F.lit(1)).alias("trimmed_values"),
            F.sum("padded_cells").alias("padded_cells"),
        )
        .filter("trimmed_values < raw_values")
    )


def case_variants(df: DataFrame, t: Thresholds = DEFAULTS, counts: DataFrame | None = None) -> DataFrame:
    """Groups of values that differ by case only, in columns of at most ``variant_max_distinct`` values after
    trimming: (column, folded, variants, cells, forms)."""
    counts = _small_counts(df, t.variant_max_distinct, t, counts)
    return (
        counts.groupBy("column", strip(F.col("value")).alias("form"))
        .agg(F.sum("cnt").alias("cnt"))
        .groupBy("column", fold(F.col("form")).alias("folded"))
        .agg(
            F.count(F.lit(1)).alias("variants"),
            F.sum("cnt").alias("cells"),
            F.sort_array(F.collect_list("form")).alias("forms"),
        )
        .filter("variants > 1")
    )


def case_variant_rows(df: DataFrame) -> DataFrame:
    """Alternate check: the same in every column, outer blanks making a variant too. One row per spelling, since their
    number has no bound: (column, folded, form, cells)."""
    spelled = spelled_differently(df, columns_of(df, None), fold)
    return spelled.select("column", fold(F.col("value")).alias("folded"), F.col("value").alias("form"), F.col("cnt").alias("cells"))


# --- codes and labels --------------------------------------------------------


def code_label_columns(
    df: DataFrame, t: Thresholds = DEFAULTS, seen: Scan | None = None, counted: DataFrame | None = None
) -> tuple[list[str], list[str]]:
    """Columns that look like codes (few distinct numbers) and like their labels (few distinct words). ``counted`` are the
    ``counted_cells`` of the table."""
    seen = seen or scan(df, ("filled", "numbers", "about_distinct", "about_numbers"))
    maybe_codes, maybe_labels = [], []
    for c in seen.columns:
        ratio = seen.numeric_ratio(c)
        if ratio is None:
            continue
        if ratio >= t.numeric_ratio and seen.of(c, "about_numbers") <= t.code_max_distinct * t.domain_slack:
            maybe_codes.append(c)
        elif ratio < t.label_numeric_ratio and seen.of(c, "about_distinct") <= t.label_max_distinct * t.domain_slack:
            maybe_labels.append(c)
    # The sketch only narrowed the candidates; the caps are compared with exact counts.
    exact: dict[tuple[str, str], int] = {}
    if maybe_codes or maybe_labels:
        rows = (
            counts_of(df, maybe_codes + maybe_labels, counted)
            .select("column", "value", to_number(F.col("value")).alias("x"))
            .groupBy("column")
            .agg(F.count("value").alias("distinct"), F.count_distinct("x").alias("numbers"))
            .collect()
        )
        exact = {(r["column"], k): r[k] for r in rows for k in ("distinct", "numbers")}
    codes = [c for c in maybe_codes if t.code_min_distinct <= exact[c, "numbers"] <= t.code_max_distinct]
    labels = [c for c in maybe_labels if exact[c, "distinct"] <= t.label_max_distinct]
    return codes, labels


def paired_by_name(columns: Sequence[str]) -> list[tuple[str, str]]:
    """Documented pairing: ``cod_X`` goes with ``X``, ``tipo_X`` or ``desc_X``."""
    known = {c.lower(): c for c in columns}
    return [
        (known[low], known[label])
        for low in known
        if low.startswith("cod_")
        for label in (low[4:], "tipo_" + low[4:], "desc_" + low[4:])
        if label in known
    ]


def code_label_consistency(
    df: DataFrame,
    t: Thresholds = DEFAULTS,
    pairs: Sequence[tuple[str, str]] | None = None,
    only_broken: bool = True,
    seen: Scan | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """(code_column, label_column, codes, inconsistent, pct_inconsistent) per pair.

    Codes with more than one label are inconsistent; null codes are left out, null labels ignored. A row is repeated
    for each code column only: a code has more than one label exactly if the smallest and the largest of two hashes of them
    differ, and those of all label columns come from one partial aggregate with a row per code. Hashes, as text would be
    sorted for its extremes.
    """
    schema = "code_column string, label_column string, codes bigint, inconsistent bigint, pct_inconsistent double"
    if pairs is None:
        codes, labels = code_label_columns(df, t, seen, counted)
        pairs = [(c, label) for c in codes for label in labels if c != label]
    if not pairs:
        return empty(df, schema)
    codes = list(dict.fromkeys(c for c, _ in pairs))
    labels = list(dict.fromkeys(label for _, label in pairs))
    each = F.array(*[F.struct(F.lit(i).alias("k"), ref(c).cast("string").alias("code")) for i, c in enumerate(codes)])
    hashes = [h.alias(f"{n}{i}") for i, label in enumerate(labels) for n, h in zip("lm", value_digest(ref(label).cast("string")))]

    def several(name: str) -> Column:
        return F.min(name) != F.max(name)

    per_code = (
        df.select(F.explode(each).alias("e"), *hashes)
        .select("e.k", "e.code", *[f"{n}{i}" for i in range(len(labels)) for n in "lm"])
        .filter("code IS NOT NULL")
        .groupBy("k", "code")
        .agg(*[(several(f"l{i}") | several(f"m{i}")).alias(f"differ{i}") for i in range(len(labels))])
    )
    per_column = per_code.groupBy("k").agg(
        F.count(F.lit(1)).alias("codes"), *[F.count_if(f"differ{i}").alias(f"n{i}") for i in range(len(labels))]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(codes.index(c)).alias("of"), F.lit(c).alias("code_column"), F.lit(label).alias("label_column"),
                F.col(f"n{labels.index(label)}").alias("inconsistent"),
            )
            for c, label in pairs
        ]
    )
    out = per_column.select("k", "codes", F.inline(rows)).filter(F.col("of") == F.col("k"))
    if only_broken:
        out = out.filter("inconsistent > 0")
    return out.select("code_column", "label_column", "codes", "inconsistent", pct(F.col("inconsistent"), F.col("codes"), 1).alias("pct_inconsistent"))


# --- periods -----------------------------------------------------------------


def period_columns(df: DataFrame, t: Thresholds = DEFAULTS, seen: Scan | None = None) -> tuple[list[str], list[str]]:
    """(period code columns, columns numeric in nearly all rows), found in one pass."""
    seen = seen or scan(df, ("filled", "numbers", "periods"))
    periods, numeric = [], []
    for c in seen.columns:
        numbers = seen.of(c, "numbers")
        if not numbers:
            continue
        if numbers / seen.rows >= t.numeric_ratio:
            numeric.append(c)
        if seen.of(c, "filled") >= t.pair_min_rows and seen.numeric_ratio(c) >= t.numeric_ratio:
            if seen.of(c, "periods") / numbers >= t.numeric_ratio:
                periods.append(c)
    return periods, numeric


def period_mismatches(df: DataFrame, t: Thresholds = DEFAULTS, seen: Scan | None = None) -> DataFrame:
    """(period_column, other_column, part, aligned_rows, mismatch_count, pct_mismatch, examples).

    Compares each period code with every column that holds years or months. Values of one row meet in the row
    itself, so a single partial aggregate measures all pairs and keeps the examples: pairs of values that disagree,
    the smallest of each of five classes. Pairs whose columns hold too few years and months are left out beforehand.
    """
    schema = (
        "period_column string, other_column string, part string, aligned_rows bigint, "
        "mismatch_count bigint, pct_mismatch double, examples array<string>"
    )
    seen = seen or scan(df, PERIOD_FIGURES)
    periods, numeric = period_columns(df, t, seen)

    def possible(p: str, o: str) -> tuple[str, ...]:
        """Parts that may fill enough of the rows that have both: at least those that do not fit beside each other."""
        rows = max(seen.of(p, "wholes") + seen.of(o, "wholes") - seen.rows, 1)
        return tuple(part for part in ("year", "month") if seen.of(o, f"{part}s") / rows >= t.numeric_ratio)

    parts = {(p, o): some for p in periods for o in numeric if o != p and (some := possible(p, o))}
    pairs = list(parts)
    involved = list(dict.fromkeys(c for pair in pairs for c in pair))
    at = {c: F.col(f"x{i}") for i, c in enumerate(involved)}
    read = df.select(*[number_of(df, c).try_cast("long").alias(f"x{i}") for i, c in enumerate(involved)])
    metrics: dict[str, Column] = {}
    for k, (p, o) in enumerate(pairs):
        period, other = at[p], at[o]
        aligned = period.isNotNull()
        metrics[f"rows{k}"] = F.count(F.when(period.isNotNull(), other))
        within = {"year": other.between(1900, 2100), "month": other.between(1, 12)}
        off = {"year": F.floor(period / 100) != other, "month": F.pmod(period, F.lit(100)) != other}
        seen_both = F.struct(period.alias("p"), other.alias("o"))
        for part in parts[p, o]:
            wrong = off[part]
            metrics[f"{part}s{k}"] = F.count_if(aligned & within[part])
            metrics[f"off_{part}{k}"] = F.count_if(wrong)
            for i in range(EXAMPLE_CLASSES):
                metrics[f"{part}{k} {i}"] = F.min(F.when(wrong & (example_class(period) == i), seen_both))
    m = measure(read, metrics) if metrics else {}
    found = []
    for k, (p, o) in enumerate(pairs):
        rows = m[f"rows{k}"]
        if rows < t.pair_min_rows:
            continue
        part = next((x for x in parts[p, o] if m[f"{x}s{k}"] / rows >= t.numeric_ratio), None)
        if part is None:
            continue
        if off := m[f"off_{part}{k}"]:
            pairs_seen = sorted(x for i in range(EXAMPLE_CLASSES) if (x := m[f"{part}{k} {i}"]) is not None)
            found.append((p, o, part, rows, off, round(off / rows * 100, 1), [f"{x.p}: {x.o}" for x in pairs_seen]))
    return small_frame(df, found, schema)


# --- signs -------------------------------------------------------------------


SIGN_FIGURES = ("filled", "numbers", "negatives", "min", *NEGATIVE_EXAMPLES)


def negative_values(
    df: DataFrame, t: Thresholds = DEFAULTS, seen: Scan | None = None, native_only: bool = False
) -> DataFrame:
    """Numeric columns with negative values; columns named like amounts are HIGH priority.

    The alternate check looks at numeric-typed columns only (``native_only``), however few numbers they hold. Examples
    are up to five different negative numbers, found in the same pass.
    """
    schema = "`column` string, priority string, negatives bigint, pct_of_rows double, min_value double, examples array<double>"
    if native_only:
        native = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
        if not native:
            return empty(df, schema)
        seen = scan(df, SIGN_FIGURES, native)
    seen = seen or scan(df, SIGN_FIGURES)
    rows = []
    for c in seen.columns:
        negatives = seen.of(c, "negatives")
        if not negatives:
            continue
        if not native_only and (seen.of(c, "numbers") < t.negative_min_values or seen.numeric_ratio(c) < t.numeric_ratio):
            continue
        priority = "HIGH" if any(word in c.lower() for word in AMOUNT_KEYWORDS) else "MODERATE"
        examples = sorted(x for f in NEGATIVE_EXAMPLES if (x := seen.of(c, f)) is not None)
        rows.append((c, priority, negatives, round(negatives / seen.rows * 100, 2), seen.of(c, "min"), examples))
    return small_frame(df, rows, schema)
