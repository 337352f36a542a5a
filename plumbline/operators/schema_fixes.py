"""Schema fixes: repeated columns, numbers stored as text, years, decimals, names."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.config import DEFAULTS, ENRICHMENT_ACTIONS, YEAR_WORDS, Thresholds
from plumbline.functions import names
from plumbline.functions.numbers import expand_year, is_whole, rounded, to_number
from plumbline.functions.text import drop_currency, drop_separators, is_placeholder, null_placeholders, ref, strip
from plumbline.operators.cells import columns_of, measure, number_of
from plumbline.operators.changes import Fixed
from plumbline.operators.counted import counted_cells, of_columns, total, weighted
from plumbline.operators.profile import TableProfile
from plumbline.operators.schema import domain_overlap, redundant_pairs, similar_names

Enrichments = Mapping[str, Mapping[str, Any]]


# --- columns -----------------------------------------------------------------


def same_name_columns(columns: Sequence[str]) -> list[str]:
    """Columns whose reduced name an earlier column already has."""
    seen: set[str] = set()
    out = []
    for c in columns:
        reduced = names.plain(c)
        if reduced in seen:
            out.append(c)
        seen.add(reduced)
    return out


def overlapping_columns(df: DataFrame, t: Thresholds = DEFAULTS, counted: DataFrame | None = None) -> list[str]:
    """Columns that repeat a kept one: similar name, and correlated numbers or coinciding values.

    Only pairs with similar names are measured, in one aggregate; pairs of text columns add one value overlap.
    The walk over the columns then works on those figures. ``counted`` are the ``counted_cells`` of the table.
    """
    columns = columns_of(df, None)
    pairs = similar_names(columns, 4)
    if not pairs:
        return []
    involved = list(dict.fromkeys(c for p in pairs for c in p))
    metrics: dict[str, Column] = {}
    for c in involved:
        metrics[f"filled {c}"] = F.count(ref(c))
        metrics[f"numbers {c}"] = F.count(number_of(df, c))
    for k, (a, b) in enumerate(pairs):
        x, y = number_of(df, a), number_of(df, b)
        metrics[f"rows {k}"] = F.count_if(x.isNotNull() & y.isNotNull())
        both_x, both_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
        # a constant column has no correlation; the built-in one would divide by zero
        metrics[f"corr {k}"] = F.try_divide(F.covar_samp(x, y), F.stddev_samp(both_x) * F.stddev_samp(both_y))
    m = measure(df, metrics)

    def both(figure: str, pair: tuple[str, str], least: int) -> bool:
        return all(m[f"{figure} {c}"] >= least for c in pair)

    numeric = {p: k for k, p in enumerate(pairs) if both("filled", p, 5) and both("numbers", p, 11)}
    worded = [p for p in pairs if both("filled", p, 5) and p not in numeric]
    overlap = {(r["column"], r["column_b"]): r["jaccard"] for r in domain_overlap(df, worded, counted).collect()}

    def repeats(kept: str, c: str) -> bool:
        pair = (kept, c)
        if pair in numeric:
            k = numeric[pair]
            r = m[f"corr {k}"]
            return m[f"rows {k}"] > 10 and r is not None and not math.isnan(r) and abs(r) > t.duplicate_correlation
        return overlap.get(pair, 0.0) > t.duplicate_jaccard

    kept: list[str] = []
    dropped: list[str] = []
    for c in columns:
        (dropped if any(repeats(k, c) for k in kept) else kept).append(c)
    return dropped


def drop_redundant(df: DataFrame, t: Thresholds = DEFAULTS, min_overlap: float = 95.0) -> Fixed:
    """Alternate fix: drop the second column of pairs equal in at least 95 % of the compared rows."""
    fixed = Fixed(df, "schema")
    for r in redundant_pairs(df, t).collect():
        if r["overlap_pct"] >= min_overlap and r["col2"] in fixed.df.columns:
            fixed.df = fixed.df.drop(ref(r["col2"]))
            fixed.note("drop_redundant_column", r["col2"], r["rows_compared"])
    return fixed


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.toDF(*[mapping.get(c, c) for c in df.columns])


def rename_snake_case(df: DataFrame, dropping: bool = False) -> DataFrame:
    """All names in snake case; names that would collide get a number."""
    return rename(df, names.renames(df.columns, names.snake_case_dropping if dropping else names.snake_case))


# --- values ------------------------------------------------------------------


def currency_number(c: Column) -> Column:
    """Number of a cell once currency and unit marks are gone. Decimal commas and unit words are not understood."""
    return to_number(drop_currency(c))


def with_numbers(df: DataFrame, numbers: Mapping[str, Column], whole: Mapping[str, bool | None] | None = None) -> DataFrame:
    """Replace columns by numbers: 64-bit integers where every value of the column is whole, else doubles.

    Whether all values are whole is one aggregate over the replaced columns; ``whole`` tells it of some.
    """
    if not numbers:
        return df
    known = whole or {}
    rest = {c: F.bool_and(is_whole(x)) for c, x in numbers.items() if c not in known}
    m = dict(known) | (measure(df, rest) if rest else {})
    return df.withColumns({c: x.try_cast("long") if m[c] else x for c, x in numbers.items()})


def strip_currency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return with_numbers(df, {c: currency_number(ref(c).cast("string")) for c in columns})


def coerce_years(df: DataFrame, columns: Sequence[str], min_values: int = 5) -> DataFrame:
    """Four-digit years in columns that have at least five numbers and a two-digit one among them."""
    numbers = {c: number_of(df, c) for c in columns}
    metrics: dict[str, Column] = {}
    for c, x in numbers.items():
        metrics[f"n {c}"] = F.count(x)
        metrics[f"short {c}"] = F.count_if((x >= 0) & (x < 100))
    m = measure(df, metrics)
    return df.withColumns(
        {
            c: expand_year(x.try_cast("long"))
            for c, x in numbers.items()
            if m[f"n {c}"] >= min_values and m[f"short {c}"]
        }
    )


def round_decimals(df: DataFrame, decimals: Mapping[str, int]) -> DataFrame:
    """Round half to even."""
    return df.withColumns({c: rounded(number_of(df, c), d) for c, d in decimals.items()})


def coerce_integers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns whose numbers are all whole become 64-bit integers; others stay untouched."""
    numbers = {c: number_of(df, c) for c in columns}
    m = measure(df, {c: F.bool_and(is_whole(x)) for c, x in numbers.items()})
    return df.withColumns({c: x.try_cast("long") for c, x in numbers.items() if m[c]})


def coerce_mostly_numeric(df: DataFrame, min_share: float = 0.9, min_filled: int = 50) -> Fixed:
    """Alternate fix: text columns that are numbers in over 90 % of more than 50 filled cells become numeric.

    Commas are removed, so ``6,0`` reads as 60.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    numbers = {c: to_number(drop_separators(ref(c))) for c in text}
    metrics: dict[str, Column] = {}
    for c, x in numbers.items():
        metrics[f"filled {c}"] = F.count(ref(c))
        metrics[f"n {c}"] = F.count(x)
    m = measure(df, metrics)
    fixed = Fixed(df, "remediation")
    chosen = {}
    for c, x in numbers.items():
        filled, n = m[f"filled {c}"], m[f"n {c}"]
        if filled > min_filled and n / filled > min_share:
            chosen[c] = x
            fixed.note("type_coercion_to_numeric", c, n)
    fixed.df = df.withColumns(chosen) if chosen else df
    fixed.types_changed = len(chosen)
    return fixed


# --- enrichments -------------------------------------------------------------

# Digits behind the point, then a long run of 0 or 9, then a few stray digits: noise of float arithmetic.
_NOISE = r"\.(\d*?)(0{6,}|9{6,})\d{1,3}$"


def valid_enrichments(rows: Iterable[Mapping[str, Any]] | DataFrame) -> dict[str, dict[str, Any]]:
    """Rows (column, fix_action, params) whose action is known; all others are discarded."""
    if isinstance(rows, DataFrame):
        rows = [r.asDict(recursive=True) for r in rows.filter(F.col("fix_action").isin(*ENRICHMENT_ACTIONS)).collect()]
    return {
        r["column"]: {"fix_action": r["fix_action"], "params": dict(r.get("params") or {})}
        for r in rows
        if r.get("fix_action") in ENRICHMENT_ACTIONS
    }


def propose_enrichments(
    df: DataFrame, columns: Sequence[str], max_decimals: int = 6, counted: DataFrame | None = None
) -> dict[str, dict[str, Any]]:
    """Fix actions that the values of numeric text columns call for.

    ``round_Ndp`` if some values carry float noise and no clean value needs many decimals; ``coerce_int`` if all
    are whole but some are written with a point; ``coerce_year`` if the name says year and two-digit values from
    20 up stand beside four-digit years. ``counted`` are the ``counted_cells`` of the table.
    """
    text, x, noisy = F.col("text"), F.col("x"), F.col("noisy")
    numbers = (
        (counted_cells(df, columns) if counted is None else of_columns(counted, columns))
        .select("column", "cnt", strip(F.col("value")).alias("text"))
        .withColumn("x", to_number(text))
        .where(x.isNotNull())
        .withColumn("noisy", text.rlike(_NOISE))
    )
    rows = numbers.groupBy("column").agg(
        F.sum("cnt").alias("n"),
        total(noisy).alias("noisy"),
        F.max(F.when(noisy, F.length(F.regexp_extract(text, _NOISE, 1)))).alias("noisy decimals"),
        F.max(F.when(~noisy, F.length(F.regexp_extract(text, r"\.(\d+)$", 1)))).alias("clean decimals"),
        F.bool_and(is_whole(x)).alias("whole"),
        total(text.contains(".")).alias("pointed"),
        total(x.between(20, 99)).alias("short years"),
        total((x >= 0) & (x < 20)).alias("too short"),
        total(x.between(1900, 2100)).alias("long years"),
    )
    # One row per column; a column without numbers has none.
    figures = {r["column"]: r.asDict() for r in rows.collect()}
    m = {f"{k} {c}": figures[c][k] if c in figures else None for c in columns for k in rows.columns[1:]}
    out: dict[str, dict[str, Any]] = {}
    for c in columns:
        words = set(names.snake_case(c).split("_")) | {c.lower()}
        if (
            words & set(YEAR_WORDS)
            and m[f"short years {c}"]
            and m[f"long years {c}"]
            and not m[f"too short {c}"]
        ):
            out[c] = {"fix_action": "coerce_year", "params": {}}
        elif m[f"noisy {c}"] and (m[f"clean decimals {c}"] or 0) <= max_decimals:
            digits = max(m[f"noisy decimals {c}"], m[f"clean decimals {c}"] or 0)
            out[c] = {"fix_action": "round_Ndp", "params": {"decimals": digits}}
        elif m[f"n {c}"] and m[f"whole {c}"] and m[f"pointed {c}"]:
            out[c] = {"fix_action": "coerce_int", "params": {}}
    return out


def _read_number(column_is_numeric: Column) -> Column:
    """Number of a counted text cell: without currency marks in numeric columns."""
    return F.when(column_is_numeric, currency_number(F.col("value"))).otherwise(to_number(F.col("value")))


def _fix_figures(cells: DataFrame, numeric: set[str]) -> dict[str, int]:
    """What ``fix_schema`` counts of text columns, as ``figure column``: one pass over counted cells."""
    value, x, plain = F.col("value"), F.col("x"), F.col("plain")
    read = cells.withColumns({"plain": to_number(value), "x": _read_number(F.col("column").isin(sorted(numeric)))})
    figures = weighted(
        read,
        {
            "gained": total(plain.isNull() & x.isNotNull()),
            "lost": total(value.isNotNull() & x.isNull()),
            "numbers": total(x.isNotNull()),
            "short": total((x >= 0) & (x < 100)),
            "placeholders": total(is_placeholder(strip(value))),
        },
    )
    return {f"{k} {c}": n for c, of_column in figures.items() for k, n in of_column.items()}


def _whole_columns(
    counted: DataFrame | None, columns: Sequence[str], numeric: set[str], remade: Mapping[str, Callable[[Column], Column]]
) -> dict[str, bool | None]:
    """Whether all numbers of text columns are whole once they are remade; None where there are none."""
    if not columns:
        return {}
    x = F.col("x")
    out = F.when(~F.col("column").isin(list(remade)), x) if remade else x
    for c, make in remade.items():
        out = out.when(F.col("column") == c, make(x))
    read = of_columns(counted, columns).withColumn("x", _read_number(F.col("column").isin(sorted(numeric))))
    found = weighted(read.withColumn("out", out), {"whole": F.bool_and(is_whole(F.col("out")))})
    return {c: found[c]["whole"] if c in found else None for c in columns}


# --- the stage ---------------------------------------------------------------


def fix_schema(
    df: DataFrame,
    profile: TableProfile,
    enrichments: Enrichments | None = None,
    t: Thresholds = DEFAULTS,
    count_all_numeric: bool = False,
    counted: DataFrame | None = None,
) -> Fixed:
    """All schema fixes in order: repeated columns, numbers, placeholders, years and decimals, hyphens.

    ``types_changed`` counts columns in which a cell really changed; ``count_all_numeric`` counts every numeric
    column instead. What a fix does to a text cell depends on its value alone, so all figures of text columns come from
    ``counted``, the ``counted_cells`` of the table.
    """
    fixed = Fixed(df, "schema")
    for c in same_name_columns(df.columns):
        fixed.df = fixed.df.drop(ref(c))
        fixed.note("drop_same_name_column", c, 1)
    for c in overlapping_columns(fixed.df, t, counted):
        fixed.df = fixed.df.drop(ref(c))
        fixed.note("drop_overlapping_column", c, 1)

    enrichments = valid_enrichments([{"column": c, **e} for c, e in (enrichments or {}).items()])
    typed = {c: p.semantic_type for c, p in profile.columns.items()}
    source = fixed.df
    numbers: dict[str, Column] = {}
    texts: dict[str, Column] = {}
    for c in source.columns:
        if typed.get(c) == "numeric":
            numbers[c] = currency_number(ref(c).cast("string"))
        elif typed.get(c) == "identifier":
            texts[c] = null_placeholders(ref(c), trimmed=True)

    # One pass tells how many cells the numeric parse gains, loses and finds as placeholders.
    texted = {f.name for f in source.schema.fields if isinstance(f.dataType, T.StringType)}
    by_value = [c for c in source.columns if c in texted and (c in numbers or c in texts or c in enrichments)]
    if by_value and counted is None:
        counted = counted_cells(source, by_value, t)
    m = _fix_figures(of_columns(counted, by_value), set(numbers)) if by_value else {}
    metrics: dict[str, Column] = {}
    for c, x in numbers.items():
        if c in texted:
            continue
        plain = number_of(source, c)
        metrics[f"gained {c}"] = F.count_if(plain.isNull() & x.isNotNull())
        metrics[f"lost {c}"] = F.count_if(ref(c).isNotNull() & x.isNull())
        metrics[f"numbers {c}"] = F.count(x)
        metrics[f"short {c}"] = F.count_if((x >= 0) & (x < 100))
    for c in texts:
        if c in texted:
            continue
        metrics[f"placeholders {c}"] = F.count_if(is_placeholder(strip(ref(c))))
    for c, e in enrichments.items():
        if c in source.columns and c not in numbers and c not in texted:
            x = number_of(source, c)
            metrics[f"numbers {c}"] = F.count(x)
            metrics[f"short {c}"] = F.count_if((x >= 0) & (x < 100))
    m |= measure(source, metrics) if metrics else {}
    for c in by_value:
        for figure in ("gained", "lost", "numbers", "short", "placeholders"):
            m.setdefault(f"{figure} {c}", 0)
    changed = set()
    for c in numbers:
        fixed.note("strip_currency", c, m[f"gained {c}"])
        fixed.note("not_a_number_to_null", c, m[f"lost {c}"])
        if m[f"gained {c}"] or m[f"lost {c}"]:
            changed.add(c)
    for c in texts:
        fixed.note("placeholder_to_null", c, m[f"placeholders {c}"])

    doubles = dict(numbers)
    remade: dict[str, Callable[[Column], Column]] = {}  # what becomes of the number of a cell
    for c, e in enrichments.items():
        if c not in source.columns:
            continue
        x = doubles.get(c, number_of(source, c))
        action = e["fix_action"]
        if action == "coerce_year" and m[f"numbers {c}"] >= 5 and m[f"short {c}"]:
            remade[c] = lambda x: expand_year(F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x)).cast("double"))
            doubles[c] = remade[c](x)
            fixed.note("expand_year", c, m[f"short {c}"])
        elif action == "round_Ndp" and m[f"numbers {c}"]:
            remade[c] = lambda x, digits=int(e["params"].get("decimals", 2)): rounded(x, digits)
            doubles[c] = remade[c](x)
            fixed.note("round_decimals", c, m[f"numbers {c}"])
        elif action == "coerce_int" and m[f"numbers {c}"]:
            doubles.setdefault(c, x)
        else:
            continue
        changed.add(c)

    out = source.withColumns(texts) if texts else source
    whole = _whole_columns(counted, [c for c in doubles if c in texted], set(numbers), remade)
    # ``coerce_int`` on a column that is not numeric throughout leaves it as it is.
    tentative = [c for c in doubles if c not in numbers and enrichments[c]["fix_action"] == "coerce_int"]
    if tentative:
        whole |= measure(source, {c: F.bool_and(is_whole(doubles[c])) for c in tentative if c not in whole})
        for c in tentative:
            if not whole[c]:
                del doubles[c]
                changed.discard(c)
    out = with_numbers(out, doubles, whole)
    renamed = names.renames(out.columns, lambda c: c.replace("-", "_"))
    for old, new in renamed.items():
        fixed.note("rename_column", old, int(old != new))
    fixed.df = rename(out, renamed)
    fixed.types_changed = len(set(numbers) | changed) if count_all_numeric else len(changed)
    return fixed
