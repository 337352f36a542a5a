"""Duplicate rows and rows that share a key."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DEFAULTS, KEY_NAME_PARTS, Thresholds
from plumbline.functions.numbers import pct
from plumbline.functions.text import ref
from plumbline.operators.cells import columns_of
from plumbline.operators.counted import of_columns, one_by_one, total, weighted
from plumbline.operators.digests import cardinalities, row_digest
from plumbline.session import cut
from plumbline.sources.tables import comparable, has_no_order


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[comparable(df, c) for c in df.columns])


def _suspects(df: DataFrame) -> DataFrame:
    """Hashes carried by more than one row. Eight bytes per row are shuffled instead of the row."""
    return (
        df.select(_row_hash(df).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    )


def _repeating(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that are certainly unique, rows that may repeat) of a stored table.

    The repeating hashes are written, so the optimiser knows their size: it broadcasts few and joins many by shuffle.
    """
    suspects = cut(_suspects(df).select("h"))
    same = _row_hash(df) == F.col("h")
    return df.join(suspects, same, "left_anti"), df.join(suspects, same, "left_semi")


def exact_duplicates(df: DataFrame) -> DataFrame:
    """One row: rows, rows that repeat an earlier one, their percentage, and rows left without them.

    Rows are equal if all columns are, nulls included; maps are equal if their entries are. Only rows whose hash occurs twice are compared in full,
    so the result is exact while unique rows never travel; copies collapse inside each task.
    """
    repeated = (
        _repeating(df)[1]
        .groupBy(*[comparable(df, c).alias(f"c{i}") for i, c in enumerate(df.columns)])
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))
    )
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    both = total.unionByName(repeated, allowMissingColumns=True)
    return both.agg(F.max("total_rows").alias("total_rows"), F.max("duplicate_rows").alias("duplicate_rows")).select(
        "total_rows",
        "duplicate_rows",
        F.coalesce(pct(F.col("duplicate_rows"), F.col("total_rows")), F.lit(0.0)).alias("duplicate_pct"),
        (F.col("total_rows") - F.col("duplicate_rows")).alias("rows_after"),
    )


def _distinct(df: DataFrame) -> DataFrame:
    """``dropDuplicates`` that also takes maps and variants."""
    names = df.columns
    if not any(has_no_order(df, c) for c in names):
        return df.dropDuplicates()
    forms = [comparable(df, c).alias(f"k{i}") for i, c in enumerate(names)]
    both = df.select(*[ref(c).alias(f"c{i}") for i, c in enumerate(names)], *forms)
    kept = both.dropDuplicates([f"k{i}" for i in range(len(names))])
    return kept.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)


def drop_duplicate_rows(df: DataFrame, written: bool = False) -> DataFrame:
    """The table without repeated rows; one plan at every size.

    The input is evaluated once and written, unless it is ``written`` already. Rows with a unique hash keep their
    place and only the others are compared in full, copies collapsing inside each task first.
    """
    unique, suspects = _repeating(df if written else cut(df))
    return unique.unionByName(_distinct(suspects))


# A sketch decides where it is further than this factor from a cut-off (six times its standard error); exact counts
# decide the rest.
_SKETCH_MARGIN = 1.3


def _key_figures(df: DataFrame, columns: Sequence[str], counted: DataFrame | None = None) -> dict[str, dict[str, Any]]:
    """Rows, filled cells, characters and estimated distinct values of each column, in one pass."""
    value = F.col("value")
    figures = {
        "row_count": F.sum("cnt"), "filled": total(value.isNotNull()), "chars": F.sum(F.length(value) * F.col("cnt")),
        "about_distinct": F.approx_count_distinct(value),
    }
    return weighted(one_by_one(df, columns) if counted is None else of_columns(counted, columns), figures)


def key_candidates(df: DataFrame, t: Thresholds = DEFAULTS, counted: DataFrame | None = None) -> list[str]:
    """Up to four columns of moderate uniqueness and short values, most distinct first.

    Long or nearly constant columns leave by a sketch; distinct values of the others are counted by digests. ``counted``
    are the ``counted_cells`` of the table."""
    columns = columns_of(df, None)
    seen = _key_figures(df, columns, counted)
    maybe = [
        c
        for c in columns
        if c in seen
        and seen[c]["filled"]
        and seen[c]["chars"] / seen[c]["filled"] < t.key_max_length
        and seen[c]["about_distinct"] * _SKETCH_MARGIN >= t.key_min_ratio * seen[c]["row_count"]
    ]
    distinct = cardinalities(df, maybe)
    ratios = {c: distinct[c] / seen[c]["row_count"] for c in maybe}
    fitting = [c for c in maybe if t.key_min_ratio <= ratios[c] <= t.key_max_ratio]
    order = {c: i for i, c in enumerate(df.columns)}
    return sorted(fitting, key=lambda c: (-ratios[c], order[c], c))[: t.key_columns]


def named_keys(df: DataFrame, t: Thresholds = DEFAULTS) -> list[str]:
    """Documented variant: columns named like keys, else those with more than half of their values distinct."""
    columns = columns_of(df, None)
    parts = set(KEY_NAME_PARTS)
    by_name = [c for c in columns if parts & set(c.lower().replace("-", "_").replace(" ", "_").split("_"))]
    if by_name:
        return by_name
    seen = _key_figures(df, columns)
    half = {c: r["row_count"] / 2 for c, r in seen.items()}
    close = [c for c in columns if c in seen and half[c] / _SKETCH_MARGIN <= seen[c]["about_distinct"] <= half[c] * _SKETCH_MARGIN]
    distinct = {c: seen[c]["about_distinct"] for c in seen} | cardinalities(df, close)
    return [c for c in columns if c in seen and distinct[c] > half[c]]


def near_duplicates(
    df: DataFrame, keys: Sequence[str] | None = None, t: Thresholds = DEFAULTS, counted: DataFrame | None = None
) -> DataFrame:
    """One row: key columns, groups of rows sharing a key, and the rows in them (every member counts)."""
    keys = list(keys) if keys is not None else key_candidates(df, t, counted)
    if not keys:
        return df.sparkSession.createDataFrame([("", 0, 0)], "key_columns string, key_groups bigint, affected_rows bigint")
    # Two hashes stand for the key, so no text is moved.
    first, second = row_digest(df, keys)
    return (
        df.select(first.alias("k1"), second.alias("k2"))
        .groupBy("k1", "k2")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .agg(F.count(F.lit(1)).alias("key_groups"), F.coalesce(F.sum("rows"), F.lit(0)).alias("affected_rows"))
        .select(F.lit(",".join(keys)).alias("key_columns"), "key_groups", "affected_rows")
    )


def _differing_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys…, rows) of the keys whose rows are not all equal.

    Rows differ in a column exactly if its smallest and largest value do, or if only some of them are null, so a task
    sends one row per key and no row travels whole.
    """
    others = [c for c in df.columns if c not in set(keys)]
    figures = [F.count(F.lit(1)).alias("rows")]
    differ = F.lit(False)
    for i, c in enumerate(others):
        form = comparable(df, c)
        figures += [F.min(form).alias(f"low{i}"), F.max(form).alias(f"high{i}"), F.count(ref(c)).alias(f"filled{i}")]
        some = (F.col(f"filled{i}") > 0) & (F.col(f"filled{i}") < F.col("rows"))
        differ = differ | some | F.coalesce(F.col(f"low{i}") != F.col(f"high{i}"), F.lit(False))
    named = [comparable(df, k).alias(f"k{i}") for i, k in enumerate(keys)]
    return df.groupBy(*named).agg(*figures).filter(differ).select(*[f"k{i}" for i in range(len(keys))], "rows")


def near_duplicate_rows(df: DataFrame, keys: Sequence[str], differing_only: bool = False) -> DataFrame:
    """The rows that share their key with another row; with ``differing_only``, with one that differs elsewhere.

    Keys are counted first (partial aggregation) and joined back; the counted side has one row per key, so a key
    that fills a third of the table is split by adaptive skew handling. A window per key would hold all its rows
    in one task.
    """
    if differing_only:
        wanted = _differing_keys(df, keys)
    else:
        named = [comparable(df, k).alias(f"k{i}") for i, k in enumerate(keys)]
        wanted = df.groupBy(*named).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    wanted = wanted.drop("rows")
    condition = F.lit(True)
    for i, k in enumerate(keys):
        condition = condition & comparable(df, k).eqNullSafe(F.col(f"k{i}"))
    return df.join(wanted, condition, "left_semi")


def differing_duplicates(df: DataFrame, t: Thresholds = DEFAULTS, keys: Sequence[str] | None = None) -> DataFrame:
    """Documented variant, one row: groups with equal keys whose rows differ in another column, and their rows."""
    keys = list(keys) if keys is not None else named_keys(df, t)
    return (
        _differing_keys(df, keys)
        .agg(F.count(F.lit(1)).alias("key_groups"), F.coalesce(F.sum("rows"), F.lit(0)).alias("affected_rows"))
        .select(F.lit(",".join(keys)).alias("key_columns"), "key_groups", "affected_rows")
    )
