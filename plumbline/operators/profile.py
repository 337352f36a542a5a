"""Column profiles: counts, distinct values and an inferred semantic type."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import BOOLEAN_WORDS, DEFAULTS, Thresholds
from plumbline.functions import names
from plumbline.functions.dates import LAYOUT_NAMES, with_dates
from plumbline.functions.numbers import pct, rounded, share, to_number
from plumbline.operators.cells import columns_of, common_first, empty, ordinal
from plumbline.operators.counted import counted_cells, counts_of, of_columns
from plumbline.operators.digests import common_examples, digest_counts, gated
from plumbline.operators.scan import Scan, scan
from plumbline.session import cut


def date_cells(t: Thresholds = DEFAULTS) -> Column:
    """Aggregate over rows (layout, dates), one per layout: the number of date cells.

    "dominant" counts the commonest format only, "any" counts every readable cell.
    """
    total = F.sum("dates") if t.date_policy == "any" else F.max("dates")
    return F.coalesce(total, F.lit(0))


def semantic_type(t: Thresholds = DEFAULTS) -> Column:
    """Type of a profiled column; the first rule that holds wins."""
    return (
        F.when(F.col("non_null") == 0, "text")
        .when((F.col("cardinality") <= t.boolean_max_distinct) & F.col("all_boolean"), "boolean")
        .when(
            (F.col("cardinality_ratio") > t.identifier_ratio) & (F.col("cardinality") > t.identifier_min_distinct),
            "identifier",
        )
        .when(F.col("numeric_ratio") >= t.numeric_ratio, "numeric")
        .when(F.col("date_ratio") >= t.date_ratio, "date")
        .when(F.col("cardinality_ratio") < t.categorical_ratio, "categorical")
        .otherwise("text")
    )


def _read(values: DataFrame) -> DataFrame:
    """``values`` with ``number`` and, for cells that are none, what ``with_dates`` adds: no number looks like a date."""
    numbered = values.withColumn("number", to_number(F.col("value")).isNotNull())
    return with_dates(numbered.withColumn("worded", F.when(~F.col("number"), F.col("value"))), "worded")


def _cell_figures() -> dict[str, Column]:
    """What a profile needs of a value, over the columns of ``_read``; each of fixed width."""
    value = F.col("value")
    return {
        "filled": value.isNotNull(),
        "boolean": F.lower(value).isin(*BOOLEAN_WORDS),
        "number": F.col("number"),
        "dated": F.col("date").isNotNull(),
        "layout": F.array_position(F.array(*[F.lit(n) for n in LAYOUT_NAMES]), F.col("layout")),
        "chars": F.length(value),
    }


def profile_columns(
    df: DataFrame, t: Thresholds = DEFAULTS, columns: Sequence[str] | None = None, samples: bool = True,
    counted: DataFrame | None = None, seen: Scan | None = None,
) -> DataFrame:
    """One row per column.

    Columns of small domains are counted as text, so parsing and date matching run once per value. All others are
    counted by digests: their cells travel as two hashes and figures of fixed width, and text is fetched for the sample
    values alone. Distinct counts are exact for both. ``counted`` are the ``counted_cells`` of the table, ``seen`` is a scan
    of it with estimates of the distinct values.
    """
    columns = columns_of(df, columns)
    kinds = dict(df.dtypes)
    if seen is None and columns:
        seen = scan(df, ("about_distinct",), columns, counted)
    small, large = gated(df, columns, t, seen)
    counts = counts_of(df, small, counted) if small else empty(df, "`column` string, value string, cnt bigint")
    cnt, cell_figures = F.col("cnt"), _cell_figures()
    marked = _read(counts).select("column", "cnt", *[c.alias(n) for n, c in cell_figures.items()])
    by_digest = None
    if large:
        by_digest = cut(digest_counts(df, large, cell_figures, _read, counted_cells(df, large, t, seen) if counted is None else of_columns(counted, large)))
        name = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(large) for x in (i, c)]), F.col("at")).alias("column")
        marked = marked.unionByName(by_digest.select(name, "cnt", *cell_figures))
    # First per column and date layout, at most a dozen groups each, then per column.
    per_layout = marked.groupBy("column", "layout").agg(
        F.sum("cnt").alias("row_count"),
        F.sum(F.when(F.col("filled"), cnt).otherwise(0)).alias("non_null"),
        F.count_if("filled").alias("cardinality"),
        F.bool_and("boolean").alias("all_boolean"),
        F.sum(F.when(F.col("number"), cnt).otherwise(0)).alias("numbers"),
        F.sum(F.when(F.col("dated"), cnt).otherwise(0)).alias("dates"),
        F.sum(F.col("chars") * cnt).alias("chars"),
    )
    figures = (
        per_layout.groupBy("column")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.sum("non_null").alias("non_null"),
            F.sum("cardinality").alias("cardinality"),
            F.coalesce(F.bool_and("all_boolean"), F.lit(False)).alias("all_boolean"),
            share(F.sum("numbers"), F.sum("non_null")).alias("numeric_ratio"),
            share(date_cells(t), F.sum("non_null")).alias("date_ratio"),
            share(F.sum("chars"), F.sum("non_null")).alias("avg_length"),
        )
        .withColumn("ordinal", ordinal(columns))
        .withColumn("dtype", F.element_at(F.create_map(*[F.lit(x) for c in columns for x in (c, kinds[c])]), F.col("column")))
        .withColumn("null_count", F.col("row_count") - F.col("non_null"))
        .withColumn("null_pct", F.coalesce(pct(F.col("null_count"), F.col("row_count")), F.lit(0.0)))
        .withColumn(
            "cardinality_ratio",
            F.coalesce(rounded(share(F.col("cardinality"), F.col("row_count")), 4), F.lit(0.0)),
        )
        .withColumn("semantic_type", semantic_type(t))
    )
    out = [
        "column", "ordinal", "dtype", "semantic_type", "row_count", "null_count", "null_pct", "cardinality",
        "cardinality_ratio", "numeric_ratio", "date_ratio", "avg_length",
    ]
    if not samples:
        return figures.select(*out)
    first = common_first(counts, t.examples)
    if large:
        first = first.unionByName(common_examples(df, by_digest, large, t.examples))
    # one row per column on both sides
    return figures.join(F.broadcast(first), "column", "left").select(
        *out, F.coalesce(F.col("examples"), F.array().cast("array<string>")).alias("sample_values")
    )


@dataclass(frozen=True)
class ColumnProfile:
    column: str
    semantic_type: str
    row_count: int
    null_count: int
    null_pct: float
    cardinality: int
    cardinality_ratio: float
    numeric_ratio: float
    date_ratio: float
    avg_length: float
    samples: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableProfile:
    """A profile read to the driver: one entry per column."""

    columns: dict[str, ColumnProfile] = field(default_factory=dict)
    row_count: int = 0

    def of(self, column: str) -> ColumnProfile | None:
        """Profile of a column, also under the name it got from a later rename."""
        known = names.resolve(column, self.columns)
        return self.columns[known] if known is not None else None

    def typed(self, *types: str) -> list[str]:
        return [c for c, p in self.columns.items() if p.semantic_type in types]


def take_profile(profile: DataFrame, columns: Sequence[str] | None = None) -> TableProfile:
    """Read a profile frame. An empty table has no cells, so its columns are filled in as empty text."""
    rows = sorted(profile.collect(), key=lambda r: r["ordinal"])
    entries = {
        r["column"]: ColumnProfile(
            r["column"], r["semantic_type"], r["row_count"], r["null_count"], r["null_pct"], r["cardinality"],
            r["cardinality_ratio"], r["numeric_ratio"] or 0.0, r["date_ratio"] or 0.0, r["avg_length"] or 0.0,
            tuple(r["sample_values"]) if "sample_values" in r else (),
        )
        for r in rows
    }
    for c in columns or ():
        entries.setdefault(c, ColumnProfile(c, "text", 0, 0, 0.0, 0, 0.0, 0.0, 0.0, 0.0))
    return TableProfile(entries, max((p.row_count for p in entries.values()), default=0))


def profile_table(df: DataFrame, t: Thresholds = DEFAULTS, samples: bool = False, counted: DataFrame | None = None) -> TableProfile:
    return take_profile(profile_columns(df, t, samples=samples, counted=counted), columns_of(df, None))


def profile_summary(profile: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """One row over a profile: type lists, overall completeness and columns to look at."""

    def listed(condition: Column) -> Column:
        pairs = F.collect_list(F.when(condition, F.struct("ordinal", "column")))
        return F.transform(F.sort_array(pairs), lambda p: p["column"])

    kind = F.col("semantic_type")
    complete = F.coalesce(F.avg(F.lit(100.0) - F.col("null_pct")), F.lit(100.0))
    return profile.agg(
        F.count(F.lit(1)).alias("total_columns"),
        F.coalesce(F.max("row_count"), F.lit(0)).alias("total_rows"),
        rounded(complete / 100.0, 4).alias("overall_completeness"),
        rounded(complete, 2).alias("overall_completeness_pct"),
        listed(kind == "numeric").alias("numeric_columns"),
        listed(kind.isin("categorical", "text", "identifier", "boolean")).alias("categorical_columns"),
        listed(kind == "date").alias("date_columns"),
        listed(F.col("null_pct") > t.high_missing_pct).alias("high_missing_columns"),
        listed(F.col("null_pct") > t.ultra_sparse * 100).alias("ultra_sparse_columns"),
        listed(F.col("cardinality_ratio") > t.identifier_ratio).alias("possible_identifier_columns"),
    )
