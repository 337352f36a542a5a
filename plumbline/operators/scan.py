"""Single-pass figures per column, shared by the checks that start from them."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.dates import is_period
from plumbline.functions.numbers import to_number
from plumbline.operators.cells import columns_of, numbered_cells

# Examples found while counting: the smallest value of each of this many classes. Unlike the smallest values overall they
# need no sorting, and a task sends one row of fixed width.
EXAMPLE_CLASSES = 5


def example_class(c: Column) -> Column:
    return F.pmod(F.floor(c), F.lit(EXAMPLE_CLASSES))


def _whole() -> Column:
    return F.col("x").try_cast("long")


# figure -> aggregate over the cells of a column: ``filled``, ``value`` and its numeric reading ``x``
_FIGURES: dict[str, Callable[[], Column]] = {
    "filled": lambda: F.count_if("filled"),
    "numbers": lambda: F.count("x"),
    "periods": lambda: F.count_if(is_period(F.col("x"))),
    "negatives": lambda: F.count_if(F.col("x") < 0),
    "wholes": lambda: F.count(_whole()),
    "years": lambda: F.count_if(_whole().between(1900, 2100)),
    "months": lambda: F.count_if(_whole().between(1, 12)),
    "min": lambda: F.min("x"),
    "max": lambda: F.max("x"),
    "mean": lambda: F.avg("x"),
    "std": lambda: F.stddev_samp("x"),
    "std_population": lambda: F.stddev_pop("x"),
    # Estimates narrow candidates down; exact counts decide.
    "about_distinct": lambda: F.approx_count_distinct("value"),
    "about_numbers": lambda: F.approx_count_distinct("x"),
} | {
    f"negative_{i}": lambda i=i: F.min(F.when((F.col("x") < 0) & (example_class(F.col("x")) == i), F.col("x")))
    for i in range(EXAMPLE_CLASSES)
}
NEGATIVE_EXAMPLES = tuple(f for f in _FIGURES if f.startswith("negative_"))
PERIOD_FIGURES = ("filled", "numbers", "periods", "wholes", "years", "months")
_MOMENTS = ("mean", "std", "std_population")
ALL = tuple(f for f in _FIGURES if f not in (*NEGATIVE_EXAMPLES, "wholes", "years", "months"))


def _cells_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("cnt"))), F.lit(0))


# The figures that count cells, over counted cells. Extremes and sketches are the same over values as over cells.
_COUNTED: dict[str, Callable[[], Column]] = {
    "filled": lambda: _cells_where(F.col("filled")),
    "numbers": lambda: _cells_where(F.col("x").isNotNull()),
    "periods": lambda: _cells_where(is_period(F.col("x"))),
    "negatives": lambda: _cells_where(F.col("x") < 0),
    "wholes": lambda: _cells_where(_whole().isNotNull()),
    "years": lambda: _cells_where(_whole().between(1900, 2100)),
    "months": lambda: _cells_where(_whole().between(1, 12)),
}


def counted_columns(counted: DataFrame | None) -> frozenset[str]:
    """The columns whose values ``counted_cells`` has counted; the cells of all others stand in it one by one."""
    return getattr(counted, "counted_columns", frozenset())


def counted_among(df: DataFrame, columns: Sequence[str], counted: DataFrame | None) -> list[str]:
    """The counted columns among some whose text is read as the number they hold; single precision is printed shorter."""
    known = counted_columns(counted)
    return [c for c in columns if c in known and not isinstance(df.schema[c].dataType, T.FloatType)]


def _weighted_mean() -> Column:
    return F.try_divide(F.sum(F.col("x") * F.col("cnt")), _cells_where(F.col("x").isNotNull()).cast("double"))


def _moments(read: DataFrame, rows: Sequence[Any]) -> list[dict[str, float | None]]:
    """Mean and deviations of the columns of ``rows`` over counted cells. Differences to the mean of a first pass are
    added up, so nothing is lost where a column lies far from zero."""
    about = {r["column"]: r["about mean"] for r in rows if r["about mean"] is not None}
    sums: dict[str, Any] = {}
    if about:
        centre = F.element_at(F.create_map(*[F.lit(x) for pair in about.items() for x in pair]), F.col("column"))
        off = read.where(F.col("column").isin(list(about)) & F.col("x").isNotNull()).withColumn("off", F.col("x") - centre)
        weighted = (F.sum("cnt").alias("n"), F.sum(F.col("off") * F.col("cnt")).alias("s1"), F.sum(F.col("off") * F.col("off") * F.col("cnt")).alias("s2"))
        sums = {r["column"]: r for r in off.groupBy("column").agg(F.min("x").alias("low"), F.max("x").alias("high"), *weighted).collect()}
    out: list[dict[str, float | None]] = []
    for r in rows:
        s = sums.get(r["column"])
        if s is None:
            out.append(dict.fromkeys(_MOMENTS))
            continue
        n = s["n"]
        same = s["low"] == s["high"]
        squares = 0.0 if same else max(s["s2"] - s["s1"] * s["s1"] / n, 0.0)
        mean = s["low"] if same else about[r["column"]] + s["s1"] / n
        out.append({"mean": mean, "std": math.sqrt(squares / (n - 1)) if n > 1 else None, "std_population": math.sqrt(squares / n)})
    return out


@dataclass(frozen=True)
class Scan:
    rows: int
    columns: tuple[str, ...]
    values: dict[str, dict[str, Any]]

    def of(self, column: str, figure: str) -> Any:
        return self.values[column][figure]

    def numeric_ratio(self, column: str) -> float | None:
        """Share of numbers among the filled cells, None for an empty column."""
        filled = self.of(column, "filled")
        return self.of(column, "numbers") / filled if filled else None


def scan(
    df: DataFrame, figures: Sequence[str] = ALL, columns: Sequence[str] | None = None, counted: DataFrame | None = None
) -> Scan:
    """One pass over the table, one row per column from every task.

    The cells are aggregated by column, so the generated code and the aggregation buffer are those of one column,
    however wide the table is. ``counted``, the ``counted_cells`` of the table, spares its counted columns the pass, and
    all text columns where no mean or deviation is asked for.
    """
    columns = columns_of(df, columns)
    if not columns:
        return Scan(df.count(), (), {})
    text = counted_among(df, columns, counted)
    moments = [f for f in figures if f in _MOMENTS]
    if counted is not None and not moments:
        text += [c for c in columns if c not in set(text) and isinstance(df.schema[c].dataType, T.StringType)]
    found: list[Any] = []
    if text:
        read = counted.where(F.col("column").isin(text)).select("column", "cnt", "value", to_number(F.col("value")).alias("x"), F.col("value").isNotNull().alias("filled"))
        asked = [f for f in figures if f not in moments]
        by_value = [(_COUNTED[f]() if f in _COUNTED else _FIGURES[f]()).alias(f) for f in asked]
        rows = read.groupBy("column").agg(F.sum("cnt").alias("rows"), *by_value, *([_weighted_mean().alias("about mean")] if moments else [])).collect()
        found += [r.asDict() | spread for r, spread in zip(rows, _moments(read, rows) if moments else [{}] * len(rows))]
    if others := [c for c in columns if c not in set(text)]:
        found += (
            numbered_cells(df, others, print_numbers="about_distinct" in figures)
            .groupBy("column")
            .agg(F.count(F.lit(1)).alias("rows"), *[_FIGURES[f]().alias(f) for f in figures])
            .collect()
        )
    values = {r["column"]: {f: r[f] for f in figures} for r in found}
    counts = ("filled", "numbers", "periods", "negatives", "wholes", "years", "months", "about_distinct", "about_numbers")
    nothing = {f: 0 if f in counts else None for f in figures}
    return Scan(
        max((r["rows"] for r in found), default=0), tuple(columns), {c: values.get(c, nothing) for c in columns}
    )
