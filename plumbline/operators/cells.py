"""The two shapes every check is built on: one aggregate over all columns, and (column, value) cells."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.numbers import finite, to_number
from plumbline.functions.text import ref
from plumbline.session import compiled
from plumbline.sources.tables import scalar_columns, text_layer


def number_of(df: DataFrame, name: str) -> Column:
    """Numeric reading of a column; only text needs the guarded parse."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return finite(ref(name).cast("double"))
    return to_number(ref(name) if isinstance(kind, T.StringType) else ref(name).cast("string"))


def columns_of(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return list(columns) if columns is not None else scalar_columns(df)


def measure(df: DataFrame, metrics: Mapping[str, Column], per_pass: int = 240) -> dict[str, Any]:
    """Named aggregates of a whole table, read to the driver: one value per name, so bounded by the names.

    Aggregation is partial in every task. Very wide sets are split over passes, which keeps the generated code
    within what the JVM compiles.
    """
    names = list(metrics)
    compiled(df.sparkSession)
    out: dict[str, Any] = {}
    for start in range(0, len(names), per_pass):
        chunk = names[start : start + per_pass]
        row = df.agg(*[metrics[n].alias(f"m{i}") for i, n in enumerate(chunk)]).first()
        out.update({n: row[f"m{i}"] for i, n in enumerate(chunk)})
    return out


def per_column(df: DataFrame, columns: Sequence[str], metrics: Mapping[str, Any]) -> DataFrame:
    """One row per column from one aggregate over the table.

    ``metrics`` maps a result name to a function from column name to aggregate. The plan is a single partial
    aggregate with one row per task, so nothing but that row is shuffled.
    """
    aggregates = [
        make(c).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, make in metrics.items()
    ]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(i).alias("ordinal"),
            *[F.col(f"{name}_{i}").alias(name) for name in metrics],
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value) for every cell, nulls included."""
    columns = columns_of(df, columns)
    layer = text_layer(df.select(*[ref(c) for c in columns]))
    return layer.unpivot([], [ref(c) for c in columns], "column", "value")


def numbered_cells(df: DataFrame, columns: Sequence[str] | None = None, print_numbers: bool = True) -> DataFrame:
    """(column, filled, value, x): cells with their numeric reading.

    Numeric columns bring it along, text is parsed once. NaN is a missing cell, infinity a cell that is no number. Without ``print_numbers`` numeric columns get no text in
    ``value``, which saves the slow conversion.
    """
    columns = columns_of(df, columns)
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    parts = []
    for c in columns:
        native = isinstance(df.schema[c].dataType, T.NumericType)
        text = no_text if native and not print_numbers else ref(c).cast("string")
        filled = ref(c).isNotNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            filled = filled & ~F.isnan(ref(c))
            text = F.when(filled, text)
        parts += [F.lit(c), filled, text, finite(ref(c).cast("double")) if native else no_number]
    stacked = df.select(F.stack(F.lit(len(columns)), *parts).alias("column", "filled", "value", "native"))
    return stacked.select("column", "filled", "value", F.coalesce("native", to_number(F.col("value"))).alias("x"))


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, cnt). Copies collapse inside each task, so a value that fills a third of the table
    travels as one row per task."""
    return cells(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))


def ordinal(columns: Iterable[str], c: Column | None = None) -> Column:
    """Position of a column in the table."""
    pairs = [F.lit(x) for i, name in enumerate(columns) for x in (name, i)]
    return F.element_at(F.create_map(*pairs), F.col("column") if c is None else c)


def top_values(counts: DataFrame, k: int, by: Sequence[Column], group: str = "column", value: str = "value") -> DataFrame:
    """(group, examples): the first ``k`` non-null values of each group. Each task cuts its part to ``k`` rows per
    group before the shuffle."""
    # Nulls are ranked last and dropped afterwards; filtering them first would keep the value counts from being
    # shared with other uses in the same plan.
    w = Window.partitionBy(group).orderBy(F.col(value).isNull(), *by)
    return (
        counts.withColumn("rn", F.row_number().over(w))
        .filter(F.col("rn") <= k)
        .groupBy(group)
        .agg(F.sort_array(F.collect_list(F.struct("rn", F.col(value).alias("v")))).alias("s"))
        .select(group, F.filter(F.col("s.v"), lambda v: v.isNotNull()).alias("examples"))
    )


def common_first(counts: DataFrame, k: int) -> DataFrame:
    return top_values(counts, k, [F.desc("cnt"), F.asc("value")])


def empty(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def small_frame(df: DataFrame, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Frame of a few driver-side rows (at most one per column, pair of columns or stage)."""
    return df.sparkSession.createDataFrame(list(rows), schema)
