"""Value counts of columns of any cardinality, without moving their text.

A cell travels as two 64-bit hashes of its value and a few figures of fixed width; equal cells collapse inside each task.
Text is only fetched for the few values that are shown, and only for columns above a bound: below it the values of a
column are a small domain and are counted as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.config import DEFAULTS, Thresholds
from plumbline.functions.text import ref
from plumbline.operators.cells import cells, columns_of, common_first, empty
from plumbline.operators.scan import Scan, scan
from plumbline.session import cut

# Any constant; it makes the second hash independent of the first.
_SECOND = 0x5BD1E995


def gated(df: DataFrame, columns: Sequence[str] | None = None, t: Thresholds = DEFAULTS, seen: Scan | None = None) -> tuple[list[str], list[str]]:
    """(columns of small domains, all others), by the sketch of one pass over the table."""
    columns = columns_of(df, columns)
    if not columns:
        return [], []
    seen = seen or scan(df, ("about_distinct",), columns)
    small = [c for c in columns if seen.of(c, "about_distinct") <= t.text_values]
    return small, [c for c in columns if c not in set(small)]


def value_digest(value: Column) -> list[Column]:
    """Two hashes of a value, null where it is."""
    return [F.when(value.isNotNull(), h) for h in (F.xxhash64(value), F.xxhash64(F.lit(_SECOND), value))]


def _hashed(df: DataFrame, columns: Sequence[str], counted: DataFrame | None = None) -> DataFrame:
    hashes = value_digest(F.col("value"))
    at = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)]), F.col("column"))
    source, more = (cells(df, columns), []) if counted is None else (counted, ["cnt"])
    return source.select(at.alias("at"), hashes[0].alias("h1"), hashes[1].alias("h2"), "value", *more)


def digest_counts(
    df: DataFrame, columns: Sequence[str], figures: Mapping[str, Column] | None = None, prepare: Callable[[DataFrame], DataFrame] = lambda cells: cells,
    counted: DataFrame | None = None,
) -> DataFrame:
    """(at, h1, h2, cnt, then ``figures``): one row for each value of each column, nulls included.

    ``at`` is the place of the column in ``columns``. ``figures`` are expressions of fixed width over ``value`` and what
    ``prepare`` adds to the cells. Values are told apart by 128 bits, so two of 10^12 values of a column meet with a
    probability of about 10^-15. ``counted`` are the ``counted_cells`` of ``columns``."""
    figures = figures or {}
    cnt = F.count(F.lit(1)) if counted is None else F.sum("cnt")
    marked = prepare(_hashed(df, columns, counted)).select("at", "h1", "h2", *([] if counted is None else ["cnt"]), *[c.alias(n) for n, c in figures.items()])
    return marked.groupBy("at", "h1", "h2").agg(cnt.alias("cnt"), *[F.first(n).alias(n) for n in figures])


def commonest(df: DataFrame, counts: DataFrame, columns: Sequence[str], k: int, sample: int = 1024) -> DataFrame:
    """(column, value, cnt) with at least the ``k`` commonest values of each column, of equally common ones the smallest.

    ``counts`` are the stored ``digest_counts`` of ``columns``. Fewer than ``k`` values are commoner than the k-th; those that
    tie with it may be very many (all, in a column without repeats). Where they are, a sample of the tied values by hash
    gives an upper bound of the smallest ones, and only cells up to that bound are counted as text: about k / ``sample`` of
    the values. The bound holds at least ``k`` tied values, so the result is exact."""
    if not columns:
        return empty(df, "`column` string, value string, cnt bigint")
    filled = counts.where(F.col("h1").isNotNull())
    by_count = filled.groupBy("at", "cnt").agg(F.count(F.lit(1)).alias("held"))
    w = Window.partitionBy("at").orderBy(F.desc("cnt"))
    upto = F.sum("held").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # At most k rows a column, from the counts that occur.
    top = by_count.withColumn("before", upto - F.col("held")).where(F.col("before") < k).groupBy("at").agg(F.min("cnt").alias("least"), F.min_by("held", "cnt").alias("ties"), F.max("before").alias("above")).collect()
    limits = {r["at"]: r for r in top}
    if not limits:
        return empty(df, "`column` string, value string, cnt bigint")
    crowded = [at for at, r in limits.items() if r["ties"] > sample]

    def of(figure: str) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for at, r in limits.items() for x in (at, r[figure])]), F.col("at"))

    tied, picked = F.col("cnt") == of("least"), F.lit(True)
    if crowded:
        rate = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for at in crowded for x in (at, limits[at]["ties"] // sample + 1)]), F.col("at")), F.lit(1))
        picked = F.pmod(F.col("h2"), rate) == 0
    wanted = filled.where((F.col("cnt") > of("least")) | (tied & picked)).select("at", "h1", "h2", "cnt")
    # Bounded by ``k`` and about ``sample`` rows a column; the cells of a wanted value collapse inside each task.
    found = _hashed(df, columns).join(F.broadcast(wanted), ["at", "h1", "h2"]).groupBy("at", "value").agg(F.first("cnt").alias("cnt"))
    names = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (i, c)]), F.col("at")).alias("column")
    if not crowded:
        return found.select(names, "value", "cnt")
    needed = {at: k - limits[at]["above"] for at in crowded}
    order = Window.partitionBy("at").orderBy("value")
    need = F.element_at(F.create_map(*[F.lit(x) for at, n in needed.items() for x in (at, n)]), F.col("at"))
    tied_rows = found.where(F.col("at").isin(crowded) & tied)
    bounds = {r["at"]: r["value"] for r in tied_rows.withColumn("rn", F.row_number().over(order)).where(F.col("rn") == need).select("at", "value").collect()}
    # A sample may hold too few (it is a matter of hashes): then the whole column is counted.
    below = None
    for at in crowded:
        hit = F.col("column") == columns[at]
        if at in bounds:
            hit &= F.col("value") <= bounds[at]
        below = hit if below is None else below | hit
    counted = cells(df, [columns[at] for at in crowded]).where(F.col("value").isNotNull() & below).groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    least = F.element_at(F.create_map(*[F.lit(x) for at in crowded for x in (columns[at], limits[at]["least"])]), F.col("column"))
    others = found.where(~(F.col("at").isin(crowded) & tied)).select(names, "value", "cnt")
    return others.unionByName(counted.where(F.col("cnt") == least))


def common_examples(df: DataFrame, counts: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """(column, examples): the ``k`` commonest values of each column, then the smallest."""
    return common_first(commonest(df, counts, columns, k), k)


def cardinalities(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Exact number of different filled values of each column: one row for each value travels, of fixed width."""
    if not columns:
        return {}
    found = digest_counts(df, columns).groupBy("at").agg(F.count("h1").alias("n")).collect()
    return {c: 0 for c in columns} | {columns[r["at"]]: r["n"] for r in found}


def row_digest(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two hashes of a row's values in ``columns``; where nulls stand counts."""
    parts = [x for c in columns for x in (ref(c).isNull(), ref(c))]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(_SECOND), *parts)]


def spelled_differently(df: DataFrame, columns: Sequence[str], key: Callable[[Column], Column]) -> DataFrame:
    """(column, value, cnt) of the values that share ``key`` with another value of their column.

    The first pass keeps, for each hashed key, the smallest and largest hash of the values under it: fixed width, and
    copies collapse inside each task. Only keys under which these differ are looked up, and only the text of their
    values is counted. The keys are written, so the optimiser knows their size."""
    schema = "`column` string, value string, cnt bigint"
    if not columns:
        return empty(df, schema)
    value = F.col("value")
    folded = key(value)

    def keyed(frame: DataFrame) -> DataFrame:
        return frame.where(value.isNotNull()).withColumn("k", folded).withColumns({"k1": F.xxhash64("k"), "k2": F.xxhash64(F.lit(_SECOND), F.col("k"))}).drop("k")

    hashes = keyed(_hashed(df, columns)).groupBy("at", "k1", "k2").agg(*[f(h).alias(f"{n}{h}") for h in ("h1", "h2") for n, f in (("low", F.min), ("high", F.max))])
    varied = cut(hashes.where("lowh1 <> highh1 or lowh2 <> highh2").select("at", "k1", "k2"))
    held = sorted(r["at"] for r in varied.select("at").distinct().collect())
    if not held:
        return empty(df, schema)
    some = [columns[i] for i in held]
    at = F.element_at(F.create_map(*[F.lit(x) for i in held for x in (columns[i], i)]), F.col("column"))
    texts = keyed(cells(df, some)).withColumn("at", at).join(varied, ["at", "k1", "k2"], "left_semi")
    return texts.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
