"""Exact quantiles of any number of values."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.config import DEFAULTS, Thresholds
from plumbline.functions.numbers import finite, to_number
from plumbline.session import cut


# Size of the sketch, and the share of rows a bracket reaches on both sides of a probability: three times the rank error
# that a sketch of this size has in 99 of 100 cases.
_SKETCH, _REACH = 2048, 0.005


@dataclass(frozen=True)
class _Interval:
    """Closed range of values of one bracket: ``below`` rows of the column lie under it, ``rows`` in it."""

    bracket: int
    low: float
    high: float
    below: int
    rows: int


def exact_quantiles(
    df: DataFrame,
    values: Mapping[str, Column],
    probabilities: Sequence[float],
    bounds: Mapping[str, tuple[int, float, float]] | None = None,
    t: Thresholds = DEFAULTS,
) -> dict[str, list[float]]:
    """Linearly interpolated quantiles per value, NaN and infinities left out like nulls. ``bounds`` is what a caller knows
    of (count, min, max); columns whose count is 0 are not looked at.

    The table is read once to parse the numbers, which are written, and the numbers twice, whatever their distribution.
    A mergeable sketch (KLL) of every column gives a bracket around each probability, about a hundredth of the rows. The
    second pass counts the different values in the brackets and the rows below: fixed-width rows, a value that fills a
    third of the table being one. If a rank should lie outside of its bracket, that bracket is widened to the whole column.
    Within the counted values the ranks are found in ranges, so nothing is sorted in one task, and two rows per column
    and probability reach the driver.
    """
    names = [n for n in values if bounds is None or bounds[n][0]]
    if not names:
        return {}
    at = {n: i for i, n in enumerate(names)}
    read = cut(df.select(*[finite(values[n].cast("double")).alias(f"x{at[n]}") for n in names]))
    pairs = [x for i in at.values() for x in (F.lit(i), F.col(f"x{i}"))]
    stacked = read.select(F.stack(F.lit(len(names)), *pairs).alias("i", "x")).where("x is not null")
    ranks = F.array(*[F.lit(min(1.0, max(0.0, p + d))) for p in probabilities for d in (-_REACH, _REACH)])
    sketched = stacked.groupBy("i").agg(F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"), F.kll_sketch_agg_double("x", F.lit(_SKETCH)).alias("sketch"))
    known = {r["i"]: r for r in sketched.select("i", "n", "low", "high", F.kll_sketch_get_quantile_double("sketch", ranks).alias("ends")).collect()}
    # brackets by number: (place of the column, lowest and highest value)
    brackets: dict[int, tuple[int, float, float]] = {}
    open_ranks: dict[tuple[int, int], int] = {}
    for i, r in known.items():
        for k, p in enumerate(probabilities):
            low = r["low"] if p <= _REACH else r["ends"][2 * k]
            high = r["high"] if p >= 1 - _REACH else r["ends"][2 * k + 1]
            brackets[len(brackets)] = (i, low, high)
            for rank in _neighbours(r["n"], p):
                open_ranks[i, rank] = len(brackets) - 1
    found: dict[tuple[int, int], float] = {}
    while open_ranks:
        counted = _counted(read, {b: brackets[b] for b in set(open_ranks.values())})
        spans = {r["b"]: r for r in counted.groupBy("b").agg(F.sum(F.when(F.col("x").isNull(), F.col("cnt"))).alias("below"), F.sum(F.when(F.col("x").isNotNull(), F.col("cnt"))).alias("rows"), F.min("x").alias("low"), F.max("x").alias("high")).collect()}
        inside: dict[tuple[int, int], _Interval] = {}
        for key, b in list(open_ranks.items()):
            span = spans.get(b)
            below, rows = (span["below"] or 0, span["rows"] or 0) if span else (0, 0)
            if below <= key[1] < below + rows:
                inside[key] = _Interval(b, span["low"], span["high"], below, rows)
                del open_ranks[key]
            else:  # the sketch was further off than it should be
                brackets[len(brackets)] = (key[0], known[key[0]]["low"], known[key[0]]["high"])
                open_ranks[key] = len(brackets) - 1
        found |= _located(counted.where("x is not null"), inside, t)
    return {n: _between(found, at[n], known[at[n]]["n"], probabilities) for n in names if at[n] in known}


def counted_quantiles(
    counted: DataFrame, columns: Sequence[str], probabilities: Sequence[float], t: Thresholds = DEFAULTS
) -> dict[str, list[float]]:
    """The same for columns whose values are counted: nothing but the different numbers and their counts is read, so one
    interval holds a whole column from the start."""
    if not columns:
        return {}
    at = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)]), F.col("column"))
    numbers = counted.where(F.col("column").isin(list(columns))).select(at.alias("b"), to_number(F.col("value")).alias("x"), "cnt")
    stored = cut(numbers.where("x is not null").groupBy("b", "x").agg(F.sum("cnt").alias("cnt")))
    spans = {r["b"]: r for r in stored.groupBy("b").agg(F.sum("cnt").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()}
    wanted = {
        (b, rank): _Interval(b, r["low"], r["high"], 0, r["n"]) for b, r in spans.items() for p in probabilities for rank in _neighbours(r["n"], p)
    }
    found = _located(stored, wanted, t)
    return {c: _between(found, b, spans[b]["n"], probabilities) for b, c in enumerate(columns) if b in spans}


def _between(found: Mapping[tuple[int, int], float], place: int, count: int, probabilities: Sequence[float]) -> list[float]:
    """The quantiles of a column from the values at the ranks beside them."""
    out = []
    for p in probabilities:
        low, high = _neighbours(count, p)
        h = (count - 1) * p
        a, b = found[place, low], found[place, high]
        out.append(a + (b - a) * (h - math.floor(h)))
    return out


def _counted(read: DataFrame, brackets: Mapping[int, tuple[int, float, float]]) -> DataFrame:
    """(b, x, cnt): the different values in each bracket; null stands for all rows below it. Stored.

    A value is compared with the brackets of its own column only."""
    seen = []
    for b in sorted(brackets):
        i, low, high = brackets[b]
        x = F.col(f"x{i}")
        seen.append(F.when(x <= high, F.struct(F.lit(b).alias("b"), F.when(x >= low, x).alias("x"))))
    rows = read.select(F.inline(F.array_compact(F.array(*seen)))).select("b", "x")
    return cut(rows.groupBy("b", "x").agg(F.count(F.lit(1)).alias("cnt")))


def _located(counted: DataFrame, ranks: dict[tuple[int, int], _Interval], t: Thresholds) -> dict[tuple[int, int], float]:
    """The value at each rank, by cutting its interval into ranges until the interval alone tells it."""
    found: dict[tuple[int, int], float] = {}
    while ranks:
        for key, part in list(ranks.items()):
            edge = _edge(part, key[1])
            if edge is not None:
                found[key] = edge
                del ranks[key]
        if not ranks:
            break
        wanted: dict[_Interval, list[int]] = {}
        for (_, rank), part in ranks.items():
            wanted.setdefault(part, []).append(rank)
        parts = _split(counted, wanted, t)
        ranks = {key: next(s for s in parts[i] if s.below <= key[1] < s.below + s.rows) for key, i in ranks.items()}
    return found


def _neighbours(n: int, p: float) -> tuple[int, int]:
    h = math.floor((n - 1) * p)
    return h, min(h + 1, n - 1)


def _edge(part: _Interval, rank: int) -> float | None:
    """The value at a rank if the interval alone tells it."""
    if part.low == part.high or rank == part.below:
        return part.low
    return part.high if rank == part.below + part.rows - 1 else None


def _scaled(x: Column, part: _Interval) -> tuple[Column, float, float]:
    """Value and ends of an interval on the scale it is cut on.

    Wide intervals are cut on a logarithmic scale: a few huge values would otherwise leave all others in one range
    for many passes. The scale keeps the order of values.
    """
    low, high = (math.copysign(math.log1p(abs(v)), v) for v in (part.low, part.high))
    if part.high / 2 - part.low / 2 > 5e5 and high - low > 1e-3:
        return F.signum(x) * F.log1p(F.abs(x)), low, high
    return x, part.low, part.high


def _split(counted: DataFrame, wanted: Mapping[_Interval, Sequence[int]], t: Thresholds) -> dict[_Interval, list[_Interval]]:
    """The parts of each interval that hold its wanted ranks, in order; from one pass over the counted values.

    Intervals of few rows are cut into their distinct values. Every pass puts the ends of a range into different
    parts, so ranges always shrink."""
    intervals = list(wanted)
    pairs = []
    for i, part in enumerate(intervals):
        x = F.col("x")
        x_scaled, low, high = _scaled(x, part)
        if part.rows <= t.quantile_rows or not high / 2 - low / 2 > 0:
            bucket = x
        else:
            # halved, so that the width of the widest interval is still a finite number
            bucket = F.floor((x_scaled / 2 - low / 2) / (high / 2 - low / 2) * (t.quantile_buckets - 1)).cast("double")
        pairs += [F.lit(i), x, F.col("cnt"), F.when((F.col("b") == part.bracket) & x.between(part.low, part.high), bucket)]
    in_order = Window.partitionBy("i").orderBy("bucket")
    ranks = F.array(*[F.array(*[F.lit(r - part.below) for r in wanted[part]]).cast("array<bigint>") for part in intervals])
    hits = (
        counted.select(F.stack(F.lit(len(intervals)), *pairs).alias("i", "x", "cnt", "bucket"))
        .filter("bucket IS NOT NULL")
        .groupBy("i", "bucket")
        .agg(F.sum("cnt").alias("rows"), F.min("x").alias("low"), F.max("x").alias("high"))
        # At most as many rows per interval as it is cut into.
        .withColumn("upto", F.sum("rows").over(in_order))
        .filter(F.exists(F.get(ranks, F.col("i")), lambda r: (r >= F.col("upto") - F.col("rows")) & (r < F.col("upto"))))
        .collect()
    )
    out: dict[_Interval, list[_Interval]] = {part: [] for part in intervals}
    for r in sorted(hits, key=lambda r: (r["i"], r["upto"])):
        part = intervals[r["i"]]
        out[part].append(_Interval(part.bracket, r["low"], r["high"], part.below + r["upto"] - r["rows"], r["rows"]))
    return out
