"""Schema checks: contaminated types, column names, columns that repeat each other."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DEFAULTS, Thresholds
from plumbline.functions import names
from plumbline.functions.dates import with_dates
from plumbline.functions.numbers import pct, rounded, share, to_number
from plumbline.functions.text import drop_separators, fold, is_placeholder, ref, strip
from plumbline.operators.cells import cells, columns_of, common_first, empty, measure, small_frame
from plumbline.operators.counted import counted_cells, of_columns, one_by_one, total
from plumbline.operators.profile import date_cells
from plumbline.session import cut
from plumbline.sources.tables import text_layer


def contamination_severity(rate: Column) -> Column:
    return F.when(rate > 10, "CRITICAL").when(rate >= 1, "MODERATE").otherwise("MINOR")


def _with_examples(found: DataFrame, bad_cells: DataFrame, t: Thresholds) -> DataFrame:
    """Attach the commonest bad values. ``found`` has one row per flagged column, ``bad_cells`` counts of bad cells only."""
    counts = bad_cells.groupBy("column", "value").agg(F.sum("cnt").alias("cnt"))
    return found.join(F.broadcast(common_first(counts, t.examples)), "column", "left")


def type_contamination(df: DataFrame, t: Thresholds = DEFAULTS, examples: bool = True, counted: DataFrame | None = None) -> DataFrame:
    """Mostly numeric columns with values that are no number.

    ``bad_count`` includes placeholders; a column is reported only if something other than placeholders is bad.
    ``counted`` are the ``counted_cells`` of the table.
    """
    read = (
        (one_by_one(df) if counted is None else counted)
        .withColumn("bad", F.col("value").isNotNull() & to_number(F.col("value")).isNull())
        .withColumn("odd", F.col("bad") & ~is_placeholder(strip(F.col("value"))))
    )
    found = (
        read.groupBy("column")
        .agg(
            F.sum("cnt").alias("row_count"),
            total(F.col("value").isNotNull()).alias("non_null"),
            total(F.col("bad")).alias("bad_count"),
            total(F.col("odd")).alias("odd_count"),
        )
        .filter(share(F.col("non_null") - F.col("bad_count"), F.col("non_null")) >= t.numeric_ratio)
        .filter("odd_count > 0")
        .select("column", "row_count", "bad_count", pct(F.col("bad_count"), F.col("row_count")).alias("bad_pct"))
        .withColumn("severity", contamination_severity(F.col("bad_pct")))
    )
    if not examples:
        return found
    found = cut(found)  # one row per flagged column
    flagged = found.select("column").collect()
    if not flagged:
        return empty(df, ", ".join(f"{n} {k}" for n, k in found.dtypes) + ", examples array<string>")
    odd = read.filter(F.col("column").isin([r["column"] for r in flagged]) & F.col("odd"))
    return _with_examples(found, odd, t)


def date_contamination(df: DataFrame, t: Thresholds = DEFAULTS, examples: bool = True, counted: DataFrame | None = None) -> DataFrame:
    """Mostly date columns with values outside the dominant format (or unreadable ones, by policy).

    Examples are the commonest of these values, placeholders aside. ``counted`` are the ``counted_cells`` of the table.
    """
    counted = counted_cells(df, t=t) if counted is None else counted
    bad = F.col("non_null") - F.col("dates")
    per_layout = (
        with_dates(counted)
        .withColumn("x", to_number(F.col("value")))
        .groupBy("column", "layout")
        .agg(
            F.sum("cnt").alias("row_count"),
            total(F.col("value").isNotNull()).alias("non_null"),
            total(F.col("x").isNotNull()).alias("numbers"),
            total(F.col("date").isNotNull()).alias("dates"),
            total(is_placeholder(F.col("text"))).alias("placeholders"),
        )
    )
    found = (
        per_layout.groupBy("column")
        .agg(
            *[F.sum(c).alias(c) for c in ("row_count", "non_null", "numbers", "placeholders")],
            F.max_by("layout", F.struct("dates", "layout")).alias("dominant"),
            date_cells(t).alias("dates"),
        )
        .filter(share(F.col("dates"), F.col("non_null")) >= t.date_ratio)
        .filter(share(F.col("numbers"), F.col("non_null")) < t.label_numeric_ratio)
        .filter(bad > F.col("placeholders"))  # a placeholder is never a date, so this asks for another bad value
        .select("column", "row_count", bad.alias("bad_count"), pct(bad, F.col("row_count")).alias("bad_pct"), "dominant")
        .withColumn("severity", contamination_severity(F.col("bad_pct")))
    )
    if not examples:
        return found.drop("dominant")
    found = cut(found)  # one row per flagged column
    dominant = {r["column"]: r["dominant"] for r in found.collect()}
    found = found.drop("dominant")
    if not dominant:
        return found.withColumn("examples", F.lit(None).cast("array<string>"))
    odd = F.col("date").isNull()
    if t.date_policy != "any":
        of_column = F.element_at(F.create_map(*[F.lit(x) for pair in dominant.items() for x in pair]), F.col("column"))
        odd = odd | (F.col("layout") != of_column)
    # Not a filter: pushed below the date reading, it would repeat it. The good cells of a task collapse to one null.
    bad_or_null = F.when(~is_placeholder(F.col("text")) & odd, F.col("value")).alias("value")
    return _with_examples(found, with_dates(counted.where(F.col("column").isin(list(dominant)))).select("column", bad_or_null, "cnt"), t)


def stripped_contamination(df: DataFrame, min_ratio: float = 0.7) -> DataFrame:
    """Alternate check: columns numeric once euro and dollar signs, commas and blanks are gone.

    Nulls count as contaminated here.
    """
    return (
        cells(df)
        .withColumn("x", to_number(drop_separators(F.col("value"), "€$")))
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            share(F.count("x"), F.count("value")).alias("numeric_ratio"),
            (F.count(F.lit(1)) - F.count("x")).alias("contaminated_rows"),
        )
        .filter(F.col("numeric_ratio") > min_ratio)
        .withColumn("contamination_pct", pct(F.col("contaminated_rows"), F.col("row_count")))
        .select("column", "contaminated_rows", "contamination_pct")
    )


def naming_violations(df: DataFrame, snake_case: bool = False) -> DataFrame:
    """(column, issue, cells): naming problems with the number of filled cells they make hard to address."""
    tell = names.snake_case_issues if snake_case else names.violations
    hits = [(c, issue) for c in df.columns for issue in tell(c)]
    if not hits:
        return empty(df, "`column` string, issue string, cells bigint")
    filled = measure(df, {c: F.count(ref(c)) for c in dict.fromkeys(c for c, _ in hits)})
    return small_frame(df, [(c, issue, filled[c]) for c, issue in hits], "`column` string, issue string, cells bigint")


def similar_names(columns: Sequence[str], min_length: int) -> list[tuple[str, str]]:
    """Pairs, in column order, where one reduced name holds the other."""
    return [
        (a, b)
        for a, b in combinations(columns, 2)
        if min(len(names.plain(a)), len(names.plain(b))) >= min_length
        and (names.plain(a) in names.plain(b) or names.plain(b) in names.plain(a))
    ]


def domain_overlap(df: DataFrame, pairs: Sequence[tuple[str, str]], counted: DataFrame | None = None) -> DataFrame:
    """(column, column_b, distinct_a, distinct_b, shared, jaccard) over the distinct values of each pair.

    Every distinct value carries a bit set of the columns it occurs in, so all pairs need one shuffle by value
    and no join. A value is held once per task before the shuffle, however often it occurs. ``counted`` are the
    ``counted_cells`` of the table.
    """
    schema = "`column` string, column_b string, distinct_a bigint, distinct_b bigint, shared bigint, jaccard double"
    parts = []
    remaining = list(pairs)
    while remaining:
        bits: dict[str, int] = {}
        chunk: list[tuple[str, str]] = []
        rest: list[tuple[str, str]] = []
        for a, b in remaining:
            if len(bits.keys() | {a, b}) <= 62:
                for c in (a, b):
                    bits.setdefault(c, len(bits))
                chunk.append((a, b))
            else:
                rest.append((a, b))
        remaining = rest
        bit = F.element_at(
            F.create_map(*[F.lit(x) for c, i in bits.items() for x in (c, 1 << i)]), F.col("column")
        ).cast("long")
        sets = (
            (cells(df, list(bits)) if counted is None else of_columns(counted, list(bits))).filter(F.col("value").isNotNull()).groupBy("value").agg(F.bit_or(bit).alias("held"))
        )

        def holds(*cs: str) -> Column:
            mask = sum(1 << bits[c] for c in cs)
            return F.count_if(F.col("held").bitwiseAND(F.lit(mask).cast("long")) == mask)

        rows = [
            F.struct(
                F.lit(a).alias("column"), F.lit(b).alias("column_b"), F.col(f"c{bits[a]}").alias("distinct_a"),
                F.col(f"c{bits[b]}").alias("distinct_b"), F.col(f"p{i}").alias("shared"),
            )
            for i, (a, b) in enumerate(chunk)
        ]
        overlaps = sets.agg(
            *[holds(c).alias(f"c{i}") for c, i in bits.items()],
            *[holds(a, b).alias(f"p{i}") for i, (a, b) in enumerate(chunk)],
        ).select(F.inline(F.array(*rows)))
        union = F.col("distinct_a") + F.col("distinct_b") - F.col("shared")
        parts.append(overlaps.withColumn("jaccard", share(F.col("shared"), union)))
    if not parts:
        return empty(df, schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_columns(df: DataFrame, t: Thresholds = DEFAULTS, counted: DataFrame | None = None) -> DataFrame:
    """Columns with similar names whose value sets nearly coincide. A column is reported with the last such partner."""
    pairs = similar_names(columns_of(df, None), 3)
    order = {c: i for i, c in enumerate(df.columns)}
    hits = domain_overlap(df, pairs, counted).filter(F.col("jaccard") > t.duplicate_jaccard)
    if not pairs:
        return hits
    position = F.element_at(F.create_map(*[F.lit(x) for c, i in order.items() for x in (c, i)]), F.col("column_b"))
    return hits.groupBy("column").agg(
        F.max_by("column_b", position).alias("column_b"), rounded(F.max_by("jaccard", position), 4).alias("jaccard")
    )


def agreement_patterns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(filled, runs, cnt): how many rows have these filled columns and these agreeing ones; stored.

    ``filled`` has a 1 or 0 for each column. ``runs`` lists the columns whose folded cell stands in another column of the
    row too: 2 * place, plus 1 if it agrees with the column before it in the list. The cells of a row are sorted once, so a
    row costs as much as it has columns, not pairs; rows of one pattern collapse inside each task."""
    folded = text_layer(df).select(*[fold(ref(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    places = range(len(columns))
    filled = F.concat(*[F.when(F.col(f"c{i}").isNull(), "0").otherwise("1") for i in places])
    held = F.filter(F.array(*[F.struct(F.col(f"c{i}").alias("v"), F.lit(i).alias("i")) for i in places]), lambda x: x["v"].isNotNull())
    rows = folded.select(filled.alias("filled"), F.sort_array(held).alias("cells"))

    def coded(cell: Column, at: Column) -> Column:
        before = F.coalesce(F.get("cells", at - 1)["v"] == cell["v"], F.lit(False))
        after = F.coalesce(F.get("cells", at + 1)["v"] == cell["v"], F.lit(False))
        return F.when(before | after, cell["i"] * 2 + before.cast("int"))

    runs = F.filter(F.transform("cells", coded), lambda x: x.isNotNull())
    return cut(rows.select("filled", runs.alias("runs")).groupBy("filled", "runs").agg(F.count(F.lit(1)).alias("cnt")))


def _agreeing(patterns: DataFrame, n: int) -> dict[tuple[int, int], int]:
    """Rows in which two columns agree, for pairs that do so at least once."""
    # Where each run starts in the list; a run ends before the next start.
    at = F.col("p")
    by_run = patterns.where(F.size("runs") > 1).select("runs", "cnt", F.posexplode("runs").alias("p", "code")).where(F.col("code") % 2 == 0)
    rest = F.slice(F.col("runs"), at + 2, F.size("runs"))
    stop = F.array_position(F.transform(rest, lambda x: x % 2 == 0), F.lit(True)).cast("int")
    members = F.slice(F.col("runs"), at + 1, F.when(stop > 0, stop).otherwise(F.size("runs") - at))
    # Copies of a column as a set: most runs of a wide table are few different sets.
    sets = by_run.select(F.array_sort(F.transform(members, lambda x: F.shiftright(x, 1))).alias("set"), "cnt").groupBy("set").agg(F.sum("cnt").alias("cnt"))
    pairs = F.flatten(F.transform("set", lambda a: F.transform(F.filter("set", lambda b: b > a), lambda b: a * n + b)))
    found = sets.select(F.explode(pairs).alias("pair"), "cnt").groupBy("pair").agg(F.sum("cnt").alias("same")).collect()
    return {divmod(r["pair"], n): r["same"] for r in found}


def redundant_pairs(df: DataFrame, t: Thresholds = DEFAULTS, min_rows: int = 10) -> DataFrame:
    """Pairs of columns equal row by row (case and outer blanks ignored) in most rows where both are filled.

    One pass over the table, whatever the number of columns: it leaves patterns of filled and agreeing columns with
    their counts. Everything else is read off those: pairs that never agree do not appear, and rows in which both columns
    are filled are only counted for pairs that may still reach the cut-off."""
    columns = columns_of(df, None)
    n = len(columns)
    schema = "col1 string, col2 string, rows_compared bigint, overlap_pct double"
    if n < 2:
        return empty(df, schema)
    patterns = agreement_patterns(df, columns)
    same = _agreeing(patterns, n)
    filled = patterns.groupBy("filled").agg(F.sum("cnt").alias("cnt"))
    figures = filled.agg(F.sum("cnt").alias("rows"), *[F.sum(F.when(F.substring("filled", i + 1, 1) == "1", F.col("cnt")).otherwise(0)).alias(f"f{i}") for i in range(n)]).first()
    rows = figures["rows"] or 0
    # Both are filled in at least so many rows as do not fit beside each other, and in those where they agree.
    maybe = [(i, j) for (i, j), s in same.items() if s > t.redundant_overlap * max(s, min_rows, figures[f"f{i}"] + figures[f"f{j}"] - rows)]
    both: dict[tuple[int, int], int] = {}
    if maybe:
        codes = F.split(F.lit(",".join(str(i * n + j) for i, j in maybe)), ",").cast("array<int>")
        present = F.filter(codes, lambda c: (F.substr("filled", F.floor(c / n).cast("int") + 1, F.lit(1)) == "1") & (F.substr("filled", c % n + 1, F.lit(1)) == "1"))
        counted = filled.select(F.explode(present).alias("pair"), "cnt").groupBy("pair").agg(F.sum("cnt").alias("both")).collect()
        both = {divmod(r["pair"], n): r["both"] for r in counted}
    hits = []
    for pair in sorted(both):
        if both[pair] > min_rows and same[pair] / both[pair] > t.redundant_overlap:
            hits.append((columns[pair[0]], columns[pair[1]], both[pair], round(same[pair] / both[pair] * 100, 1)))
    return small_frame(df, hits, schema)
