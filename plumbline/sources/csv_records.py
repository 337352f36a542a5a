"""CSV records with line breaks inside quotes, read in splits.

Lines are read in splits as Spark deals them. Whether a line begins inside quotes depends on all lines before it, but each
line only maps two states (outside, inside) to two states, and so does a split. The first pass finds the map of every
split and leaves one row for each; chained in file order they give the state in which each split begins. The second pass
joins the lines of each split to records. What is left over at the edges, at most one piece at the beginning and one at
the end of a split, is put together across splits. So a file of any size is read by all tasks, with every record whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.session import importable

Place = tuple[str, int]

_BLANKS = "".join(map(chr, range(33)))
_WHOLE, _CONTINUED, _BEGUN = 0, 1, 2


def ends_inside(line: str, sep: str, inside: bool) -> bool:
    """True if a quoted cell is still open behind ``line``.

    A quote opens a cell only as its first character; a doubled one stands for itself; what follows a closing quote
    belongs to the cell until the next separator."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if not inside:
            if line.startswith('"', at):
                at, inside = at + 1, True
            else:
                at = line.find(sep, at)
                if at < 0:
                    return False
                at += len(sep)
                continue
        at = line.find('"', at)
        if at < 0:
            return True
        if line.startswith('"', at + 1):
            at += 2
            continue
        inside = False
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, start) of every line; malformed UTF-8 is replaced. ``start`` is the place of the split in its file."""
    read = spark.read.text(path, lineSep="\n")
    return importable(read.select(F.make_valid_utf8("value").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Place, list[str]]]:
    """(place, lines) of consecutive lines of one split."""
    for batch in batches:
        values, files, starts = (c.to_pylist() for c in batch.columns)
        first = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or starts[i] != starts[first] or files[i] != files[first]:
                yield (files[first], starts[first]), values[first:i]
                first = i


def splits(text: DataFrame, sep: str) -> DataFrame:
    """(file, start, then for each state at the beginning: the state at the end, and whether any line ends inside)."""

    def run(batches):
        place, ends, broken = None, [False, True], [False, False]
        for key, values in _runs(batches):
            if key != place:
                if place is not None:
                    yield _row(place, ends, broken)
                place, ends, broken = key, [False, True], [False, False]
            for line in values:
                for k in (0, 1):
                    ends[k] = ends_inside(line, sep, ends[k])
                    broken[k] |= ends[k]
        if place is not None:
            yield _row(place, ends, broken)

    return text.mapInArrow(run, "file string, start bigint, outside boolean, inside boolean, outside_broken boolean, inside_broken boolean")


def _row(place: Place, ends: list[bool], broken: list[bool]) -> pa.RecordBatch:
    values = [*place, *ends, *broken]
    return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["file", "start", "outside", "inside", "outside_broken", "inside_broken"])


def beginnings(text: DataFrame, sep: str) -> tuple[dict[Place, bool], bool, bool]:
    """(state in which each split begins, whether any record has a line break, whether any record crosses splits).

    The driver holds a row for each split, as its scheduler does."""
    states: dict[Place, bool] = {}
    file, inside, broken, crossed = None, False, False, False
    for r in sorted(splits(text, sep).collect(), key=lambda r: (r["file"], r["start"])):
        if r["file"] != file:
            file, inside = r["file"], False
        states[r["file"], r["start"]] = inside
        broken |= r["inside_broken"] if inside else r["outside_broken"]
        inside = r["inside"] if inside else r["outside"]
        crossed |= inside
    return states, broken, crossed


def _assembled(text: DataFrame, sep: str, states: dict[Place, bool]) -> DataFrame:
    """(record, kind, file, start, head): whole records, and the pieces at the edges of splits."""

    def run(batches):
        place, inside, held, kind, first = None, False, [], _WHOLE, False
        out: list[tuple] = []

        def emit(kind: int) -> None:
            nonlocal held, first
            record = "\n".join(held)
            held = []
            if kind == _WHOLE and not record.strip(_BLANKS):
                return
            out.append((record[:-1] if record.endswith("\r") else record, kind, *place, first))
            first = False

        for key, values in _runs(batches):
            if key != place:
                if held:
                    emit(_CONTINUED if kind == _CONTINUED else _BEGUN)
                if key not in states:
                    raise RuntimeError(f"the splits of {key[0]} changed between two passes; read it again")
                place, inside = key, states[key]
                kind, first = _CONTINUED if inside else _WHOLE, key[1] == 0
            for line in values:
                held.append(line)
                inside = ends_inside(line, sep, inside)
                if not inside:
                    emit(kind)
                    kind = _WHOLE
            if out:
                yield _records(out)
                out.clear()
        if held:
            emit(_CONTINUED if kind == _CONTINUED else _BEGUN)
        if out:
            yield _records(out)

    return text.mapInArrow(run, "record string, kind int, file string, start bigint, head boolean")


def _records(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["record", "kind", "file", "start", "head"])


def records(text: DataFrame, sep: str, states: dict[Place, bool], crossed: bool) -> DataFrame:
    """(record) for every record but the first of each file, without its last line break. Blank lines are no records."""
    pieces = _assembled(text, sep, states)
    whole = pieces.where((F.col("kind") == _WHOLE) & ~F.col("head")).select("record")
    if not crossed:
        return whole
    # At most two pieces a split: a few bytes of each, unless one record is as long as a split.
    edges = pieces.where(F.col("kind") != _WHOLE)
    order = Window.partitionBy("file").orderBy("start", "kind")
    numbered = edges.withColumn("number", F.sum((F.col("kind") == _BEGUN).cast("long")).over(order))
    joined = numbered.groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "record"))).alias("parts"), F.bool_or("head").alias("head"))
    return whole.unionByName(joined.where(~F.col("head")).select(F.array_join("parts.record", "\n").alias("record")))


def parsed(found: DataFrame, columns: list[str], options: dict[str, str]) -> DataFrame:
    """Columns of text from (record)."""
    schema = ", ".join(f"c{i} STRING" for i in range(len(columns)))
    return found.select(F.from_csv("record", schema, options | {"multiLine": "true", "lineSep": "\n"}).alias("r")).select("r.*").toDF(*columns)
