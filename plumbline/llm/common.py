"""Helpers shared by the operators of this package."""

from __future__ import annotations

import itertools
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import shared_folder

# Output rows are handed back to the JVM in pieces of about this many bytes.
_BATCH_BYTES = 8 << 20


def scratch(df_or_spark) -> str:
    """A new folder name below the cluster's shared folder."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    return f"{shared_folder(spark).rstrip('/')}/plumbline-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Same rows, written once as Parquet in the shared folder and read back: later steps neither recompute them
    nor depend on blocks of one executor."""
    folder = scratch(df)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def lower_ascii(column):
    """Lower case of A-Z only; every other letter stays."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def importable(df: DataFrame) -> DataFrame:
    """Lets Python workers find this package where the driver found it; a cluster that installs it needs no more."""
    environment = df.sparkSession.sparkContext.environment
    folder = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if folder not in known:
        environment["PYTHONPATH"] = os.pathsep.join([folder, *filter(None, known)])
    return df


def rows_in(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches of a ``mapInArrow`` call in slices of a few hundred rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def arrow_map(df: DataFrame, make: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a row generator: ``make()`` runs once per task and returns a function that turns a slice of
    the input into rows (tuples); rows leave the task in bounded batches."""
    importable(df)
    arrow_schema = _arrow_schema(df, schema)

    def run(batches):
        work = make()
        held: list[tuple] = []
        size = 0
        for part in rows_in(batches):
            for row in work(part):
                held.append(row)
                size += 64 + sum(len(v) * (8 if isinstance(v, list) else 1) for v in row if isinstance(v, (str, bytes, list)))
                if size > _BATCH_BYTES:
                    yield _batch(held, arrow_schema)
                    held, size = [], 0
        if held:
            yield _batch(held, arrow_schema)

    return df.mapInArrow(run, schema)


def _arrow_schema(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema)


def grouped_map(df: DataFrame, keys: list[str], make: Callable, schema: str, order: tuple[str, ...] = ()) -> DataFrame:
    """Rows made from whole groups: ``make()`` returns a function from the ``pyarrow.Table`` of one group to rows. Groups
    are formed by a shuffle on ``keys``, sorted by ``order`` and streamed one after the other; callers bound their size."""
    importable(df)
    arrow_schema = _arrow_schema(df, schema)
    sorted_df = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    at = [df.columns.index(k) for k in keys]

    def run(batches):
        work, held, size = make(), [], 0
        for table in _groups(batches, at):
            for row in work(table):
                held.append(row)
                size += 64 + sum(len(v) * (8 if isinstance(v, list) else 1) for v in row if isinstance(v, (str, bytes, list)))
                if size > _BATCH_BYTES:
                    yield _batch(held, arrow_schema)
                    held, size = [], 0
        if held:
            yield _batch(held, arrow_schema)

    return sorted_df.mapInArrow(run, schema)


def _groups(batches: Iterator[pa.RecordBatch], at: list[int]) -> Iterator[pa.Table]:
    parts: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in at)))
        start = 0
        for i, key in enumerate(keys):
            if key != current:
                if i > start:
                    parts.append(batch.slice(start, i - start))
                if parts:
                    yield pa.Table.from_batches(parts)
                parts, current, start = [], key, i
        if len(keys) > start:
            parts.append(batch.slice(start))
    if parts:
        yield pa.Table.from_batches(parts)


def streamed(df: DataFrame, key: str, order: tuple[str, ...], make: Callable, schema: str) -> DataFrame:
    """Rows made from groups that need not fit in memory: ``make()`` returns a function from the key of a group and an
    iterator over its rows (tuples in the order of ``df``'s columns, sorted by ``order``) to rows. Groups come from a shuffle
    on ``key``; nulls are a group. A task holds a slice of a few hundred input rows at a time."""
    importable(df)
    arrow_schema = _arrow_schema(df, schema)
    at = df.columns.index(key)

    def run(batches):
        work, held, size = make(), [], 0
        rows = (row for part in rows_in(batches) for row in zip(*(c.to_pylist() for c in part.columns)))
        for value, group in itertools.groupby(rows, lambda row: row[at]):
            for row in work(value, group):
                held.append(row)
                size += 64 + sum(len(v) for v in row if isinstance(v, (str, bytes)))
                if size > _BATCH_BYTES:
                    yield _batch(held, arrow_schema)
                    held, size = [], 0
        if held:
            yield _batch(held, arrow_schema)

    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)
