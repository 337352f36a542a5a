"""Delimited text in."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.config import NA_STRINGS
from plumbline.functions.numbers import to_number
from plumbline.functions.text import ref
from plumbline.operators.cells import measure
from plumbline.sources import csv_records

DELIMITERS = (",", ";", "\t", "|")
_HEAD_LINES = 32


def detect_delimiter(spark: SparkSession, path: str) -> str:
    """Delimiter of the first lines: the candidate that splits most of them into the same number (> 1) of fields.

    The first lines are looked at whole, however long, since a delimiter is a property of the file and not of its
    rows. Among candidates that fit as many lines the one with the most fields wins; without any it is the comma.
    """
    head = (
        spark.read.text(path)
        .limit(_HEAD_LINES)
        .select(F.regexp_replace("value", '"[^"]*"', "").alias("line"))
        .filter("line <> ''")
    )
    lines = head.select(*[(F.size(F.split("line", f"[{d}]")) - 1).alias(f"d{i}") for i, d in enumerate(DELIMITERS)]).collect()
    fitting = []
    for i, d in enumerate(DELIMITERS):
        fields = Counter(line[i] for line in lines if line[i])
        if fields:
            number, agreeing = max(fields.items(), key=lambda x: (x[1], x[0]))
            fitting.append((agreeing, number, d))
    return max(fitting, key=lambda x: x[:2])[2] if fitting else ","


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str | None = None,
    na_values: Sequence[str] = NA_STRINGS,
    infer_types: bool = False,
    multi_line: bool | None = None,
) -> DataFrame:
    """CSV with a header row. All columns are text unless ``infer_types``; cells in ``na_values`` are null, which
    types are then inferred from: one pass, and a column gets the first type that all its filled cells can be read as.

    Malformed UTF-8 is replaced, a missing path raises. Cells may hold line breaks inside quotes, and the file is still
    read in splits (``csv_records``); whether any do is looked up first, in files that have quotes at all. ``multi_line``
    set to False skips that and takes every line as a record.
    """
    sep = sep or detect_delimiter(spark, path)
    options = {"sep": sep, "quote": '"', "escape": '"'}
    plain = spark.read.csv(path, header=True, encoding="UTF-8", **options)
    df = plain
    if multi_line is not False:
        text = csv_records.lines(spark, path)
        if multi_line or not text.where(F.col("value").contains('"')).isEmpty():
            states, broken, crossed = csv_records.beginnings(text, sep)
            if broken:
                columns = spark.read.csv(path, header=True, encoding="UTF-8", multiLine=True, **options).columns
                columns[-1] = columns[-1].removesuffix("\r")
                df = csv_records.parsed(csv_records.records(text, sep, states, crossed), columns, options)
    df = df.select(*[F.when(~ref(c).isin(*na_values), ref(c)).alias(c) if na_values else ref(c) for c in df.columns])
    return inferred(df) if infer_types else df


_TYPES = ("int", "bigint", "double", "date", "timestamp", "boolean")


def inferred(df: DataFrame) -> DataFrame:
    """Text columns cast to the first of ``_TYPES`` that every filled cell can be read as; empty ones stay text."""
    if not df.columns:
        return df
    metrics = {}
    for c in df.columns:
        metrics[f"filled {c}"] = F.count(ref(c))
        for kind in _TYPES:
            readable = to_number(ref(c)) if kind == "double" else ref(c).try_cast(kind)
            metrics[f"{kind} {c}"] = F.count(readable)
    m = measure(df, metrics)
    kinds = {c: next((k for k in _TYPES if m[f"filled {c}"] and m[f"{k} {c}"] == m[f"filled {c}"]), "string") for c in df.columns}
    return df.select(*[ref(c).try_cast(k).alias(c) if k != "string" else ref(c) for c, k in kinds.items()])
