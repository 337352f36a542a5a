"""Results out: stage tables and findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import ref

FINDING_SCHEMA = "`check` string, `column` string, column_b string, metric string, value double, severity string, examples array<string>"


def stage_path(base: str, version: int, iteration: int = 0) -> str:
    """Folder of a stage's output; a repeated stage gets its own."""
    return f"{base}/stage=v{version}" + (f"_iter{iteration}" if iteration else "")


def write_stage(df: DataFrame, base: str, version: int, iteration: int = 0, fmt: str = "parquet") -> DataFrame:
    """Write a stage's table and return it as read back, which also ends its lineage.

    In CSV, arrays, maps (with text keys) and structs are JSON cells, binary is base64.
    """
    path = stage_path(base, version, iteration)
    if fmt == "csv":
        nested = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}
        binary = {f.name for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)}
        encoded = df.select(
            *[F.to_json(ref(c)).alias(c) if c in nested else F.base64(ref(c)).alias(c) if c in binary else ref(c) for c in df.columns]
        )
        write_csv(encoded, path)
        read = df.sparkSession.read.csv(path, schema=encoded.schema, **_csv_options(","))
        return read.select(
            *[
                F.from_json(ref(c), nested[c]).alias(c) if c in nested else F.unbase64(ref(c)).alias(c) if c in binary else ref(c)
                for c in df.columns
            ]
        )
    # parquet refuses some characters in names, so columns travel under their position
    names = df.columns
    df.toDF(*[f"c{i}" for i in range(len(names))]).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).toDF(*names)


def _csv_options(sep: str) -> dict:
    """Cells go out as they are: the writer would otherwise trim them."""
    return {
        "header": True, "sep": sep, "quote": '"', "escape": '"',
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").csv(path, **_csv_options(sep))


def json_safe(df: DataFrame) -> DataFrame:
    """NaN and infinities, which JSON cannot hold, become null."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[F.when(F.abs(ref(c)) < float("inf"), ref(c)).alias(c) if c in floats else ref(c) for c in df.columns]
    )


def write_findings(findings: DataFrame, path: str) -> None:
    json_safe(findings).write.mode("overwrite").json(path)


def read_findings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FINDING_SCHEMA).json(path)


def parse_findings(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` holds a JSON finding, opened into finding columns. Text that is no JSON gives nulls."""
    return df.select(F.from_json(ref(column), FINDING_SCHEMA).alias("f")).select("f.*")
