"""Reading tables and bringing them into the text layer the checks work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import ref

_COMPLEX = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scalar_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, _COMPLEX)]


def _has_no_order(kind: T.DataType) -> bool:
    """Whether values of the type, or parts of them, can be neither sorted nor grouped."""
    if isinstance(kind, T.ArrayType):
        return _has_no_order(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_no_order(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def _ordered(c: Column, kind: T.DataType) -> Column:
    if not _has_no_order(kind):
        return c
    if isinstance(kind, T.MapType):
        pairs = F.transform(
            F.map_entries(c),
            lambda e: F.struct(_ordered(e["key"], kind.keyType).alias("key"), _ordered(e["value"], kind.valueType).alias("value")),
        )
        return F.array_sort(pairs)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _ordered(x, kind.elementType))
    if isinstance(kind, T.StructType):
        parts = [_ordered(c[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    return F.to_json(c)


def comparable(df: DataFrame, name: str) -> Column:
    """A column in a form that can be hashed, grouped and sorted, equal exactly where the column is.

    Maps become their entries in order of the keys, at any depth, so the order in which a map was filled does not
    count; variants become JSON text. Everything else is left as it is.
    """
    return _ordered(ref(name), df.schema[name].dataType)


def has_no_order(df: DataFrame, name: str) -> bool:
    return _has_no_order(df.schema[name].dataType)


def text_layer(df: DataFrame, scale: int | None = None, nested: bool = False) -> DataFrame:
    """Every scalar column as text. NaN is a missing cell.

    Arrays, maps, structs, variants and binary are left out, or kept as they are with ``nested``. ``scale`` prints
    floating-point columns with that many decimals, so that the text is the same in any engine.
    """

    def as_text(field: T.StructField):
        c = ref(field.name)
        if isinstance(field.dataType, T.StringType):
            return c
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        if scale is not None and isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = c.cast(T.DecimalType(38, scale))
        return c.cast("string").alias(field.name)

    scalars = set(scalar_columns(df))
    return df.select(*[as_text(f) if f.name in scalars else ref(f.name) for f in df.schema.fields if nested or f.name in scalars])


def spread(df: DataFrame) -> DataFrame:
    """Give every core a part of a scan that has fewer splits than the cluster has cores.

    Parsing text costs far more than moving it, so a small file is worth one exchange. A table large enough to
    fill the cluster has more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
