"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType


def local_session(cores: str = "8", memory: str = os.environ.get("BENCH_MEMORY", "8g")) -> SparkSession:
    """Session for tests and benchmarks on one machine; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("plumbline")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# The JVM never compiles methods of more bytes, so a row that needs more code is interpreted, many times slower.
_COMPILED_BYTES = "8000"


def compiled(spark: SparkSession) -> SparkSession:
    """Lets Spark give up fusing a stage whose method the JVM would interpret; its operators are compiled one by one.

    A limit that somebody set is left alone. It changes no result."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(limit, "65535") == "65535":
        spark.conf.set(limit, _COMPILED_BYTES)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor reaches: the cluster's ``spark.checkpoint.dir``.

    Only a single-machine session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="plumbline-")
    context.setCheckpointDir(folder)
    return folder


def importable(df: DataFrame) -> DataFrame:
    """Lets Python workers find this package where the driver found it; a cluster that installs it needs no more."""
    environment = df.sparkSession.sparkContext.environment
    folder = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if folder not in known:
        environment["PYTHONPATH"] = os.pathsep.join([folder, *filter(None, known)])
    return df


def cut(df: DataFrame) -> DataFrame:
    """Same rows, read back from Parquet in the shared folder instead of being recomputed.

    Unlike a checkpoint it can be read by column, and its size is known to the optimiser.
    """
    folder = f"{shared_folder(compiled(df.sparkSession))}/plumbline-{uuid.uuid4().hex}"
    # Parquet refuses some names, and knows no column without a type.
    names, untyped = df.columns, [isinstance(f.dataType, NullType) for f in df.schema.fields]
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    written = plain.select(*[F.col(c).cast("string").alias(c) if void else F.col(c) for c, void in zip(plain.columns, untyped)])
    written.write.parquet(folder)
    read = df.sparkSession.read.schema(written.schema).parquet(folder)
    return read.select(*[F.lit(None).alias(c) if void else F.col(c) for c, void in zip(read.columns, untyped)]).toDF(*names)
