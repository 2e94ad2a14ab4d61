"""Shared small helpers: written tables that cut lineage, and defensive column picking."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import shared_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below :func:`shared_dir` and read it back: a cut of the lineage that survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def forgotten(df: DataFrame) -> None:
    """Remove the files of a :func:`written` table that nothing reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(df.written_at)
    path.getFileSystem(conf).delete(path, True)


def position(df: DataFrame, name: str) -> int:
    """Where the column of this name stands: an exact match first, else one in other letter case."""
    found = [i for i, c in enumerate(df.columns) if c == name] or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if not found:
        raise ValueError(f"no column {name}")
    return found[0]


def numbered(df: DataFrame) -> DataFrame:
    """The same columns as c0, c1, ...: extra columns with clashing names then do no harm."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone."""
    return numbered(df).select(*[F.col(f"c{position(df, n)}").alias(n) for n in names])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
