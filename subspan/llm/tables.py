"""Reading the tables, and intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subspan.session import shared_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, under: str | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder, or in the folder ``under``: what follows starts from files, so a
    lost executor costs the tasks it ran and not the lineage."""
    spark = df.sparkSession
    path = new_path(spark, name) if under is None else f"{under}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """The same rows with columns c0, c1, ..., so that no name clashes with one that is added."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def named(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` of rows that were ``numbered``."""
    return df.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(like.columns)])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
