"""Parquet hand-over between the steps of a chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_step(df: DataFrame, path: str) -> DataFrame:
    """Write ``df``, replacing what is there, and return it read back.

    The path must not be one ``df`` reads from.
    """
    df.write.mode("overwrite").parquet(path)
    return read_step(df.sparkSession, path)


def read_step(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
