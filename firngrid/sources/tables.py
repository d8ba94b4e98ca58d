"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet`` by Spark's own reader, whatever store it lies in."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
