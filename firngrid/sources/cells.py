"""Scans of cell tables: bands, windows, and overlapping tiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_cells(spark: SparkSession, path: str, bands: list[str], where: str | None = None) -> DataFrame:
    """The named columns of a cell table; rows and columns are cut in the scan."""
    cells = spark.read.parquet(path)
    return (cells.where(where) if where else cells).select(bands)


def extract(cells: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Cells in a rectangle of the grid, whichever corners are given; edges count."""
    return cells.where(
        F.col("i").between(min(x0, x1), max(x0, x1)) & F.col("j").between(min(y0, y1), max(y0, y1))
    )


def union_tiles(tiles: list[DataFrame], value: str) -> DataFrame:
    """One layer of many tiles; where tiles overlap, the later one in the list wins."""
    ranked = [t.select("i", "j", value, F.lit(k).alias("rank")) for k, t in enumerate(tiles)]
    return (
        reduce(DataFrame.unionByName, ranked)
        .groupBy("i", "j")
        .agg(F.max_by(value, "rank").alias(value))
    )
