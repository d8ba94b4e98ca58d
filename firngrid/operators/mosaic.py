"""Map layers from the cells of many avalanches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firngrid.functions import hazard


def placed(cells: DataFrame, shift_i: int, shift_j: int, nx: int, ny: int) -> DataFrame:
    """Cells moved to the map's grid; those outside of the map are dropped."""
    moved = cells.withColumns({"i": F.col("i") + shift_i, "j": F.col("j") + shift_j})
    return moved.where((F.col("i") >= 0) & (F.col("i") < nx) & (F.col("j") >= 0) & (F.col("j") < ny))


def mosaic(cells: DataFrame, density: float = hazard.FLOW_DENSITY, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per map cell, how many domains and avalanches meet there and the maxima of the latter.

    One aggregation with partial maxima in each task; valley cells with very many avalanches
    send one row per task. A cell with domains only keeps zeros.
    """
    hit = (F.col("max_height") > 0.25) & (F.col("max_vel") > 1.0)

    def most(c: Column, name: str) -> Column:
        return F.coalesce(F.max(F.when(hit, c)), F.lit(0.0)).alias(name)

    return cells.groupBy(*keys, "i", "j").agg(
        F.count("*").alias("domain_count"),
        F.count_if(hit).alias("avalanche_count"),
        most(F.col("max_height"), "max_height"),
        most(F.col("max_vel"), "max_velocity"),
        most(F.col("depo"), "deposition"),
        most(hazard.pressure(F.col("max_vel"), density).cast("double"), "max_pressure"),
    )


def encode_differences(cells: DataFrame, columns: list[str], key: str, order: str) -> DataFrame:
    """Each value less the one before it; the first stays."""
    w = Window.partitionBy(key).orderBy(order)
    return cells.withColumns({c: F.col(c) - F.lag(c, 1, 0).over(w) for c in columns})


def decode_differences(cells: DataFrame, columns: list[str], key: str, order: str) -> DataFrame:
    """The running sums that undo ``encode_differences``."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return cells.withColumns({c: F.sum(c).over(w).cast("int") for c in columns})
