"""Release areas: snow, depth, volume, filters, classes and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firngrid.functions import hazard

MIN_ELEVATION, MIN_AREA, CHUNK_SIZE = 100.0, 1000.0, 500
#: Size classes that are run for each forest flag.
SIZES_RUN = {"NoFor": ("L", "M"), "For": ("S", "T")}


def cut_off(areas: DataFrame) -> DataFrame:
    """Release areas high and large enough."""
    return areas.where((F.col("mean_dem") >= MIN_ELEVATION) & (F.col("area_m2") >= MIN_AREA))


def clip(areas: DataFrame, mask: DataFrame, x0: float, y0: float, x1: float, y1: float, inside: int = 2) -> DataFrame:
    """Areas whose centroid cell is in the half-open rectangle and whose mask is ``inside``."""
    box = (F.col("i") >= x0) & (F.col("i") < x1) & (F.col("j") >= y0) & (F.col("j") < y1)
    return areas.where(box).join(mask.where(F.col("mask") == inside).select("i", "j"), ["i", "j"], "left_semi")


def corrected(areas: DataFrame) -> DataFrame:
    """Depth and volume without wind and slope correction."""
    return areas.withColumns({"d0star": hazard.snow_depth(F.col("swe")), "slopecorr": F.lit(1.0), "wind": F.lit(0.0)}).withColumn(
        "d0", (F.col("d0star") + F.col("wind")) * F.col("slopecorr")
    ).withColumn("vol", hazard.release_volume(F.col("area_m2"), F.col("d0"), F.col("mean_slope")))


def keep_by_forest(rows: DataFrame, low: float = 300.0, share: float = 0.3) -> DataFrame:
    """``include``: high, or hardly any forest in release area and extent; unknown shares do not count."""
    rel = (F.col("rel_n41") + F.col("rel_n43")) / F.nullif(F.col("rel_n"), F.lit(0))
    ext = (F.col("ext_n42") + F.col("ext_n43")) / F.nullif(F.col("ext_n"), F.lit(0))
    keep = (F.col("mean_dem") >= low) | ((rel < share) & (ext < share))
    return rows.withColumn("include", F.coalesce(keep, F.lit(False)))


def runnable(areas: DataFrame) -> DataFrame:
    """Areas whose size class is run for their forest flag."""
    ok = F.lit(False)
    for forest, sizes in SIZES_RUN.items():
        ok = ok | ((F.col("forest") == forest) & F.col("pra_size").isin(*sizes))
    return areas.where(ok)


def chunked(areas: DataFrame, current_max: DataFrame | None = None, size: int = CHUNK_SIZE) -> DataFrame:
    """``chunkid`` within size class, ``size`` areas each; after ``current_max (pra_size, last)`` when appending.

    Counting in one pass would bring a whole class to one task. So the ids are counted in
    blocks first; the few block totals are summed, and each block counts on from there.
    """
    block = F.floor(F.col("id") / 100_000)
    blocks = areas.groupBy("pra_size", block.alias("block")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("pra_size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("pra_size", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy("pra_size", "block").orderBy("id")
    numbered = areas.withColumn("block", block).withColumn("k", F.row_number().over(own)).join(starts, ["pra_size", "block"])
    chunk = F.floor((F.col("start") + F.col("k") - 1) / size)
    if current_max is not None:
        numbered = numbered.join(current_max, "pra_size", "left")
        chunk = chunk + F.coalesce(F.col("last") + 1, F.lit(0))
    return numbered.withColumn("chunkid", chunk.cast("int")).select(*areas.columns, "chunkid")


def share_of(n: Column, total: Column) -> Column:
    """A share; null of nothing."""
    return n / F.nullif(total, F.lit(0))
