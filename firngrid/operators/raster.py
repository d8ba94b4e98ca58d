"""Cell-wise masks, lookups and coarsening of rasters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firngrid.functions import hazard

#: Extent types and the predicate of a cell in each; pressure is in Pa.
EXTENTS = ("full", "christen", "tetra30", "tetra1")


def nonzero(cells: DataFrame) -> DataFrame:
    """Cells where any band is above 0."""
    return cells.where("max_vel > 0 or max_height > 0 or depo > 0")


def extent_predicates() -> dict[str, Column]:
    """The four extent masks as predicates on a result cell."""
    h, v = F.col("max_height"), F.col("max_vel")
    p = hazard.pressure(v)
    return {
        "full": (h > 0) & (v > 0),
        "christen": (h > 0.25) & (v > 1.0),
        "tetra30": p > 30,
        "tetra1": p > 1,
    }


def extent_masks(cells: DataFrame) -> DataFrame:
    """A row for each cell and extent type it belongs to, in one pass."""
    kinds = F.array(*[F.when(p, F.lit(k)) for k, p in extent_predicates().items()])
    return cells.withColumn("extent_type", F.explode(F.array_compact(kinds)))


def mask_bands(cells: DataFrame, mask: DataFrame, bands: list[str]) -> DataFrame:
    """Bands are null outside ``mask (cell, inside)``."""
    joined = cells.join(mask, "cell", "left")
    return joined.withColumns(
        {b: F.when(F.coalesce("inside", F.lit(False)), F.col(b)) for b in bands}
    ).drop("inside")


def domain_mask(cells: DataFrame, value: str, margin: int = 0) -> DataFrame:
    """``i, j, mask``: 0 where ``value`` is null, 1 within ``margin`` cells of such, else 2.

    The distance is between cell centres; the offsets are few, so the join is by cell.
    """
    base = cells.select("i", "j", F.when(F.col(value).isNull(), 0).otherwise(2).alias("mask"))
    if margin <= 0:
        return base
    offsets = [
        (di, dj)
        for di in range(-margin, margin + 1)
        for dj in range(-margin, margin + 1)
        if 0 < di * di + dj * dj < margin * margin
    ]
    near = base.where("mask = 0").select(
        F.inline(
            F.array(*[F.struct((F.col("i") + a).alias("i"), (F.col("j") + b).alias("j")) for a, b in offsets])
        )
    ).distinct().withColumn("near", F.lit(True)) if offsets else base.limit(0).select("i", "j", F.lit(True).alias("near"))
    return base.join(near, ["i", "j"], "left").select(
        "i", "j", F.when((F.col("mask") == 2) & F.coalesce("near", F.lit(False)), 1).otherwise(F.col("mask")).alias("mask")
    )


def release_mask(bands: DataFrame, scenarios: dict[str, tuple[float, float]], curve: float = 5.5, rugged: float = 3.5) -> DataFrame:
    """Possible release cells, for each named range of slopes: 200, or null outside."""
    each = F.explode(
        F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(a).alias("low"), F.lit(b).alias("high")) for n, (a, b) in scenarios.items()])
    )
    ok = (
        F.col("slope").between(F.col("s.low"), F.col("s.high"))
        & (F.abs("plan_curvature") <= curve)
        & (F.col("ruggedness") <= rugged)
        & ~F.col("forest")
    )
    return bands.select("*", each.alias("s")).select("cell", "s.scenario", F.when(ok, 200).alias("mask"))


def lookup(points: DataFrame, cells: DataFrame, bands: list[str]) -> DataFrame:
    """``points (i, j, ...)`` with the bands of the cell they lie in; null outside."""
    return points.join(cells.select("i", "j", *bands), ["i", "j"], "left")


def coarsen(cells: DataFrame, factor: int, aggs: list[Column]) -> DataFrame:
    """Aggregates over blocks of ``factor`` x ``factor`` cells, keyed ``ci, cj``."""
    return cells.groupBy(
        F.floor(F.col("i") / factor).cast("int").alias("ci"),
        F.floor(F.col("j") / factor).cast("int").alias("cj"),
    ).agg(*aggs)


def overlap_regrid(cells: DataFrame, value: str, size: float, shift: float) -> DataFrame:
    """Area-weighted mean on a grid of cells ``size`` wide that starts at ``shift``.

    Each cell is spread over the target cells it overlaps.
    """
    def spans(axis: str) -> Column:
        low, high = (F.col(axis) - shift) / size, (F.col(axis) + 1 - shift) / size
        return F.transform(
            F.sequence(F.floor(low).cast("int"), (F.ceil(high) - 1).cast("int")),
            lambda t: F.struct(t.alias("at"), ((F.least(high, t + 1.0) - F.greatest(low, t.cast("double"))) * size).alias("w")),
        )

    return (
        cells.where(F.col(value).isNotNull())
        .select(value, F.explode(spans("i")).alias("a"), F.col("j"))
        .select(value, "a", F.explode(spans("j")).alias("b"))
        .withColumn("w", F.col("a.w") * F.col("b.w"))
        .groupBy(F.col("a.at").alias("ti"), F.col("b.at").alias("tj"))
        .agg((F.sum(F.col(value) * F.col("w")) / F.sum("w")).alias(value))
    )


def bilinear(targets: DataFrame, cells: DataFrame, value: str) -> DataFrame:
    """``targets (key, x, y)`` with the value between the four cell centres around.

    Null if one of the four is missing.
    """
    fx, fy = F.col("x") - 0.5, F.col("y") - 0.5
    i0, j0 = F.floor(fx).cast("int"), F.floor(fy).cast("int")
    wx, wy = fx - i0, fy - j0
    corners = F.array(
        *[
            F.struct((i0 + a).alias("i"), (j0 + b).alias("j"), ((wx if a else 1 - wx) * (wy if b else 1 - wy)).alias("w"))
            for a in (0, 1)
            for b in (0, 1)
        ]
    )
    return (
        targets.select("key", F.inline(corners))
        .join(cells.select("i", "j", F.col(value).alias("v")), ["i", "j"])
        .groupBy("key")
        .agg(F.count("v").alias("n"), F.sum(F.col("v") * F.col("w")).alias("v"))
        .select("key", F.when(F.col("n") == 4, F.col("v")).alias(value))
    )
