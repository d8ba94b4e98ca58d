"""Column functions on release areas, results and terrain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SNOW_DENSITY = 200.0
FLOW_DENSITY = 300.0
FOREST_CODES = (41, 42, 43)
OCEAN, OUTSIDE = 11, 0
# Bounds of the size classes, in cubic metres.
SIZE_BOUNDS = ((5_000.0, "T"), (25_000.0, "S"), (60_000.0, "M"))


def snow_depth(swe: Column, density: float = SNOW_DENSITY) -> Column:
    """Depth of snow from its water equivalent."""
    return swe / density


def release_volume(area: Column, depth: Column, slope: Column) -> Column:
    """Volume of a release area from its map area, depth and slope in degrees."""
    return area * depth / F.cos(F.radians(slope))


def size_class(volume: Column) -> Column:
    """T, S, M or L; null below 0."""
    column = F.when(volume < 0, F.lit(None))
    for bound, name in SIZE_BOUNDS:
        column = column.when(volume < bound, name)
    return F.when(volume.isNotNull(), column.otherwise("L"))


def pressure(velocity: Column, density: float = FLOW_DENSITY) -> Column:
    """Impact pressure in Pa, kept with 4 bytes."""
    v = velocity.cast("float").cast("double")
    return (density * v * v).cast("float")


def corrected_depth(
    swe_depth: Column, elev: Column, slope: Column, reference: float = 1500.0, gradient: float = 0.05, form: str = "flat"
) -> list[Column]:
    """``d0star, wind, slopecorr, d0`` by elevation, wind load and slope.

    ``form`` chooses between the two slope corrections.
    """
    star = (swe_depth + (elev - reference) / 100.0 * gradient) * F.cos(F.radians(F.lit(28.0)))
    wind = F.when(elev >= 2000, 0.1).when(elev <= 1000, 0.0).otherwise((elev - 1000) * 0.0001)
    sin, cos = F.sin(F.radians(slope)), F.cos(F.radians(slope))
    corr = 0.219 / sin - 0.202 * cos if form == "flat" else 0.291 / (sin - 0.202 * cos)
    return [
        star.alias("d0star"),
        wind.alias("wind"),
        corr.alias("slopecorr"),
        ((star + wind) * corr).alias("d0"),
    ]


def aspect_class(aspect: Column, axis: str) -> Column:
    """Sector code -200..200 by 45 degrees; ``axis`` is ``north0`` or ``northmax``; flat is null."""
    sector = F.floor((aspect + 22.5) / 45).cast("int") % 8
    codes = (0, 100, 200, 100, 0, -100, -200, -100) if axis == "north0" else (200, 100, 0, -100, -200, -100, 0, 100)
    return F.when(aspect >= 0, F.element_at(F.array(*[F.lit(c) for c in codes]), sector + 1))


def is_forest(landcover: Column) -> Column:
    """Whether a landcover code is forest."""
    return landcover.isin(*FOREST_CODES)


def is_land(landcover: Column) -> Column:
    """Whether a landcover code is land."""
    return ~landcover.isin(OCEAN, OUTSIDE)


def chunk_name(size: Column, chunk: Column, forest: Column, resolution: Column, period: Column) -> Column:
    """Name of a chunk's slope folder and avalanche set."""
    return F.format_string("c-%s-%05d%s_%dm_%d%s", size, chunk, forest, resolution, period, size)


def layer_name(exp: Column, era: Column, forest: Column, period: Column, i: Column, j: Column, layer: str) -> Column:
    """File name of a published layer; a pair of forest flags is called All."""
    both = F.regexp_replace(forest, "^(For|NoFor)$", "All")
    return F.format_string(f"%s-%s-%s-%d-%03d-%03d-{layer}.tif", exp, era, both, period, i, j)
