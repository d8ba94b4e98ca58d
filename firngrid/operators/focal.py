"""Neighbourhood operators on grids.

The base is :func:`focal`: every cell sends its bands to the cells around it and these
aggregate what they get. :func:`focal_blocks` gives the same sums from dense tiles with a
halo, for kernels of many cells.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firngrid.operators import raster, stats, tiles
from firngrid.sources.shared import staged, unsent

# The smoothing kernel and the gradient operator.
SMOOTHING = (
    (0.625, 0.625, 0.625, 0.625, 0.625),
    (0.625, 1.5, 1.5, 1.5, 0.625),
    (0.625, 1.5, 3.0, 1.5, 0.625),
    (0.625, 1.5, 1.5, 1.5, 0.625),
    (0.625, 0.625, 0.625, 0.625, 0.625),
)
GRADIENT = ((-2, -1, 0, 2, 1), (-4, -8, 0, 8, 4), (-6, -12, 0, 12, 6), (-4, -8, 0, 8, 4), (-2, -1, 0, 2, 1))


def box(radius: int, weight: float = 1.0) -> list[tuple[int, int, float]]:
    """Offsets of a square neighbourhood."""
    span = range(-radius, radius + 1)
    return [(di, dj, weight) for dj in span for di in span]


def weighted(kernel) -> list[tuple[int, int, float]]:
    """Offsets of a square kernel, rows by j and columns by i."""
    r = len(kernel) // 2
    return [(di - r, dj - r, float(w)) for dj, row in enumerate(kernel) for di, w in enumerate(row)]


def focal(cells: DataFrame, bands: list[str], offsets: list[tuple[int, int, float]], aggs: list[Column]) -> DataFrame:
    """``i, j`` and ``aggs`` of what lies around each cell of ``cells``.

    The aggregates see ``di, dj, w`` of an offset and the bands of the cell at that offset. The
    offsets are literals of the plan, so a cell is joined with nothing.
    """
    each = F.array(*[F.struct(F.lit(a).alias("di"), F.lit(b).alias("dj"), F.lit(float(w)).alias("w")) for a, b, w in offsets])
    sent = cells.select("i", "j", *bands, F.inline(each)).select(
        (F.col("i") - F.col("di")).alias("i"), (F.col("j") - F.col("dj")).alias("j"), "di", "dj", "w", *bands
    )
    found = sent.groupBy("i", "j").agg(*aggs)
    return cells.select("i", "j").join(unsent(found), ["i", "j"])


def focal_blocks(cells: DataFrame, band: str, kernel, size: int = 64) -> DataFrame:
    """``i, j, total, weight, unknown``: kernel sums over known cells, by dense tiles with a halo.

    ``unknown`` counts the cells under the kernel that are there without a value.
    """
    k = np.array(kernel, float)
    r = len(k) // 2
    spans = [
        F.sequence(F.floor((F.col(c) - r) / size).cast("int"), F.floor((F.col(c) + r) / size).cast("int")) for c in ("i", "j")
    ]
    dealt = cells.select("i", "j", band, F.explode(spans[0]).alias("ti"), spans[1].alias("tjs")).select("i", "j", band, "ti", F.explode("tjs").alias("tj"))

    def summed(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        i0, j0 = key[0] * size - r, key[1] * size - r
        shape = (size + 2 * r, size + 2 * r)
        value, known, held = np.zeros(shape), np.zeros(shape), np.zeros(shape, bool)
        at = frame["j"].to_numpy() - j0, frame["i"].to_numpy() - i0
        v = frame[band].to_numpy(float)
        held[at] = True
        value[at] = np.nan_to_num(v)
        known[at] = ~np.isnan(v)
        total, weight, unknown = np.zeros((size, size)), np.zeros((size, size)), np.zeros((size, size), int)
        blank = held & (known == 0)
        for a in range(2 * r + 1):
            for b in range(2 * r + 1):
                total += k[a, b] * value[a : a + size, b : b + size]
                weight += k[a, b] * known[a : a + size, b : b + size]
                unknown += blank[a : a + size, b : b + size]
        jj, ii = np.nonzero(held[r : r + size, r : r + size])
        return pd.DataFrame({"i": ii + i0 + r, "j": jj + j0 + r, "total": total[jj, ii], "weight": weight[jj, ii], "unknown": unknown[jj, ii]})

    return dealt.groupBy("ti", "tj").applyInPandas(summed, "i int, j int, total double, weight double, unknown long")


def mean(cells: DataFrame, band: str, offsets, strict: bool = False) -> DataFrame:
    """Weighted mean of the known cells around; with ``strict`` null if one of them is unknown.

    Squares wider than 3 x 3 are summed in tiles with a halo, so that a cell is not sent once for
    each cell around it.
    """
    v = F.col(band)
    r = max(max(abs(di), abs(dj)) for di, dj, _ in offsets)
    if r > 1 and len({(di, dj) for di, dj, _ in offsets}) == (2 * r + 1) ** 2:
        kernel = np.zeros((2 * r + 1, 2 * r + 1))
        for di, dj, w in offsets:
            kernel[dj + r, di + r] += w
        sums = focal_blocks(cells, band, kernel)
        value = F.col("total") / F.nullif("weight", F.lit(0.0))
        return sums.select("i", "j", (F.when(F.col("unknown") == 0, value) if strict else value).alias(band))
    value = F.sum(v * F.col("w")) / F.sum(F.when(v.isNotNull(), F.col("w")))
    if strict:
        value = F.when(F.count(v) == F.count("*"), value)
    return focal(cells, [band], offsets, [value.alias(band)])


def _at(band: str, di: int, dj: int) -> Column:
    return F.max(F.when((F.col("di") == di) & (F.col("dj") == dj), F.col(band)))


def slope_aspect(cells: DataFrame, band: str, size: float) -> DataFrame:
    """``i, j, slope, aspect`` in degrees by third-order differences; aspect clockwise from north, flat -1.

    Rows of the grid run south; cells at the border are null.
    """
    z = {(a, b): _at(band, a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)}
    dx = (z[1, -1] + 2 * z[1, 0] + z[1, 1] - z[-1, -1] - 2 * z[-1, 0] - z[-1, 1]) / (8 * size)
    dy = (z[-1, 1] + 2 * z[0, 1] + z[1, 1] - z[-1, -1] - 2 * z[0, -1] - z[1, -1]) / (8 * size)
    out = focal(cells, [band], box(1), [dx.alias("dx"), dy.alias("dy")])
    turned = F.degrees(F.atan2(-F.col("dx"), F.col("dy")))
    flat = (F.col("dx") == 0) & (F.col("dy") == 0)
    known = F.col("dx").isNotNull() & F.col("dy").isNotNull()
    aspect = F.when(flat, -1.0).otherwise(F.when(turned < 0, turned + 360.0).otherwise(turned))
    return out.select(
        "i", "j", F.degrees(F.atan(F.sqrt(F.col("dx") ** 2 + F.col("dy") ** 2))).alias("slope"), F.when(known, aspect).alias("aspect")
    )


def curvature(cells: DataFrame, band: str, size: float) -> DataFrame:
    """``i, j, plan, profile``: curvature of the fitted fourth-order surface, times 100; flat is 0."""
    z = {(a, b): _at(band, a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)}
    terms = [
        ((z[-1, 0] + z[1, 0]) / 2 - z[0, 0]).alias("d"), ((z[0, -1] + z[0, 1]) / 2 - z[0, 0]).alias("e"),
        ((-z[-1, -1] + z[1, -1] + z[-1, 1] - z[1, 1]) / 4).alias("f"), ((z[1, 0] - z[-1, 0]) / 2).alias("g"), ((z[0, -1] - z[0, 1]) / 2).alias("h"),
    ]
    d, e, f, g, h = (F.col(c) for c in "defgh")
    d, e, f, g, h = d / size**2, e / size**2, f / size**2, g / size, h / size
    steep = g * g + h * h
    over = F.nullif(steep, F.lit(0.0))
    plan, profile = 200 * (d * h * h + e * g * g - f * g * h) / over, -200 * (d * g * g + e * h * h + f * g * h) / over
    known = (d + e + f + g + h).isNotNull()
    return focal(cells, [band], box(1), terms).select(
        "i", "j", F.when(known, F.coalesce(plan, F.lit(0.0))).alias("plan"), F.when(known, F.coalesce(profile, F.lit(0.0))).alias("profile")
    )


def rescaled(cells: DataFrame, band: str, to: float = 200.0) -> DataFrame:
    """Negative and positive parts stretched to ``-to .. to`` by the layer's extremes."""
    ends = cells.agg(F.min(band).alias("_low"), F.max(band).alias("_high"))
    v = F.col(band)
    value = F.when(v <= 0, v * (to / F.nullif(-F.col("_low"), F.lit(0.0)))).otherwise(v * (to / F.col("_high")))
    return cells.crossJoin(F.broadcast(ends)).withColumn(band, F.when(v == 0, 0.0).otherwise(value)).drop("_low", "_high")


def ruggedness(terrain: DataFrame, n: int = 7) -> DataFrame:
    """``i, j, ruggedness`` of ``i, j, slope, aspect``: how unit normals spread in n x n cells, 0 to 100.

    Null near the border and near unknown cells.
    """
    flat, s, a = F.col("aspect") < 0, F.radians("slope"), F.radians("aspect")
    parts = terrain.select(
        "i", "j", F.when(flat, 0.0).otherwise(F.sin(a) * F.sin(s)).alias("x"), F.when(flat, 0.0).otherwise(F.cos(a) * F.sin(s)).alias("y"), F.cos(s).alias("z")
    )
    ones = np.ones((n, n))
    sums = tiles.kernel_sums(parts, {c: (c, ones) for c in "xyz"})
    r = F.sqrt(F.col("x") ** 2 + F.col("y") ** 2 + F.col("z") ** 2)
    return sums.select("i", "j", F.when(F.col("z_n") == n * n, 100 * (1 - r / n**2)).alias("ruggedness"))


def hillshade(terrain: DataFrame, azimuth: float = 315.0, altitude: float = 45.0) -> DataFrame:
    """``i, j, shade`` 0 to 255 of ``i, j, slope, aspect``."""
    high, s = math.radians(altitude), F.radians("slope")
    turn = F.cos(F.radians(F.lit(azimuth)) - F.radians(F.when(F.col("aspect") < 0, 0.0).otherwise(F.col("aspect"))))
    shade = 255 * (math.sin(high) * F.cos(s) + math.cos(high) * F.sin(s) * turn)
    return terrain.select("i", "j", F.greatest(shade, F.lit(0.0)).alias("shade"))


def relief(cells: DataFrame, band: str) -> DataFrame:
    """``i, j, shade`` -1 to 1 from central differences, light from the east at 45 degrees."""
    gx = (_at(band, 1, 0) - _at(band, -1, 0)) / 2
    gy = (_at(band, 0, 1) - _at(band, 0, -1)) / 2
    out = focal(cells, [band], box(1), [gx.alias("gx"), gy.alias("gy")])
    slope = math.pi / 2 - F.atan(F.sqrt(F.col("gx") ** 2 + F.col("gy") ** 2))
    aspect = F.atan2(-F.col("gy"), F.col("gx"))
    half = math.sqrt(0.5)
    return out.select("i", "j", (half * F.sin(slope) + half * F.cos(slope) * F.cos(-aspect)).alias("shade"))


def grid_size(cells: DataFrame) -> tuple[int, int]:
    """Columns and rows of a grid that starts at 0."""
    row = cells.agg(F.max("i"), F.max("j")).first()
    return (row[0] or 0) + 1, (row[1] or 0) + 1


def mirrored(cells: DataFrame, nx: int, ny: int, radius: int) -> DataFrame:
    """Cells with mirror images beyond the border, as far as ``radius``, again and again on a narrow grid."""
    return reflected(reflected(cells, "i", nx, radius), "j", ny, radius)


def _inside(cells: DataFrame, nx: int, ny: int) -> DataFrame:
    return cells.where((F.col("i") >= 0) & (F.col("i") < nx) & (F.col("j") >= 0) & (F.col("j") < ny))


def gradient_lapse(cells: DataFrame, height: str, value: str, size: float) -> DataFrame:
    """``i, j, lapse``: change of a value along the slope, by 5 x 5 gradients with mirrored borders."""
    nx, ny = grid_size(cells)
    east = np.array(GRADIENT, float) / (960.0 * size)
    kernels = {"hx": (height, east), "hy": (height, east.T), "tx": (value, east), "ty": (value, east.T)}
    out = _inside(tiles.kernel_sums(mirrored(cells.select("i", "j", height, value), nx, ny, 2), kernels), nx, ny)
    hx, hy = F.col("hx"), F.col("hy")
    steep = hx * hx + hy * hy
    return out.select("i", "j", ((F.col("tx") * hx + F.col("ty") * hy) / F.nullif(steep, F.lit(0.0))).alias("lapse"), F.sqrt(steep).alias("steepness"))


def difference_lapse(cells: DataFrame, height: str, value: str) -> DataFrame:
    """``i, j, lapse_x, lapse_y`` by central differences; null at the border and where height is level."""
    across = lambda b, a: _at(b, *a) - _at(b, -a[0], -a[1])
    aggs = [across(b, a).alias(n) for b, a, n in ((height, (1, 0), "hx"), (height, (0, 1), "hy"), (value, (1, 0), "vx"), (value, (0, 1), "vy"))]
    out = focal(cells, [height, value], box(1), aggs)
    return out.select("i", "j", *[(F.col(f"v{d}") / F.nullif(F.col(f"h{d}"), F.lit(0.0))).alias(f"lapse_{d}") for d in "xy"])


def gaussian_weights(sigma: float, truncate: float = 4.0) -> list[float]:
    """Weights of a one-dimensional Gaussian, normalised."""
    r = int(truncate * sigma + 0.5)
    w = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-r, r + 1)]
    return [x / sum(w) for x in w]


def blur(cells: DataFrame, band: str | list[str], sigma: float) -> DataFrame:
    """``i, j`` and the bands by a Gaussian with mirrored borders, in dense strips along each axis.

    A grid narrower than the kernel is mirrored again and again.
    Unknown cells are left out and the rest reweighted, which fills holes.
    """
    bands = [band] if isinstance(band, str) else band
    w = gaussian_weights(sigma)
    out = cells.select("i", "j", *bands)
    for name, n in zip("ij", grid_size(cells), strict=True):
        out = tiles.strip_means(reflected(out, name, n, len(w) // 2), bands, name, n, w)
    return out


def reflected(cells: DataFrame, axis: str, n: int, reach: int) -> DataFrame:
    """``cells`` and their images along one axis of ``n`` cells, up to ``reach`` beyond the borders."""
    turns = range(-(reach // (2 * n)) - 1, reach // (2 * n) + 2)
    images = F.array(*[F.struct(F.lit(s).alias("_sign"), F.lit(2 * n * k - (s < 0)).alias("_shift")) for k in turns for s in (1, -1)])
    at = F.col(axis) * F.col("_sign") + F.col("_shift")
    return cells.select("*", F.inline(images)).withColumn(axis, at.cast("int")).where(F.col(axis).between(-reach, n - 1 + reach)).drop("_sign", "_shift")


def blur_by_height(cells: DataFrame, band: str, height: str, size: float, sigma: tuple[float, float, float]) -> DataFrame:
    """Gaussian mean over cells near in plan and height, within two sigmas, in tiles with a halo."""
    reach = 2 * max(sigma[:2])
    r = math.ceil(reach / size)
    offsets = [(a, b) for a, b, _ in box(r) if (a * a + b * b) * size * size <= reach * reach]
    n = max(128, 8 * r)

    def made(arrays: dict[str, np.ndarray], there: np.ndarray) -> dict[str, np.ndarray]:
        own = arrays[height][r : r + n, r : r + n]
        total, weight = np.zeros((n, n)), np.zeros((n, n))
        for a, b in offsets:
            at = slice(r + b, r + b + n), slice(r + a, r + a + n)
            q = (a * (size / sigma[0])) ** 2 + (b * (size / sigma[1])) ** 2 + ((arrays[height][at] - own) / sigma[2]) ** 2
            w = np.where(q <= 4.0, np.exp(-0.5 * q), 0.0)  # an unknown height is near to none
            v = arrays[band][at]
            total += w * np.nan_to_num(v)
            weight += w * ~np.isnan(v)
        found = np.full((n, n), np.nan)
        np.divide(total, weight, out=found, where=weight > 0)
        return {band: found}

    known = cells.where(F.col(height).isNotNull())
    return tiles.over_tiles(known, [band, height], r, made, [band], n)


def blur_by_levels(cells: DataFrame, band: str, height: str, size: float, sigma: tuple[float, float, float]) -> DataFrame:
    """As ``blur_by_height`` with heights in steps of half a sigma, then scaled to keep the sum."""
    step = sigma[2] / 2
    stepped = cells.withColumn(height, F.floor(F.col(height) / step) * step)
    smooth = staged(blur_by_height(stepped, band, height, size, sigma), "smooth")
    before = cells.where(F.col(height).isNotNull()).agg(F.sum(band).alias("before"))
    after = smooth.agg(F.sum(band).alias("after"))
    ratio = before.crossJoin(after).select((F.col("before") / F.nullif(F.col("after"), F.lit(0.0))).alias("ratio"))
    return smooth.crossJoin(F.broadcast(ratio)).select("i", "j", (F.col(band) * F.col("ratio")).alias(band))


def spread(coarse: DataFrame, fine: DataFrame, factor: int, *bands: str) -> DataFrame:
    """``i, j, bands``: the values of the coarse cell (``ci, cj``) that a fine cell lies in."""
    keyed = fine.select("i", "j", F.floor(F.col("i") / factor).cast("int").alias("ci"), F.floor(F.col("j") / factor).cast("int").alias("cj"))
    return keyed.join(coarse.select("ci", "cj", *bands), ["ci", "cj"], "left").select("i", "j", *bands)


def downscaled(fine: DataFrame, coarse: DataFrame, factor: int, snow: str, lapse: str) -> DataFrame:
    """``i, j, snow``: coarse snow on the fine grid, changed by a lapse rate with height.

    ``fine`` has ``i, j, elev``; ``coarse`` has ``ci, cj`` and the two bands. Snow, lapse and the mean
    height of the coarse cells are spread and blurred; where a height is unknown, nothing is added.
    """
    height = raster.coarsen(fine, factor, [F.avg("elev").alias("_e")])
    both = coarse.select("ci", "cj", F.col(snow).alias("_s"), F.col(lapse).alias("_l")).join(height, ["ci", "cj"], "full")
    smooth = blur(staged(spread(both, fine, factor, "_s", "_l", "_e"), "layers"), ["_s", "_l", "_e"], float(factor))
    out = fine.select("i", "j", "elev").join(smooth, ["i", "j"])
    change = F.coalesce(F.col("_l") * (F.col("elev") - F.col("_e")), F.lit(0.0))
    return out.select("i", "j", F.greatest(F.col("_s") + change, F.lit(0.0)).alias(snow))


def scaled_lapse(coarse: DataFrame, size: float, least_steepness: float = 0.004) -> DataFrame:
    """``ci, cj, snow, lapse``: the median local ratio of lapse to snow, times snow.

    ``coarse`` has ``ci, cj, elev, snow``. Level ground and negative rates do not count.
    """
    grid = coarse.select(F.col("ci").alias("i"), F.col("cj").alias("j"), "elev", "snow")
    local = gradient_lapse(grid, "elev", "snow", size)
    usable = local.where((F.col("steepness") >= least_steepness) & (F.col("lapse") >= 0)).select("i", "j", "lapse")
    both = grid.join(usable, ["i", "j"], "left")
    scaled = stats.scaled_by_median_ratio(both, "lapse", "snow")
    return scaled.select(F.col("i").alias("ci"), F.col("j").alias("cj"), "snow", F.col("scaled").alias("lapse"))


def cleaned_lapse(cells: DataFrame, least_height: float = 200.0) -> DataFrame:
    """Unusable rates (low ground, no snow, negative, unknown) become the mean of the usable ones."""
    ok = (F.col("elev") >= least_height) & (F.col("snow") > 0) & (F.col("lapse") >= 0)
    middle = cells.where(ok).agg(F.avg("lapse").alias("_mean"))
    value = F.when(F.coalesce(ok, F.lit(False)), F.col("lapse")).otherwise(F.col("_mean"))
    return cells.crossJoin(F.broadcast(middle)).withColumn("lapse", value).drop("_mean")


def margin_ring(cells: DataFrame, nx: int, ny: int, width: int) -> DataFrame:
    """``i, j, margin``: whether a cell is within ``width`` of the tile's border."""
    inner = F.col("i").between(width, nx - width - 1) & F.col("j").between(width, ny - width - 1)
    return cells.select("i", "j", (~inner).alias("margin"))
