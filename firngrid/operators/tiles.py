"""Dense tiles with a halo, and dense strips along an axis: wide neighbourhoods in one shuffle.

A cell is sent to its own tile and to those whose halo it lies in, a little more than once,
however many cells a neighbourhood has. Inside of a tile sums are shifts of whole arrays.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells that a strip holds at most, and the half width from which transforms are faster than shifts.
STRIP_CELLS = 2**20
WIDE = 64


def dealt_to_tiles(cells: DataFrame, size: int, halo: int) -> DataFrame:
    """``cells`` with the tile ``ti, tj``, once for each tile that they lie in or within ``halo`` of."""
    span = lambda c: F.sequence(F.floor((F.col(c) - halo) / size).cast("int"), F.floor((F.col(c) + halo) / size).cast("int"))
    wide = cells.select("*", F.explode(span("i")).alias("ti"), span("j").alias("_tjs"))
    return wide.select("*", F.explode("_tjs").alias("tj")).drop("_tjs")


def over_tiles(cells: DataFrame, bands: list[str], halo: int, made: Callable[[dict[str, np.ndarray], np.ndarray], dict[str, np.ndarray]], names: list[str], size: int = 128) -> DataFrame:
    """``i, j, names`` of every cell of ``cells (i, j, bands)``.

    ``made`` gets an array of each band with its halo (NaN where unknown or not there) and an
    array of which cells are there; it returns arrays of the tile without its halo, NaN for null.
    """

    def tile(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        n = size + 2 * halo
        i0, j0 = key[0] * size - halo, key[1] * size - halo
        ii, jj = frame["i"].to_numpy() - i0, frame["j"].to_numpy() - j0
        there = np.zeros((n, n), bool)
        there[jj, ii] = True
        arrays = {}
        for b in bands:
            arrays[b] = np.full((n, n), np.nan)
            arrays[b][jj, ii] = frame[b]
        j, i = np.nonzero(there[halo : halo + size, halo : halo + size])
        found = made(arrays, there) if len(i) else {}
        out = {c: found[c][j, i] if len(i) else [] for c in names}
        out = {c: np.where(np.isnan(v), None, v) if len(i) else v for c, v in out.items()}
        return pd.DataFrame({"i": i + i0 + halo, "j": j + j0 + halo, **out})

    rows = dealt_to_tiles(cells.select("i", "j", *[F.col(b).cast("double").alias(b) for b in bands]), size, halo)
    schema = ", ".join(["i int, j int", *[f"`{c}` double" for c in names]])
    return rows.groupBy("ti", "tj").applyInPandas(tile, schema)


def kernel_sums(cells: DataFrame, kernels: dict[str, tuple[str, np.ndarray]], size: int = 128) -> DataFrame:
    """``i, j``, for each ``name: (band, square kernel)`` the sum over known cells, and ``name_n``, how many they are.

    Of all bands and kernels in one pass; a sum over no known cell is null. Kernels are indexed
    by j and then i.
    """
    halo = max(len(k) // 2 for _, k in kernels.values())
    bands = sorted({b for b, _ in kernels.values()})

    def made(arrays: dict[str, np.ndarray], there: np.ndarray) -> dict[str, np.ndarray]:
        value = {b: np.nan_to_num(arrays[b]) for b in bands}
        known = {b: (~np.isnan(arrays[b])).astype(float) for b in bands}
        out = {}
        for name, (band, kernel) in kernels.items():
            r = len(kernel) // 2
            total, count = np.zeros((size, size)), np.zeros((size, size))
            for (dj, di), w in np.ndenumerate(kernel):
                at = slice(halo - r + dj, halo - r + dj + size), slice(halo - r + di, halo - r + di + size)
                count += known[band][at]
                if w:
                    total += w * value[band][at]
            out[name], out[f"{name}_n"] = np.where(count > 0, total, np.nan), count
        return out

    return over_tiles(cells, bands, halo, made, [c for name in kernels for c in (name, f"{name}_n")], size)


def _along(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted sums along each row, for the positions that have all of their neighbours."""
    r, n = len(weights) // 2, rows.shape[1] - len(weights) + 1
    if r <= WIDE:
        return sum(w * rows[:, d : d + n] for d, w in enumerate(weights))
    length = 1 << (rows.shape[1] - 1).bit_length()
    spectrum = np.fft.rfft(rows, length) * np.fft.rfft(weights[::-1], length)
    return np.fft.irfft(spectrum, length)[:, 2 * r : 2 * r + n]


def strip_means(cells: DataFrame, bands: list[str], axis: str, n: int, weights: list[float]) -> DataFrame:
    """``i, j, bands``: weighted means of the known cells along one axis of ``n`` cells.

    ``cells`` may reach beyond the ``n`` cells by half the width of the weights. Strips are at
    least twice as long as what they reach into, so a cell is sent twice at most, whatever the
    width is.
    """
    other = "j" if axis == "i" else "i"
    w = np.array(weights)
    r = len(w) // 2
    length = max(256, 2 * r)
    high = max(1, min(256, STRIP_CELLS // (length + 2 * r)))
    last = (n - 1) // length
    first_of, last_of = F.floor((F.col(axis) - r) / length), F.floor((F.col(axis) + r) / length)
    strips = F.sequence(F.greatest(first_of, F.lit(0)).cast("int"), F.least(last_of, F.lit(last)).cast("int"))
    rows = cells.select("i", "j", *[F.col(b).cast("double").alias(b) for b in bands], F.floor(F.col(other) / high).cast("int").alias("_block"), F.explode(strips).alias("_strip"))

    def smooth(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        a = frame[axis].to_numpy() - (key[1] * length - r)
        b = frame[other].to_numpy() - key[0] * high
        there = np.zeros((high, length + 2 * r), bool)
        there[b, a] = True
        there[:, max(0, n - key[1] * length + r) :] = False  # beyond the grid
        y, x = np.nonzero(there[:, r : r + length])
        out = {axis: x + key[1] * length, other: y + key[0] * high}
        for band in bands:
            value, known = np.zeros(there.shape), np.zeros(there.shape)
            v = frame[band].to_numpy(float)
            value[b, a], known[b, a] = np.nan_to_num(v), ~np.isnan(v)
            sums = np.cumsum(known, 1)
            met = sums[:, 2 * r :] - np.pad(sums, ((0, 0), (1, 0)))[:, :length]
            mean = np.full((high, length), np.nan)
            np.divide(_along(value, w), _along(known, w), out=mean, where=met > 0.5)
            found = mean[y, x]
            out[band] = np.where(np.isnan(found), None, found)
        return pd.DataFrame(out)[["i", "j", *bands]]

    return rows.groupBy("_block", "_strip").applyInPandas(smooth, ", ".join(["i int, j int", *[f"`{b}` double" for b in bands]]))
