"""Column functions on grids, spirals, boxes, rings and projections."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """A regular grid: upper left corner, cell sizes, numbers of cells."""

    x0: float
    dx: float
    y0: float
    dy: float
    nx: int
    ny: int


def cell_to_xy(i: Column, j: Column, grid: Grid) -> tuple[Column, Column]:
    """Coordinates of the centre of a cell."""
    return grid.x0 + (i + 0.5) * grid.dx, grid.y0 + (j + 0.5) * grid.dy


def xy_to_cell(x: Column, y: Column, grid: Grid) -> tuple[Column, Column]:
    """The cell that holds a point."""
    return (
        F.floor((x - grid.x0) / grid.dx).cast("int"),
        F.floor((y - grid.y0) / grid.dy).cast("int"),
    )


def grid_shift(x0_map: float, x0_own: float, dx: float) -> int:
    """Cells to add to an own index to get the map's."""
    return round(-(x0_map - x0_own) / dx)


def spiral_number(x: Column, y: Column) -> Column:
    """Number of a cell on the spiral around (0, 0); a long, since it grows with the square of the distance."""
    x, y = x.cast("long"), y.cast("long")
    k = F.greatest(F.abs(x), F.abs(y))
    turn = F.when(x < y, -1).otherwise(1)
    return 4 * k * k + turn * (2 * k + x + y)


def spiral_cell(n: Column) -> tuple[Column, Column]:
    """``x, y`` of a number on the spiral."""
    m = F.floor(F.sqrt(n.cast("double")))
    along = n - m * (m + 1)
    in_x = F.floor(2 * F.sqrt(n.cast("double"))) % 2 == 0
    turn = F.when(m % 2 == 0, 1).otherwise(-1)
    half = F.floor((m + 1) / 2)
    return (
        (turn * (F.when(in_x, along).otherwise(0) + half)).cast("int"),
        (turn * (F.when(in_x, 0).otherwise(along) - half)).cast("int"),
    )


def relative_neighbour(cell: Column, other: Column, nx: int) -> Column:
    """Clockwise spiral number of ``other`` seen from ``cell``; negative codes stay."""
    row = lambda c: F.floor(c / nx)
    number = spiral_number(row(other) - row(cell), other % nx - cell % nx)
    return F.when(other < 0, other).otherwise(number).cast("long")


def absolute_neighbour(cell: Column, number: Column, nx: int) -> Column:
    """The cell that a clockwise spiral number means; negative codes stay."""
    dj, di = spiral_cell(number)
    return F.when(number < 0, number).otherwise(cell + dj * nx + di).cast("long")


def points(*pairs: tuple[Column, Column]) -> Column:
    """A ring of points."""
    return F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in pairs])




def edge_lengths(ring: Column) -> Column:
    """Lengths of the edges of a ring."""
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring) - 1), F.slice(ring, 1, 1))
    return F.zip_with(ring, following, lambda p, q: F.hypot(q["x"] - p["x"], q["y"] - p["y"]))


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, x: a + x)


def _crosses(ring: Column, weight=None) -> Column:
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring) - 1), F.slice(ring, 1, 1))
    cross = lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]
    return F.zip_with(ring, following, lambda p, q: cross(p, q) * (weight(p, q) if weight else F.lit(1.0)))


def ring_area(ring: Column) -> Column:
    """Area of a ring."""
    return F.abs(_sum(_crosses(ring))) / 2


def ring_centroid(ring: Column) -> tuple[Column, Column]:
    """Centre of mass of a ring; null for a ring without area."""
    six = F.when(_sum(_crosses(ring)) != 0, 3 * _sum(_crosses(ring)))
    return (
        _sum(_crosses(ring, lambda p, q: p["x"] + q["x"])) / six,
        _sum(_crosses(ring, lambda p, q: p["y"] + q["y"])) / six,
    )


def grown_rectangle(ring: Column, margin: Column) -> Column:
    """A (rotated) rectangle with ``margin`` added to both lengths; null if it would invert."""
    x = [F.element_at(ring, k)["x"] for k in (1, 2, 3, 4)]
    y = [F.element_at(ring, k)["y"] for k in (1, 2, 3, 4)]
    edge = [(x[(k + 1) % 4] - x[k], y[(k + 1) % 4] - y[k]) for k in range(4)]
    length = [F.hypot(*e) for e in edge]
    step = [[margin / 2 * e[d] / length[k] for d in (0, 1)] for k, e in enumerate(edge)]
    moved = [
        (x[k] + step[k - 1][0] - step[k][0], y[k] + step[k - 1][1] - step[k][1]) for k in range(4)
    ]
    fits = (length[0] + margin >= 0) & (length[1] + margin >= 0) & (length[0] > 0) & (length[1] > 0)
    return F.when(fits, points(*moved))


def box_with_margin(x0: Column, y0: Column, x1: Column, y1: Column, margin: float) -> list[Column]:
    """The corners of a box grown by a margin on each side."""
    return [x0 - margin, y0 - margin, x1 + margin, y1 + margin]


# The Alaska Albers projection on GRS80.
_A, _FLATTENING = 6378137.0, 1 / 298.257222101
_LAT1, _LAT2, _LAT0, _LON0 = (math.radians(d) for d in (55.0, 65.0, 50.0, -154.0))
_E2 = _FLATTENING * (2 - _FLATTENING)
_E = math.sqrt(_E2)


def _q(sin: float) -> float:
    return (1 - _E2) * (sin / (1 - _E2 * sin**2) - math.log((1 - _E * sin) / (1 + _E * sin)) / (2 * _E))


def _m2(lat: float) -> float:
    return math.cos(lat) ** 2 / (1 - _E2 * math.sin(lat) ** 2)


_N = (_m2(_LAT1) - _m2(_LAT2)) / (_q(math.sin(_LAT2)) - _q(math.sin(_LAT1)))
_C = _m2(_LAT1) + _N * _q(math.sin(_LAT1))
_RHO0 = _A * math.sqrt(_C - _N * _q(math.sin(_LAT0))) / _N


def albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Metres east and north in the equal-area projection, from degrees."""
    sin = F.sin(F.radians(lat))
    q = (1 - _E2) * (sin / (1 - _E2 * sin * sin) - F.log((1 - _E * sin) / (1 + _E * sin)) / (2 * _E))
    rho = _A * F.sqrt(_C - _N * q) / _N
    theta = _N * (F.radians(lon) - _LON0)
    return rho * F.sin(theta), _RHO0 - rho * F.cos(theta)


#: The projection's constants, for SQL that has to give the same numbers.
ALBERS = {"a": _A, "e": _E, "e2": _E2, "n": _N, "c": _C, "rho0": _RHO0, "lon0": _LON0}
