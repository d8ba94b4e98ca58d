"""Holes of a grid filled by relaxation: every unknown cell becomes the mean of those around it.

This is a sparse linear system over the unknown cells only. It is solved without rounds
(``solved``): each tile is reduced to the equations of the cells on its rim, squares of tiles to
those of the cells that are linked to other squares, and so on until nothing leaves a square; then values are handed
down again, square by square. So the steps grow with the logarithm of a hole's length. What one
task holds are the cells linked across the rims of a few squares, and it is known beforehand: where it is more than
``AT_HAND``, in holes more than some 500 cells wide and as long, the system is relaxed in rounds (``relaxed``).

Each round solves every tile by itself, with a margin of the cells around it (conjugate gradients on its arrays), and takes the
tile's own cells from that; before the next round, a system with one unknown for each tile
takes away the error that is smooth across tiles, so the rounds do not grow with the width of
a hole. Then the last rounds are mixed so that what they changed adds up to as little as can
be (Anderson's acceleration), which takes about the square root of the rounds that it would take
without. The coarse system has the same form as the whole one. It is solved at once where it is small and by
the same rounds where it is not, so nothing that grows with the map is held in one place.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firngrid.operators.parts import grid_parts
from firngrid.operators.tiles import dealt_to_tiles
from firngrid.sources.shared import staged

#: Unknowns of a system that is solved at once.
AT_ONCE = 65_536
#: Rounds that are mixed at most.
MIXED = 8
#: Unknowns that one task eliminates from, by a matrix of their square.
AT_HAND = 4_096
#: Unknowns that are eliminated in a task, in their tiles.
TASK_CELLS = 8_192
#: How many times as wide as the last ones the next squares are, the widest that fit.
FACTORS = (8, 4, 2)
#: The equations ``m x = b`` of the cells of a square that are linked to other squares. A cell is
#: ``j * 2**32 + i``; there is a link of weight ``w`` from each of ``own`` to the one of ``other``. A row of the
#: whole system sums up to ``known``, the weight of its links to known cells, which no subtraction blurs.
SQUARE = "si int, sj int, n int, cells array<long>, m binary, b array<double>, known array<double>, own array<long>, other array<long>, w array<double>"
#: ``e`` and ``s`` are the weights of the links to the cells east (i + 1) and south (j + 1).
SYSTEM = "i int, j int, e double, s double, d double, b double"


def hole_system(cells: DataFrame, band: str, size: int = 128) -> DataFrame:
    """The equations of the cells without a value: ``d`` times a cell is ``b`` and its linked cells.

    ``d`` counts the cells around it that are there, ``b`` sums those that are known. Holes
    that touch no known cell have no solution and are left out.
    """

    def equations(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        n = size + 2
        ii, jj = frame["i"].to_numpy() - key[0] * size + 1, frame["j"].to_numpy() - key[1] * size + 1
        v = frame["v"].to_numpy(float)
        there, hole, value = np.zeros((n, n), bool), np.zeros((n, n), bool), np.zeros((n, n))
        there[jj, ii], hole[jj, ii], value[jj, ii] = True, np.isnan(v), np.nan_to_num(v)
        own = np.argwhere(hole[1:-1, 1:-1]) + 1
        j, i = own.T
        around = ((j, i + 1), (j + 1, i), (j, i - 1), (j - 1, i))
        d, b = sum(there[at].astype(float) for at in around), sum(value[at] for at in around)
        touches = sum((there[at] & ~hole[at]).astype(int) for at in around) > 0
        return pd.DataFrame({"i": i + key[0] * size - 1, "j": j + key[1] * size - 1, "e": hole[around[0]].astype(float), "s": hole[around[1]].astype(float), "d": d, "b": b, "touches": touches})

    # NaN stands for unknown in the arrays; a value that is NaN is unknown too
    rows = dealt_to_tiles(cells.select("i", "j", F.col(band).cast("double").alias("v")), size, 1)
    found = rows.groupBy("ti", "tj").applyInPandas(equations, f"{SYSTEM}, touches boolean")
    found = staged(found.withColumn("cell", F.col("j").cast("long") * 2**32 + F.col("i")), "holes")
    parts = grid_parts(found.select("cell", "i", "j"), [])
    closed = found.select("cell", "touches").join(parts, "cell").groupBy("part").agg(F.bool_or("touches").alias("open")).where("not open")
    # only whole holes without a known neighbour are looked up again
    lost = parts.join(closed.select("part"), "part", "left_semi").select("cell")
    return found.join(lost, "cell", "left_anti").select("i", "j", "e", "s", "d", "b")


def coarse_matrix(system: DataFrame, size: int) -> DataFrame:
    """The system with one unknown for each tile, its right side left out."""
    inside_i, inside_j = (F.pmod(c, F.lit(size)) != size - 1 for c in ("i", "j"))
    tile = [F.floor(F.col(c) / size).cast("int").alias(c) for c in ("i", "j")]
    return system.groupBy(*tile).agg(
        F.sum(F.when(inside_i, 0.0).otherwise(F.col("e"))).alias("e"),
        F.sum(F.when(inside_j, 0.0).otherwise(F.col("s"))).alias("s"),
        F.sum(F.col("d") - 2 * F.when(inside_i, F.col("e")).otherwise(0.0) - 2 * F.when(inside_j, F.col("s")).otherwise(0.0)).alias("d"),
    )


def _gradients(times: Callable[[np.ndarray], np.ndarray], d: np.ndarray, b: np.ndarray, small: float) -> np.ndarray:
    """The solution of ``times(x) = b`` by conjugate gradients scaled by the diagonal ``d``, to residuals of ``small``."""
    x, r = np.zeros_like(b), b.copy()
    z = r / d
    step, rz = z.copy(), float((r * z).sum())
    for _ in range(20 * math.isqrt(b.size) + 100):
        if rz <= 0.0 or np.abs(z).max() <= small:
            break
        a = times(step)
        alpha = rz / float((step * a).sum())
        x, r = x + alpha * step, r - alpha * a
        z = r / d
        rz, before = float((r * z).sum()), rz
        step = z + rz / before * step
    return x


def _at_once(frame: pd.DataFrame, small: float) -> np.ndarray:
    """The solution of a small system."""
    n, d, b = len(frame), frame["d"].to_numpy(), frame["b"].to_numpy()
    at = {key: k for k, key in enumerate(zip(frame["i"], frame["j"], strict=True))}
    links = [
        (k, at[i + di, j + dj], w)
        for weights, di, dj in (("e", 1, 0), ("s", 0, 1))
        for k, (i, j, w) in enumerate(zip(frame["i"], frame["j"], frame[weights], strict=True))
        if w and (i + di, j + dj) in at
    ]
    p, q, w = (np.array(x) for x in zip(*links, strict=True)) if links else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    return _gradients(lambda x: d * x - np.bincount(p, w * x[q], n) - np.bincount(q, w * x[p], n), d, b, small)


def _mixture(products: np.ndarray) -> np.ndarray:
    """Weights that add up to 1, by which vectors with these ``products`` add up to the shortest one."""
    n = len(products)
    scaled = products / max(float(products[0, 0]), 1e-300)
    apart = scaled[1:, 1:] - scaled[1:, :1] - scaled[:1, 1:] + scaled[0, 0]  # of their differences from the first
    toward = scaled[0, 0] - scaled[1:, 0]
    rest = np.linalg.lstsq(apart, toward, rcond=1e-12)[0] if n > 1 else np.zeros(0)
    return np.concatenate([[1.0 - rest.sum()], rest])


def relaxed(system: DataFrame, tolerance: float, size: int = 64, margin: int = 8, max_rounds: int = 200) -> DataFrame:
    """``i, j, x``: the solution of a ``SYSTEM``, each cell within ``tolerance`` of what the others say."""
    spark = system.sparkSession
    halo, n = margin + 1, size + 2 * (margin + 1)

    def smooth(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        i0, j0 = key[0] * size - halo, key[1] * size - halo
        ii, jj = frame["i"].to_numpy() - i0, frame["j"].to_numpy() - j0
        e, s, d, b, x = (np.zeros((n, n)) for _ in range(5))
        for array, name in ((e, "e"), (s, "s"), (d, "d"), (b, "b"), (x, "x")):
            array[jj, ii] = frame[name]
        free = np.zeros((n, n), bool)
        free[jj, ii] = True
        free[[0, -1], :] = free[:, [0, -1]] = False

        def linked(y: np.ndarray) -> np.ndarray:
            found = np.zeros_like(y)
            found[:, :-1] += e[:, :-1] * y[:, 1:]
            found[:, 1:] += e[:, :-1] * y[:, :-1]
            found[:-1] += s[:-1] * y[1:]
            found[1:] += s[:-1] * y[:-1]
            return found

        own = (ii >= halo) & (ii < halo + size) & (jj >= halo) & (jj < halo + size)
        oi, oj = ii[own], jj[own]
        was = x[oj, oi].copy()
        over = np.where(d > 0, d, 1.0)
        left = np.where(free, b + linked(x) - d * x, 0.0)
        residual = float(np.abs(left / over)[oj, oi].max(initial=0.0))
        # the change of the free cells that takes this away, those of the outermost ring held
        x += _gradients(lambda y: np.where(free, d * y - linked(y), 0.0), over, left, 1e-3 * tolerance)
        # what the tile's own cells leave over, in the tile and in the four beside it
        core = slice(halo, halo + size)
        first, last = halo, halo + size - 1
        kept = (b - d * x)[core, core].sum()
        kept += (e[core, first:last] * (x[core, first:last] + x[core, first + 1 : last + 1])).sum()
        kept += (s[first:last, core] * (x[first:last, core] + x[first + 1 : last + 1, core])).sum()
        given = [
            (0, 0, kept),
            (1, 0, (e[core, last] * x[core, last]).sum()),
            (-1, 0, (e[core, first - 1] * x[core, first]).sum()),
            (0, 1, (s[last, core] * x[last, core]).sum()),
            (0, -1, (s[first - 1, core] * x[first, core]).sum()),
        ]
        out = frame.loc[own, ["i", "j", "e", "s", "d", "b", "begun", "made", "moves"]].assign(x=x[oj, oi], was=was)
        if not len(out):
            return out.assign(residual=pd.Series(dtype=float), sums=pd.Series(dtype=object))
        out["residual"] = [residual] + [None] * (len(out) - 1)
        out["sums"] = [[{"ti": key[0] + a, "tj": key[1] + c, "r": float(r)} for a, c, r in given if r]] + [None] * (len(out) - 1)
        return out

    schema = f"{SYSTEM}, begun double, made array<double>, moves array<double>, x double, was double, residual double, sums array<struct<ti:int,tj:int,r:double>>"
    system = staged(system, "system")
    coarse = staged(coarse_matrix(system, size), "coarse")
    tiles = coarse.count()
    if not tiles:
        return system.select("i", "j", F.col("b").alias("x"))
    # what the last rounds made of a cell and how far they moved it, the newest first
    state = system.withColumns({"begun": F.lit(0.0), "made": F.array().cast("array<double>"), "moves": F.array().cast("array<double>")})
    given: list[DataFrame] = []
    sums = system.select(F.floor(F.col("i") / size).cast("int").alias("ti"), F.floor(F.col("j") / size).cast("int").alias("tj"), F.col("b").alias("r"))
    for _ in range(max_rounds):
        right = sums.groupBy(F.col("ti").alias("i"), F.col("tj").alias("j")).agg(F.sum("r").alias("b"))
        rest = coarse.join(right, ["i", "j"], "left").fillna(0.0, ["b"])
        if tiles <= AT_ONCE:
            frame = rest.toPandas()  # AT_ONCE rows at most
            frame["x"] = _at_once(frame, 1e-3 * tolerance)
            shift = F.broadcast(spark.createDataFrame(frame[["i", "j", "x"]], "i int, j int, x double"))
        else:
            shift = relaxed(rest, tolerance / 10, size, margin, max_rounds)
        shift = shift.select(F.col("i").alias("ti"), F.col("j").alias("tj"), F.col("x").alias("_shift"))
        own = [F.floor(F.col(c) / size).cast("int").alias(t) for c, t in (("i", "ti"), ("j", "tj"))]
        kept = ["i", "j", "e", "s", "d", "b", "begun", "made", "moves"]
        moved = state.select(*kept, *own).join(shift, ["ti", "tj"], "left").select(*kept, (F.col("begun") + F.coalesce("_shift", F.lit(0.0))).alias("x"))
        done = staged(dealt_to_tiles(moved, size, halo).groupBy("ti", "tj").applyInPandas(smooth, schema), "relaxed")
        newest = lambda c, old: F.slice(F.concat(F.array(c), old), 1, MIXED)
        state = done.withColumns({"made": newest(F.col("x"), F.col("made")), "moves": newest(F.col("x") - F.col("begun"), F.col("moves"))})
        given = [done.where("sums is not null").select(F.inline("sums")), *given][:MIXED]
        pairs = [(p, q) for p in range(len(given)) for q in range(p + 1)]
        found = state.agg(F.max("residual"), *[F.sum(F.get("moves", F.lit(p)) * F.get("moves", F.lit(q))) for p, q in pairs]).first()
        if (found[0] or 0.0) <= tolerance:
            return done.select("i", "j", F.col("was").alias("x"))
        products = np.zeros((len(given), len(given)))
        for (p, q), v in zip(pairs, found[1:], strict=True):
            products[p, q] = products[q, p] = v
        weights = _mixture(products).tolist()
        mixed = lambda c: sum((F.lit(w) * F.get(c, F.lit(k)) for k, w in enumerate(weights)), F.lit(0.0))  # noqa: E731, B023
        state = state.withColumn("begun", mixed("made"))
        # what is left over of a mixture is the mixture of what was left over
        sums = reduce(DataFrame.unionByName, [g.withColumn("r", F.col("r") * w) for g, w in zip(given, weights, strict=True)])
    raise RuntimeError(f"cells have not settled in {max_rounds} rounds")


def _tile_equations(key: tuple, frame: pd.DataFrame, size: int) -> dict[str, np.ndarray]:
    """The equations of a tile's own cells, and its links to other tiles, from its cells and those beside it."""
    i, j = frame["i"].to_numpy(np.int64), frame["j"].to_numpy(np.int64)
    ii, jj = i - key[0] * size, j - key[1] * size
    inside = (ii >= 0) & (ii < size) & (jj >= 0) & (jj < size)
    number = np.full((size + 2, size + 2), -1)
    number[jj + 1, ii + 1] = np.where(inside, np.cumsum(inside) - 1, -1)
    code = j * 2**32 + i
    n, d = int(inside.sum()), frame["d"].to_numpy()[inside]
    m = np.zeros((n, n))
    own, other, w = [], [], []
    for name, di, dj in (("e", 1, 0), ("s", 0, 1)):
        weight = frame[name].to_numpy()
        near = (ii + di <= size) & (jj + dj <= size)
        a, b = number[jj + 1, ii + 1], np.where(near, number[np.minimum(jj + dj, size) + 1, np.minimum(ii + di, size) + 1], -1)
        both = (weight != 0) & (a >= 0) & (b >= 0)
        m[a[both], b[both]] -= weight[both]
        m[b[both], a[both]] -= weight[both]
        to = code + dj * 2**32 + di
        for one, start, end in (((a >= 0) & (b < 0), code, to), ((a < 0) & (b >= 0), to, code)):
            at = one & (weight != 0)
            own.append(start[at])
            other.append(end[at])
            w.append(weight[at])
    links = {"own": np.concatenate(own), "other": np.concatenate(other), "w": np.concatenate(w)}
    known = d + m.sum(axis=1) - _leaving(code[inside], links)
    np.fill_diagonal(m, d)
    return {"cells": code[inside], "m": m, "b": frame["b"].to_numpy()[inside], "known": known, **links}


def _leaving(cells: np.ndarray, links: dict[str, np.ndarray]) -> np.ndarray:
    """The weight of the links from each of the ``cells`` to other squares."""
    return np.bincount(_places(cells, links["own"]), links["w"], len(cells))


def _square_equations(frame: pd.DataFrame) -> dict[str, np.ndarray]:
    """The equations of the cells of some squares, put together, and the links that leave them all."""
    cells, b, known, own, other, w = (np.concatenate([np.asarray(x) for x in frame[c]]) for c in ("cells", "b", "known", "own", "other", "w"))
    m = np.zeros((len(cells), len(cells)))
    first = 0
    for n, block in zip(frame["n"], frame["m"], strict=True):
        m[first : first + n, first : first + n] = np.frombuffer(block).reshape(n, n)
        first += n
    inner = np.isin(other, cells)
    # a link between two of the squares came from both
    m[_places(cells, own[inner]), _places(cells, other[inner])] -= w[inner]
    return {"cells": cells, "m": m, "b": b, "known": known, "own": own[~inner], "other": other[~inner], "w": w[~inner]}


def _places(cells: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where the ``wanted`` stand in ``cells``, which has them all."""
    order = np.argsort(cells)
    return order[np.searchsorted(cells, wanted, sorter=order)]


def _parted(equations: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Which cells are linked to other squares, and the matrix of the others and its part for the linked ones."""
    kept = np.isin(equations["cells"], equations["own"])
    inner = equations["m"][~kept]
    return kept, inner[:, ~kept], inner[:, kept]


def _reduced(key: tuple, equations: dict[str, np.ndarray]) -> pd.DataFrame:
    """The equations of the cells that are linked to other squares, a ``SQUARE`` or nothing."""
    kept, own, across = _parted(equations)
    columns = ["si", "sj", "n", "cells", "m", "b", "known", "own", "other", "w"]
    if not kept.any():
        return pd.DataFrame(columns=columns)
    sides = np.column_stack([equations["b"], equations["known"]])
    x = np.linalg.solve(own, np.column_stack([across, sides[~kept]]))
    m = equations["m"][np.ix_(kept, kept)] - across.T @ x[:, :-2]
    b, known = (sides[kept] - across.T @ x[:, -2:]).T
    np.fill_diagonal(m, 0.0)
    cells = equations["cells"][kept]
    np.fill_diagonal(m, known - m.sum(axis=1) + _leaving(cells, equations))
    values = (*key, len(b), cells, m.tobytes(), b, known, *[equations[c] for c in ("own", "other", "w")])
    return pd.DataFrame({c: [v] for c, v in zip(columns, values, strict=True)})


def _handed_down(equations: dict[str, np.ndarray], known: pd.DataFrame) -> np.ndarray:
    """The values of all cells, by those of the cells that are linked to other squares."""
    kept, own, across = _parted(equations)
    x = np.zeros(len(kept))
    if kept.any():
        x[kept] = known["x"].to_numpy()[_places(known["cell"].to_numpy(), equations["cells"][kept])]
    x[~kept] = np.linalg.solve(own, equations["b"][~kept] - across @ x[kept])
    return x


def solved(system: DataFrame, size: int = 32) -> DataFrame | None:
    """``i, j, x``: the solution of a ``SYSTEM``, by elimination in tiles and in squares of tiles.

    None where a task would have to hold more than ``AT_HAND`` unknowns in every larger square.
    """
    def of_tile(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return _reduced(key, _tile_equations(key, frame, size))

    def of_square(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return _reduced(key, _square_equations(frame))

    def down(key: tuple, frame: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame(columns=["cell", "x"])
        equations = _square_equations(frame)
        return pd.DataFrame({"cell": equations["cells"], "x": _handed_down(equations, known)})

    def down_to_tile(key: tuple, frame: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame(columns=["i", "j", "x"])
        equations = _tile_equations(key, frame, size)
        j, i = np.divmod(equations["cells"] + 2**31, 2**32)
        return pd.DataFrame({"i": i - 2**31, "j": j, "x": _handed_down(equations, known)})

    *corner, cells = system.agg(*[F.floor(F.min(c) / size).cast("int") for c in ("i", "j")], F.count("*")).first()
    if not cells:
        return system.select("i", "j", F.col("b").alias("x"))
    # the work grows with the cells of a tile and not with their bytes, by which the planner would deal them
    tiles = dealt_to_tiles(system, size, 1).repartition(cells // TASK_CELLS + 1, "ti", "tj").groupBy("ti", "tj")
    square = lambda c, o, by: F.floor((F.col(c) - o) / by).cast("int")
    squares = staged(tiles.applyInPandas(of_tile, SQUARE).select(square("si", corner[0], 1).alias("si"), square("sj", corner[1], 1).alias("sj"), *[c.split()[0] for c in SQUARE.split(", ")[2:]]), "squares")
    stages: list[tuple[DataFrame, int]] = []  # squares, and how many tiles wide the next ones are
    wide = 1
    while True:
        sizes = [squares.groupBy(square("si", 0, f), square("sj", 0, f)).agg(F.sum("n").alias("n")).agg(F.max("n").alias("n"), F.lit(f).alias("f")) for f in FACTORS]
        most = {r.f: r.n for r in reduce(DataFrame.unionByName, sizes).collect()}
        if most[FACTORS[0]] is None:
            break
        factor = next((f for f in FACTORS if most[f] <= AT_HAND), None)
        if factor is None:
            return None
        wide *= factor
        dealt = squares.withColumns({"ti": square("si", 0, factor), "tj": square("sj", 0, factor)})
        stages.append((dealt, wide))
        squares = staged(dealt.groupBy("ti", "tj").applyInPandas(of_square, SQUARE), "squares")
    spark = system.sparkSession
    known = spark.createDataFrame([], "cell long, x double")
    axes = {"i": F.expr("cell + 2147483648L - floor((cell + 2147483648L) / 4294967296L) * 4294967296L - 2147483648L")}
    axes["j"] = F.expr("floor((cell + 2147483648L) / 4294967296L)")

    def by_square(wide: int, origin: tuple[int, int]) -> DataFrame:
        at = known.withColumns(axes)
        return at.select("cell", "x", *[square(c, o * size, wide * size).alias(t) for c, o, t in (("i", origin[0], "ti"), ("j", origin[1], "tj"))])

    for dealt, wide in reversed(stages):
        found = dealt.groupBy("ti", "tj").cogroup(by_square(wide, corner).groupBy("ti", "tj")).applyInPandas(down, "cell long, x double")
        known = staged(found, "values")
    return tiles.cogroup(by_square(1, (0, 0)).groupBy("ti", "tj")).applyInPandas(down_to_tile, "i int, j int, x double")


def filled(cells: DataFrame, band: str, tolerance: float = 0.1, size: int = 64) -> DataFrame:
    """``i, j, band``: unknown cells by relaxation until each is within ``tolerance`` of the mean around it.

    Known cells stay. The mean is over those of the four neighbours that are there, so a border
    has no slope across it. A hole without a known neighbour stays unknown.
    """
    system = staged(hole_system(cells, band), "system")
    found = solved(system)
    if found is None:
        found = relaxed(system, tolerance, size)
    v = F.col(band)
    return cells.select("i", "j", F.when(~F.isnan(v), v).alias(band)).join(found, ["i", "j"], "left").select("i", "j", F.coalesce(band, "x").alias(band))
