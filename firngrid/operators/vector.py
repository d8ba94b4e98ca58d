"""Polygons and cells: burning, nearest cells, hulls, rectangles and domains."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firngrid.functions import grid as G
from firngrid.operators import flow
from firngrid.sources.shared import staged, unsent


def inside_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point is in a ring, by the even-odd rule."""
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring) - 1), F.slice(ring, 1, 1))
    crossed = F.zip_with(
        ring,
        following,
        lambda p, q: F.when(
            ((p["y"] > y) != (q["y"] > y)) & (x < (q["x"] - p["x"]) * (y - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) + p["x"]), 1
        ).otherwise(0),
    )
    return F.aggregate(crossed, F.lit(0), lambda a, b: a + b) % 2 == 1


def sides_of(ring: Column) -> Column:
    """The sides ``p, q`` of a closed ring of points."""
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring) - 1), F.slice(ring, 1, 1))
    return F.zip_with(ring, following, lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def burn(polygons: DataFrame, key: str, keep: list[str] | None = None) -> DataFrame:
    """``key, i, j`` of the cells whose centre is in ``ring``, or in ``rings`` by the even-odd rule.

    A polygon is cut into rows of cells. The sides that cross the middle of a row, in order, are
    the ends of the spans inside, so only cells inside are ever made.
    """
    sides = F.flatten(F.transform("rings", sides_of)) if "rings" in polygons.columns else sides_of(F.col("ring"))
    rows = polygons.select(key, *(keep or []), sides.alias("_sides"))
    ys = F.transform("_sides", lambda s: s["p"]["y"])
    rows = rows.select("*", F.explode(F.sequence(F.floor(F.array_min(ys)).cast("int"), F.ceil(F.array_max(ys)).cast("int"))).alias("j"))
    y = F.col("j") + 0.5
    crossed = F.filter("_sides", lambda s: (s["p"]["y"] > y) != (s["q"]["y"] > y))
    at = F.transform(crossed, lambda s: (s["q"]["x"] - s["p"]["x"]) * (y - s["p"]["y"]) / (s["q"]["y"] - s["p"]["y"]) + s["p"]["x"])
    spans = rows.select(key, *(keep or []), "j", F.array_sort(at).alias("_at")).where(F.size("_at") > 0)
    ends = F.transform("_at", lambda x: F.ceil(x - 0.5).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.size("_at") - 2, F.lit(2)), lambda k: F.struct(F.get(ends, k).alias("a"), (F.get(ends, k + 1) - 1).alias("b")))
    each = spans.select(key, *(keep or []), "j", F.inline(pairs)).where("a <= b")
    return each.select(key, *(keep or []), "j", F.explode(F.sequence("a", "b")).alias("i"))


def _reach(points: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    """``bi, bj, level``: how coarse bins must be for the 3 x 3 around a bin of ``points`` to hold ``k`` targets.

    Bins of a level are twice as wide as those of the level below. Only counts by bin are looked
    at; the last level is the one whose 3 x 3 hold all there is.
    """
    coarse = lambda c, level: F.floor(F.col(c) / 2**level).alias(c)
    counts = staged(targets.groupBy("bi", "bj").agg(F.count("*").alias("n")), "counts")
    todo, done = staged(points.select("bi", "bj").distinct(), "bins"), None
    ends = counts.select("bi", "bj").union(todo).agg(F.min("bi"), F.max("bi"), F.min("bj"), F.max("bj")).first()
    around = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    level = 0
    while True:
        last = ends[0] is None or all(v >> level >= -1 and v >> level <= 1 for v in (ends[1] - ends[0], ends[3] - ends[2]))
        at = counts.groupBy(coarse("bi", level), coarse("bj", level)).agg(F.sum("n").alias("n"))
        near = at.select("n", "bi", "bj", F.inline(around)).groupBy((F.col("bi") + F.col("a")).alias("ci"), (F.col("bj") + F.col("b")).alias("cj")).agg(F.sum("n").alias("n"))
        keyed = todo.select("bi", "bj", coarse("bi", level).alias("ci"), coarse("bj", level).alias("cj"))
        found = staged(keyed.join(near, ["ci", "cj"], "left").select("bi", "bj", (F.coalesce("n", F.lit(0)) >= k).alias("enough")), "reach")
        sure = (found if last else found.where("enough")).select("bi", "bj", F.lit(level).alias("level"))
        done = sure if done is None else done.unionByName(sure)
        if last:
            return done
        todo = found.where("not enough").select("bi", "bj")
        if todo.isEmpty():
            return done
        level += 1


#: Points for which a task looks for the nearest targets: few, since each meets hundreds of targets.
NEAREST_POINTS = 4_000


def nearest(points: DataFrame, targets: DataFrame, k: int, bin_size: int) -> DataFrame:
    """``cell, distance`` of the ``k`` targets nearest to each of ``points (cell, i, j)``.

    Counts by bin, over coarser and coarser bins, bound the distance of the k-th target from
    above. Targets are sent to the bins of points from which they are within this bound, and meet
    the points there, so a point has all it needs in one task and only its k least are kept. The tasks
    are as many as the points ask for: a small file of points is one task, with hundreds of pairs a point.
    """
    binned = lambda df: df.withColumns({"bi": F.floor(F.col("i") / bin_size), "bj": F.floor(F.col("j") / bin_size)})
    source, goal = binned(points.select("cell", "i", "j")), staged(binned(targets.select("i", "j")), "targets")
    reach = staged(_reach(source, goal, k), "reach")
    levels = [r.level for r in reach.select("level").distinct().collect()]  # as many as the map has doublings of a bin
    if not levels:
        return points.select("cell", F.lit(0.0).alias("distance")).limit(0)
    wide = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), "level")).alias(f"c{c[1]}")
    shelves = goal.select(F.col("i").alias("ti"), F.col("j").alias("tj"), "bi", "bj", F.explode(F.array(*map(F.lit, levels))).alias("level"))
    shelves = shelves.select("ti", "tj", "level", wide("bi").alias("a"), wide("bj").alias("b"))
    square = F.array(*[F.struct(F.lit(a).alias("da"), F.lit(b).alias("db")) for a in range(-3, 4) for b in range(-3, 4)])
    asking = reach.select("level", wide("bi"), wide("bj")).distinct().select("level", "ci", "cj", F.inline(square))
    asking = asking.select("level", "ci", "cj", (F.col("ci") + F.col("da")).alias("a"), (F.col("cj") + F.col("db")).alias("b"))
    on, tasks = ["level", "ci", "cj"], source.count() // NEAREST_POINTS + 1
    around = asking.join(unsent(shelves), ["level", "a", "b"]).select(*on, "ti", "tj").repartition(tasks, *on)
    asked = source.join(unsent(reach), ["bi", "bj"]).select("cell", "i", "j", "level", wide("bi"), wide("bj")).repartition(tasks, *on)
    di, dj = ((F.col(c) - F.col(f"t{c}")).cast("double") for c in ("i", "j"))
    bound = 8 * F.pow(bin_size * F.pow(F.lit(2.0), "level"), F.lit(2.0))  # of 3 x 3 bins none is farther
    met = asked.join(unsent(around), on).select(*on, "cell", (di * di + dj * dj).alias("square"), bound.alias("bound")).where("square <= bound")
    place = F.row_number().over(Window.partitionBy(*on, "cell").orderBy("square"))
    return met.withColumn("place", place).where(F.col("place") <= k).select("cell", F.sqrt("square").alias("distance"))


def _half(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The chain of points in order that only turns to the left."""
    out: list[tuple[float, float]] = []
    for p in points:
        while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
            out.pop()
        out.append(p)
    return out


#: Passes over the points of many chains, before those that still turn to the right are followed one by one.
CHAIN_PASSES = 24


def _chains(of: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which points are left of the chains ``of``, if each has its points in order and only turns to the left.

    A point that does not turn to the left between those beside it is no corner, whatever
    others are dropped, so a pass drops all such points of all chains.
    """
    at = np.arange(len(of))
    for _ in range(CHAIN_PASSES):
        p, q, r = at[:-2], at[1:-1], at[2:]
        turn = (x[q] - x[p]) * (y[r] - y[p]) - (y[q] - y[p]) * (x[r] - x[p])
        bad = (of[p] == of[r]) & (turn <= 0)
        if not bad.any():
            return at
        at = at[~np.concatenate([[False], bad, [False]])]
    going = set(of[q[bad]].tolist())
    bounds = np.flatnonzero(np.diff(of[at], prepend=-1, append=-1))
    kept = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        own = at[a:b]
        if int(of[own[0]]) in going:
            place = {(x[k], y[k]): k for k in own}
            own = np.array([place[p] for p in _half(list(place))])
        kept.append(own)
    return np.concatenate(kept)


def _hulls(of: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``of, x, y`` of the corners of the convex hulls of many sets of points, no three in line.

    ``of`` numbers the sets. Each hull is counter-clockwise from its least point.
    """
    order = np.lexsort((y, x, of))
    of, x, y = of[order], x[order], y[order]
    new = np.ones(len(of), bool)
    new[1:] = (np.diff(of) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0)
    of, x, y = of[new], x[new], y[new]
    low = _chains(of, x, y)
    high = len(of) - 1 - _chains(of[::-1], x[::-1], y[::-1])
    # the last point of a chain is the first of the other one
    low, high = (c[np.append(of[c[1:]] == of[c[:-1]], False)] for c in (low, high))
    both = np.concatenate([low, high])
    both = both[np.argsort(of[both], kind="stable")]
    return of[both], x[both], y[both]


def hulls(cells: DataFrame, key: str) -> DataFrame:
    """``key, ring``: convex hull of the corners of the cells of each key.

    Of each row of cells only the ends matter, so a key has as many points as rows.
    """
    ends = cells.groupBy(key, "j").agg(F.min("i").alias("a"), (F.max("i") + 1).alias("b"))
    rows = ends.groupBy(F.col(key).cast("long").alias(key)).agg(*[F.collect_list(F.col(c).cast("double")).alias(c) for c in ("j", "a", "b")])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            j, a, b = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("j", "a", "b"))
            of = np.repeat(np.arange(batch.num_rows), batch.column("j").value_lengths().to_numpy(zero_copy_only=False))
            at, x, y = _hulls(np.tile(of, 4), np.concatenate([a, a, b, b]), np.concatenate([j, j + 1, j, j + 1]))
            offsets = pa.array(np.searchsorted(at, np.arange(batch.num_rows + 1)), pa.int32())
            points = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.ListArray.from_arrays(offsets, points)], [key, "ring"])

    return rows.mapInArrow(found, f"{key} long, ring array<struct<x:double,y:double>>")


def least_rectangles(rings: DataFrame, key: str, margin: float = 0.0) -> DataFrame:
    """``key, area, ring``: the smallest rotated rectangle around each ring, grown by a margin.

    One of its sides lies on a side of the hull, so each side is tried. Of equal areas the one
    with the smaller angle wins.
    """
    following = F.concat(F.slice("ring", F.lit(2), F.size("ring") - 1), F.slice("ring", 1, 1))
    turns = F.zip_with("ring", following, lambda p, q: F.atan2(q["y"] - p["y"], q["x"] - p["x"]))
    each = rings.select(key, "ring", F.explode(F.array_distinct(F.transform(turns, lambda t: F.round(t - F.floor(t / (np.pi / 2)) * (np.pi / 2), 12)))).alias("t"))
    c, s = F.cos("t"), F.sin("t")
    u, v = F.transform("ring", lambda p: p["x"] * c + p["y"] * s), F.transform("ring", lambda p: p["y"] * c - p["x"] * s)
    tried = each.select(key, "t", F.array_min(u).alias("u0"), F.array_max(u).alias("u1"), F.array_min(v).alias("v0"), F.array_max(v).alias("v1"))
    area = (F.col("u1") - F.col("u0")) * (F.col("v1") - F.col("v0"))
    best = tried.withColumn("area", area).groupBy(key).agg(F.min_by(F.struct("t", "u0", "u1", "v0", "v1", "area"), F.struct(F.round("area", 9), "t")).alias("b")).select(key, "b.*")
    m = margin / 2
    corner = lambda a, b: (F.col(a) * c - F.col(b) * s, F.col(a) * s + F.col(b) * c)
    grown = best.withColumns({"u0": F.col("u0") - m, "u1": F.col("u1") + m, "v0": F.col("v0") - m, "v1": F.col("v1") + m})
    ring = G.points(corner("u0", "v0"), corner("u1", "v0"), corner("u1", "v1"), corner("u0", "v1"))
    return grown.select(key, "area", ring.alias("ring"))


def domains(release: DataFrame, cells: DataFrame, height: str, size: float, margin: float, **limits) -> DataFrame:
    """``pra_id, area, ring``: rectangle around the runout of each area; areas without one are dropped."""
    reached = flow.runout(release, cells, height, size, **limits)
    placed = reached.join(cells.select("cell", "i", "j"), "cell")
    return least_rectangles(hulls(placed, "pra_id"), "pra_id", margin)


def buffered_paths(start: DataFrame, edges: DataFrame, cells: DataFrame, window: float, buffer: float) -> DataFrame:
    """``root, area, ring``: rectangle around the flow path within ``window`` of its start, and a buffer."""
    path = flow.reachable(start, edges).join(cells.select("cell", "i", "j"), "cell")
    origin = start.join(cells.select("cell", F.col("i").alias("oi"), F.col("j").alias("oj")), "cell").drop("cell")
    near = path.join(origin, "root").where(F.greatest(F.abs(F.col("i") - F.col("oi")), F.abs(F.col("j") - F.col("oj"))) <= window)
    return least_rectangles(hulls(near, "root"), "root", 2 * buffer)


def extent_rows(cells: DataFrame, landcover: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """A row for each extent: its parts, cells by forest code, and what ``sizes`` says of the release."""
    parts = flow.extent_parts(cells, key)
    counted = parts.join(landcover.select("cell", "landcover"), "cell", "left").groupBy(key).agg(
        F.countDistinct("part").alias("n_parts"), F.count("*").alias("ext_n"), *[F.count_if(F.col("landcover") == k).alias(f"ext_n{k}") for k in (41, 42, 43)]
    )
    return counted.join(sizes, key, "left")


#: Numbers of an array that holds bands by sides.
BAND_CELLS = 2**20


def _crossings(sides: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Where ``sides (n, k, 4)`` cross the heights ``y (n)``, in order; infinite for sides that do not."""
    x0, y0, x1, y1 = np.moveaxis(sides, 2, 0)
    y = y[:, None]
    met = (y0 > y) != (y1 > y)
    return np.sort(np.where(met, x0 + (x1 - x0) * (y - y0) / np.where(met, y1 - y0, 1.0), np.inf), axis=1)


def _spanned(ends: np.ndarray) -> np.ndarray:
    """The length of the spans that each row of ``ends`` has from every other end to the next."""
    finite = np.where(np.isfinite(ends), ends, 0.0)
    n = finite.shape[1] // 2 * 2  # ends are as many as crossings of a ring, which are even
    return (finite[:, 1:n:2] - finite[:, 0:n:2]).sum(axis=1)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The length that two sets of spans share, in each row."""
    ends = np.concatenate([a, b], axis=1)
    order = np.argsort(ends, axis=1, kind="stable")
    ends = np.take_along_axis(ends, order, axis=1)
    of_a = order < a.shape[1]
    inside = (np.cumsum(of_a, axis=1) % 2 == 1) & (np.cumsum(~of_a, axis=1) % 2 == 1)
    known = np.where(np.isfinite(ends), ends, 0.0)
    return np.where(inside[:, :-1] & np.isfinite(ends[:, 1:]), np.diff(known, axis=1), 0.0).sum(axis=1)


def _areas(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The areas of pairs of polygons, given by their sides ``(n, k, 4)``, and of what a pair shares: three rows.

    Between neighbouring heights of corners and crossings, spans grow evenly, so their length
    half-way up times the height is exact. Polygons may be concave and have holes.
    """
    n = len(p)
    (ax, ay, bx, by), (cx, cy, dx, dy) = np.moveaxis(p, 2, 0)[:, :, :, None], np.moveaxis(q, 2, 0)[:, :, None, :]
    turn = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
    over = np.where(turn == 0, 1.0, turn)  # sides in parallel do not cross
    t = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / over
    u = ((cx - ax) * (by - ay) - (cy - ay) * (bx - ax)) / over
    crossing = (turn != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
    met = np.where(crossing, ay + t * (by - ay), ay).reshape(n, -1)
    y = np.sort(np.concatenate([p[:, :, 1], q[:, :, 1], met], axis=1), axis=1)
    high = np.diff(y, axis=1)
    of, band = np.nonzero(high > 0)
    high, middle = high[of, band], (y[of, band] + y[of, band + 1]) / 2
    out = np.zeros((3, n))
    step = max(1, BAND_CELLS // (p.shape[1] + q.shape[1]))
    for k in range(0, len(of), step):
        at = slice(k, k + step)
        a, b = _crossings(p[of[at]], middle[at]), _crossings(q[of[at]], middle[at])
        for row, lengths in zip(out, (_spanned(a), _spanned(b), _common(a, b)), strict=True):
            row += np.bincount(of[at], lengths * high[at], n)
    return out


def _areas_of_all(p: pd.Series, q: pd.Series) -> np.ndarray:
    """``_areas`` of rows of flat sides, pairs with as many sides together."""
    out = np.zeros((3, len(p)))
    sides = np.stack([p.str.len().to_numpy(int), q.str.len().to_numpy(int)], axis=1) // 4
    kinds, kind = np.unique(sides, axis=0, return_inverse=True)
    for k, (a, b) in enumerate(kinds.tolist()):
        if not (a or b):
            continue
        rows = np.flatnonzero(kind.reshape(-1) == k)
        step = max(1, BAND_CELLS // (a * b + a + b))
        for chosen in np.split(rows, range(step, len(rows), step)):
            flat = lambda of, n: np.concatenate(of.to_numpy()[chosen]).astype(float).reshape(len(chosen), n, 4)  # noqa: B023, E731
            out[:, chosen] = _areas(flat(p, a), flat(q, b))
    return out


def overlap_area(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """``key, area_a, area_b, area_both`` of two polygons of each key, by ``ring`` or ``rings`` and the even-odd rule."""
    sides = lambda df: F.flatten(F.transform("rings", sides_of)) if "rings" in df.columns else sides_of(F.col("ring"))
    flat = lambda df, name: df.select(key, F.flatten(F.transform(sides(df), lambda s: F.array(s["p"]["x"], s["p"]["y"], s["q"]["x"], s["q"]["y"]))).alias(name))
    both = flat(a, "p").join(flat(b, "q"), key)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({key: frame[key], **dict(zip(("area_a", "area_b", "area_both"), _areas_of_all(frame["p"], frame["q"]), strict=True))})

    return both.mapInPandas(run, f"{key} long, area_a double, area_b double, area_both double")
