"""Flow on grids: sinks, flats, flow edges, runouts, and parts and outlines of extents.

Iterations keep narrow rows, stage each round in the shared folder and stop when nothing
changes. Cells are ``cell, i, j`` with a height that is null where there is no terrain.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firngrid.operators import focal, spill
from firngrid.operators.parts import grid_parts, whole_groups
from firngrid.sources.shared import grown, staged, tasks, unsent

EIGHT = [(a, b, 1.0) for b in (-1, 0, 1) for a in (-1, 0, 1) if (a, b) != (0, 0)]
FOUR = [(1, 0), (-1, 0), (0, 1), (0, -1)]
#: Cell numbers of a block in which the cells of a flat are chained.
CHAIN_BLOCK = 65_536


def neighbours(cells: DataFrame, bands: list[str]) -> DataFrame:
    """``cell, other, slot`` and the bands of each of the eight cells around that is there.

    Both sides are dealt by place in tasks of a bounded number of rows: the planner would put
    shuffled parts together by their compressed bytes, and the rows of neighbours compress well.
    """
    each = F.array(*[F.struct(F.lit(a).alias("di"), F.lit(b).alias("dj")) for a, b, _ in EIGHT])
    sent = cells.select(F.col("cell").alias("other"), "i", "j", *bands, F.inline(each)).select(
        "other", *bands, (F.col("i") - F.col("di")).alias("i"), (F.col("j") - F.col("dj")).alias("j"), (F.col("dj") * 3 + F.col("di")).alias("slot")
    )
    n = tasks(cells, len(EIGHT))
    there = cells.select("cell", "i", "j").repartition(n, "i", "j")
    return sent.repartition(n, "i", "j").join(unsent(there), ["i", "j"]).select("cell", "other", "slot", *bands)


def lowest_neighbour(cells: DataFrame, height: str) -> DataFrame:
    """``cell, lowest``: the lowest of the eight neighbours; the first in scan order of equals."""
    near = neighbours(cells.where(F.col(height).isNotNull()), [height])
    return near.groupBy("cell").agg(F.min_by("other", F.struct(height, "slot")).alias("lowest"))


def edge_cells(cells: DataFrame, height: str) -> DataFrame:
    """Cells of terrain with a neighbour that is none or is not there."""
    known = cells.where(F.col(height).isNotNull())
    near = focal.focal(known, [], EIGHT, [F.count("*").alias("n")])
    return known.join(unsent(near), ["i", "j"], "left").where("n is null or n < 8").drop("n")


def spill_levels(cells: DataFrame, height: str, size: int = 128, factor: int = 8) -> DataFrame:
    """``cell, i, j, spill``: the lowest level at which water from a cell reaches the border.

    Tiles have ``size`` cells a side, and squares of them are reduced ``factor`` by ``factor``.
    """
    known = cells.where(F.col(height).isNotNull()).select("cell", "i", "j", F.col(height).cast("double").alias("z"))
    border = edge_cells(known, "z").select("cell", F.lit(True).alias("border"))
    return spill.levels(known.join(border, "cell", "left").withColumn("border", F.coalesce("border", F.lit(False))), size, factor)


def flat_classes(cells: DataFrame, level: str) -> DataFrame:
    """``cell, flat``: connected cells of one level; the least cell names them. Cells without a level are alone."""
    found = grid_parts(cells.select(level, "cell", "i", "j"), [level], corners=True)
    alone = cells.where(F.col(level).isNull()).select("cell", F.col("cell").cast("long").alias("flat"))
    return found.select("cell", F.col("part").alias("flat")).unionByName(alone)


def flow_edges(cells: DataFrame, level: str, border: DataFrame) -> DataFrame:
    """``cell, next_cell``: where water goes; -1 where it leaves.

    The cells of a flat are chained by number. The last one leaves to the lowest neighbour of
    the flat, and there to the head of that one's flat. A flat at the border leaves the map.
    """
    flats = unsent(staged(flat_classes(cells, level), "flats"))
    near = neighbours(cells.select("cell", "i", "j", level), [level])
    # rows of neighbours compress well, so their tasks are counted and not left to the planner's bytes
    n = tasks(cells, len(EIGHT))
    named = near.repartition(n, "cell").join(unsent(flats.repartition(n, "cell")), "cell").repartition(n, "other")
    others = flats.select(F.col("cell").alias("other"), F.col("flat").alias("other_flat"))
    both = named.join(unsent(others.repartition(n, "other")), "other")
    exits = both.where("flat <> other_flat").groupBy("flat").agg(F.min_by("other_flat", F.struct(level, "other")).alias("exit"))
    at_border = flats.join(border.select("cell"), "cell", "left_semi").select("flat").distinct().withColumn("leaves", F.lit(True))
    # A flat may be as wide as the map: its cells are chained by blocks of numbers, and the blocks by their heads.
    blocks = flats.withColumn("block", F.floor(F.col("cell") / CHAIN_BLOCK))
    heads = blocks.groupBy("flat", "block").agg(F.min("cell").alias("head"))
    heads = heads.select("flat", "block", F.lead("head").over(Window.partitionBy("flat").orderBy("block")).alias("next_head"))
    inside = F.lead("cell").over(Window.partitionBy("flat", "block").orderBy("cell"))
    chained = blocks.withColumn("inside", inside).join(heads, ["flat", "block"])
    chained = chained.select("flat", "cell", F.coalesce("inside", "next_head").alias("following"))
    return (
        chained.join(exits, "flat", "left").join(at_border, "flat", "left")
        .select("cell", F.coalesce("following", F.when(F.col("leaves"), F.lit(-1)).otherwise(F.coalesce("exit", F.lit(-1)))).cast("long").alias("next_cell"))
    )


def lowest_edges(cells: DataFrame, height: str) -> DataFrame:
    """``cell, other, slot``: all neighbours at the lowest level around that is not above the cell.

    Heights below 0 count as 0, unknown ones too.
    """
    z = cells.select("cell", "i", "j", F.greatest(F.coalesce(height, F.lit(0.0)), F.lit(0.0)).alias("z"))
    near = neighbours(z, ["z"]).join(unsent(z.select("cell", F.col("z").alias("own"))), "cell").where("z <= own")
    least = near.groupBy("cell").agg(F.min("z").alias("least"))
    return near.join(unsent(least), "cell").where("z = least").select("cell", "other", "slot")


#: Areas that are followed through a tile in one task.
AREAS = 2_000


def _row_of(places: set[int], n: int) -> bytes:
    """Places below ``n`` as numbers of four bytes, or as ``n`` bits where these are shorter."""
    if 32 * len(places) < n - 7:
        return np.array(sorted(places), np.uint32).tobytes()
    bits = np.zeros(n, np.uint8)
    bits[list(places)] = 1
    return np.packbits(bits).tobytes()


def _places(row: bytes, n: int) -> np.ndarray:
    """The places that ``_row_of`` has written, in order."""
    if len(row) < (n + 7) // 8:
        return np.frombuffer(row, np.uint32).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(row, np.uint8), count=n))


def runout(
    release: DataFrame, cells: DataFrame, height: str, size: float, min_alpha: float = 18.0, max_runout: float = 10_000.0, tile: int = 64, max_rounds: int = 10_000
) -> DataFrame:
    """``pra_id, cell`` that an avalanche from ``release (pra_id, cell)`` may reach.

    Areas are followed along the lowest edges. A cell is passed on from while it is within
    ``max_runout`` of the area's highest cell and the line to that one is at least as steep as
    ``min_alpha``; release cells are always passed on from. An area that touches a cell without
    height, or the edge of the map, has no rows.

    A round follows every area through a whole tile, so the rounds are as many as tiles on the
    way. What an area has reached in a tile is one row: its cells, or a bit for each where they are many. Only areas that
    still go on are read again, and a tile with many of them is shared by several tasks.
    """
    ways = lowest_edges(cells, height).groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1, slot + 4)")).alias("ways"))
    around = focal.focal(cells, [], EIGHT, [F.count("*").alias("n")])
    void = F.col(height).isNull() | (F.coalesce("n", F.lit(0)) < 8)
    at = [F.floor(F.col(c) / tile).cast("int").alias(t) for c, t in (("i", "ti"), ("j", "tj"))]
    place = (F.pmod("j", F.lit(tile)) * tile + F.pmod("i", F.lit(tile))).cast("int").alias("place")
    terrain = cells.join(unsent(around), ["i", "j"], "left").join(unsent(ways), "cell", "left").select(
        "cell", "i", "j", F.col(height).cast("double").alias("h"), void.alias("void"), F.coalesce("ways", F.lit(0)).cast("int").alias("ways"), *at, place
    )
    terrain = unsent(staged(terrain, "terrain"))
    placed = release.select("pra_id", "cell").distinct().join(terrain, "cell")
    top = placed.groupBy("pra_id").agg(F.max_by(F.struct("i", "j", "h"), F.struct("h", -F.col("cell"))).alias("t"))
    top = unsent(staged(top.select("pra_id", F.col("t.i").alias("top_i"), F.col("t.j").alias("top_j"), F.col("t.h").alias("top_h")), "top"))
    steep = math.tan(math.radians(min_alpha))
    ahead = [(1 << (b * 3 + a + 4), a, b) for a, b, _ in EIGHT]

    def followed(key: tuple, ground: pd.DataFrame, areas: pd.DataFrame) -> pd.DataFrame:
        ti, tj = key[0], key[1]
        n = tile * tile
        ways, h, blank = np.zeros(n, int), np.zeros(n), np.zeros(n, bool)
        where = ground["place"].to_numpy()
        ways[where], h[where], blank[where] = ground["ways"], np.nan_to_num(ground["h"].to_numpy(float)), ground["void"]
        ways, h, blank = ways.tolist(), h.tolist(), blank.tolist()
        out = []
        for r in areas.itertuples(index=False):
            seen = set(_places(r.bits, n).tolist()) if r.bits is not None else set()
            fresh = [p for p in r.places.tolist() if p not in seen]
            if not fresh:
                continue
            free = set(fresh) if r.released else ()
            seen.update(fresh)
            todo, exits = list(fresh), set()
            while todo:
                p = todo.pop()
                i, j = p % tile, p // tile
                if p not in free:
                    away = size * math.hypot(ti * tile + i - r.top_i, tj * tile + j - r.top_j)
                    if not (away <= max_runout and r.top_h - h[p] >= steep * away):
                        continue
                for bit, a, b in ahead:
                    if ways[p] & bit:
                        x, y = i + a, j + b
                        if 0 <= x < tile and 0 <= y < tile:
                            q = y * tile + x
                            if q not in seen:
                                seen.add(q)
                                todo.append(q)
                        else:
                            exits.add((ti * tile + x, tj * tile + y))
            out.append((r.pra_id, ti, tj, _row_of(seen, n), any(blank[p] for p in seen), [{"i": i, "j": j} for i, j in sorted(exits)]))
        return pd.DataFrame(out, columns=["pra_id", "ti", "tj", "bits", "blank", "exits"], dtype=object)

    schema = "pra_id long, ti int, tj int, bits binary, blank boolean, exits array<struct<i:int,j:int>>"
    frontier, released = placed.select("pra_id", "ti", "tj", "place"), True
    active, done = None, None
    for _ in range(max_rounds):
        entries = frontier.groupBy("pra_id", "ti", "tj").agg(F.collect_set("place").alias("places"))
        entries = entries.join(top, "pra_id")  # of an area there are as many rows as tiles
        entries = entries.join(active.select("pra_id", "ti", "tj", "bits"), ["pra_id", "ti", "tj"], "left") if active is not None else entries.withColumn("bits", F.lit(None).cast("binary"))
        entries = staged(entries.withColumn("released", F.lit(released)), "entries")
        shares = entries.groupBy("ti", "tj").agg(F.ceil(F.count("*") / AREAS).cast("int").alias("n"))
        shares = F.broadcast(shares)  # a row for each tile
        dealt = entries.join(shares, ["ti", "tj"]).withColumn("share", F.pmod(F.xxhash64("pra_id"), "n").cast("int")).drop("n")
        ground = terrain.select("ti", "tj", "place", "h", "void", "ways").join(shares, ["ti", "tj"]).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n")
        by = ["ti", "tj", "share"]
        went = unsent(staged(ground.groupBy(*by).cogroup(dealt.groupBy(*by)).applyInPandas(followed, schema), "went"))
        # rows that this round has changed take the place of the old ones
        now = went.unionByName(active.join(went, ["pra_id", "ti", "tj"], "left_anti").withColumn("exits", F.lit(None).cast("array<struct<i:int,j:int>>"))) if active is not None else went
        going = staged(went.where(F.size("exits") > 0).select("pra_id", F.inline("exits")).distinct(), "exits")
        on = unsent(going.select("pra_id").distinct())
        kept = now.select("pra_id", "ti", "tj", "bits", "blank")
        done = grown(kept.join(on, "pra_id", "left_anti"), "done", done)
        if going.isEmpty():
            break
        active = unsent(staged(kept.join(on, "pra_id", "left_semi"), "active"))
        frontier, released = going.select("pra_id", *at, place), False
    else:
        raise RuntimeError(f"runouts have not ended in {max_rounds} rounds")

    def spots(frames):
        for frame in frames:
            for r in frame.itertuples(index=False):
                p = _places(r.bits, tile * tile)
                yield pd.DataFrame({"pra_id": r.pra_id, "i": r.ti * tile + p % tile, "j": r.tj * tile + p // tile})

    whole = done().join(unsent(done().where("blank").select("pra_id").distinct()), "pra_id", "left_anti")
    reached = whole.select("pra_id", "ti", "tj", "bits").mapInPandas(spots, "pra_id long, i int, j int")
    return reached.join(terrain.select("cell", "i", "j"), ["i", "j"]).select("pra_id", "cell")


def reachable(start: DataFrame, edges: DataFrame) -> DataFrame:
    """``root, cell`` that ``start (root, cell)`` leads to along ``edges (cell, next_cell)``.

    Paths are lengthened by jumps of 1, 2, 4 ... cells, each made by joining the last with itself,
    until no path gains a cell, so the rounds grow with the logarithm of the longest path. Paths
    may run in circles: a cell is written once for each root, however often it is passed.
    """
    jump = unsent(staged(edges.where("next_cell >= 0").select("cell", F.col("next_cell").alias("far")), "jumps"))
    paths = grown(start.select("root", "cell").distinct(), "paths")
    while True:
        met = unsent(paths()).join(jump, "cell").select("root", F.col("far").alias("cell")).distinct()
        more = staged(met.join(unsent(paths()), ["root", "cell"], "left_anti"), "more")
        if more.isEmpty():
            return paths()
        paths = grown(more, "paths", paths)
        jump = unsent(staged(jump.join(jump.select(F.col("cell").alias("far"), F.col("far").alias("farther")), "far").select("cell", F.col("farther").alias("far")), "jumps"))


def _beside(cells: DataFrame, key: str) -> DataFrame:
    each = F.array(*[F.struct(F.lit(a).alias("di"), F.lit(b).alias("dj")) for a, b in FOUR])
    return cells.select(key, F.col("cell").alias("other"), "i", "j", F.inline(each)).select(
        key, "other", (F.col("i") + F.col("di")).alias("i"), (F.col("j") + F.col("dj")).alias("j")
    )


def extent_parts(cells: DataFrame, key: str) -> DataFrame:
    """``key, cell, part``: connected parts (by sides) of each extent; the least cell names a part."""
    return grid_parts(cells.select(key, "cell", "i", "j"), [key])


def outline_edges(cells: DataFrame, key: str) -> DataFrame:
    """``key, x0, y0, x1, y1``: sides of cells that only one cell of the extent has, the extent on the left."""
    i, j = F.col("i"), F.col("j")
    sides = F.array(
        *[
            F.struct(a.alias("x0"), b.alias("y0"), c.alias("x1"), d.alias("y1"))
            for a, b, c, d in ((i, j, i + 1, j), (i + 1, j, i + 1, j + 1), (i + 1, j + 1, i, j + 1), (i, j + 1, i, j))
        ]
    )
    each = cells.select(key, F.inline(sides))
    ends = [F.least("x0", "x1"), F.least("y0", "y1"), F.greatest("x0", "x1"), F.greatest("y0", "y1")]
    return (
        each.groupBy(key, *[e.alias(n) for e, n in zip(ends, ("_a", "_b", "_c", "_d"), strict=True)])
        .agg(F.count("*").alias("n"), F.first(F.struct("x0", "y0", "x1", "y1")).alias("s"))
        .where("n = 1")
        .select(key, "s.*")
    )


def _following(code: np.ndarray, end: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The side after each, -1 if none: sides begin at ``code // 4`` in direction ``code % 4`` and end at ``end``.

    Where the corners of two cells meet, a ring turns to the left and stays with its cell.
    """
    order = np.argsort(code, kind="stable")
    found = np.full(len(code), -1)
    for turn in (3, 0, 1):
        wanted = end * 4 + (d + turn) % 4
        at = order[np.minimum(np.searchsorted(code, wanted, sorter=order), len(code) - 1)]
        met = (end >= 0) & (code[at] == wanted)
        found[met] = at[met]
    return found


def _traced(following: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All nodes along their chains, where each chain begins, and whether it is closed."""
    heads = np.ones(len(following), bool)
    heads[following[following >= 0]] = False
    follow, seen = following.tolist(), bytearray(len(following))
    order, starts, closed = [], [], []
    for first in [*np.flatnonzero(heads).tolist(), *range(len(follow))]:
        if not seen[first]:
            starts.append(len(order))
            at = first
            while at >= 0 and not seen[at]:
                seen[at] = 1
                order.append(at)
                at = follow[at]
            closed.append(at >= 0)
    return np.array(order, int), np.array(starts, int), np.array(closed, bool)


def outline_rings(cells: DataFrame, key: str, size: int = 64) -> DataFrame:
    """``key, ring, points``: the closed rings of the outline, as flat lists x, y, x, y ...

    The least side of a ring names it. Sides are traced inside of tiles; only chains that leave
    a tile are put together by extent, so a task has those of one extent and not all its sides.
    """
    edges = outline_edges(cells, key)
    tile = [F.floor(F.col(c) / size).cast("long").alias(t) for c, t in (("x0", "_tx"), ("y0", "_ty"))]
    group = [key, "_tx", "_ty"]
    dealt = edges.select(F.col(key).cast("long").alias(key), "x0", "y0", "x1", "y1", *tile).repartition(*group).sortWithinPartitions(*group)

    def chains(frames):
        for frame, number in whole_groups(frames, group):
            x, y, x1, y1 = (frame[c].to_numpy(np.int64) for c in ("x0", "y0", "x1", "y1"))
            d = np.select([x1 > x, y1 > y, x1 < x], [0, 1, 2], 3)
            place = lambda a, b: (number * size + b % size) * size + a % size
            inside = (x1 // size == x // size) & (y1 // size == y // size)
            order, starts, closed = _traced(_following(place(x, y) * 4 + d, np.where(inside, place(x1, y1), -1), d))
            name = (((y * 4 + d) << 32) + (x & 0xFFFFFFFF))[order]
            last = order[np.append(starts[1:], len(order)) - 1]
            points = np.split(np.stack([x, y], axis=1)[order].ravel(), 2 * starts[1:])
            yield pd.DataFrame({
                key: frame[key].to_numpy()[order[starts]], "ring": np.minimum.reduceat(name, starts), "closed": closed,
                "x": x[order[starts]], "y": y[order[starts]], "d": d[order[starts]], "ex": x1[last], "ey": y1[last], "ed": d[last], "points": points,
            })

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        x, y, ex, ey = (frame[c].to_numpy() for c in ("x", "y", "ex", "ey"))
        x_least, y_least = min(x.min(), ex.min()), min(y.min(), ey.min())
        wide = max(x.max(), ex.max()) - x_least + 1
        at = lambda a, b: (b - y_least) * wide + a - x_least
        order, starts, _ = _traced(_following(at(x, y) * 4 + frame["d"].to_numpy(), at(ex, ey), frame["ed"].to_numpy()))
        points = frame["points"].to_numpy()
        bounds = [*starts.tolist(), len(order)]
        return pd.DataFrame({
            key: frame[key].to_numpy()[order[starts]], "ring": np.minimum.reduceat(frame["ring"].to_numpy()[order], starts),
            "points": [np.concatenate(points[order[a:b]]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)],
        })

    found = dealt.mapInPandas(chains, f"{key} long, ring long, closed boolean, x long, y long, d int, ex long, ey long, ed int, points array<int>")
    found = staged(found, "chains")
    ring = f"{key} long, ring long, points array<int>"
    return found.where("closed").select(key, "ring", "points").unionByName(found.where("not closed").groupBy(key).applyInPandas(joined, ring))


def overrun_edge(cells: DataFrame, key: str, masked_out: DataFrame) -> DataFrame:
    """Cells of an extent with fewer than four own neighbours, none of the four being masked out.

    Neighbours are counted along the rows and the columns of an extent, so cells are not sent to
    those around them.
    """
    own = F.lit(0)
    for along, across in (("i", "j"), ("j", "i")):
        line = Window.partitionBy(key, across).orderBy(along)
        own = own + F.count("*").over(line.rangeBetween(-1, 1)) - F.count("*").over(line.rangeBetween(0, 0))
    out = masked_out.select(F.lit(0).alias("k"), F.lit(0).alias("cell"), "i", "j")
    beside_out = _beside(out, "k").select("i", "j").distinct()
    return cells.withColumn("_own", own).where("_own < 4").drop("_own").join(beside_out, ["i", "j"], "left_anti")


def overruns(edge: DataFrame, runs: DataFrame, key: str, value: Column) -> DataFrame:
    """``key, overran``: reported so, with flow at an overrun edge, and not for lack of flow.

    ``runs`` has ``reported``, ``low_flux`` and ``has_mask``; without a mask the report decides.
    """
    flowing = edge.groupBy(key).agg(F.bool_or(value > 0).alias("flowing"))
    return runs.join(flowing, key, "left").select(
        key,
        (F.col("reported") & (~F.col("has_mask") | (F.coalesce("flowing", F.lit(False)) & ~F.col("low_flux")))).alias("overran"),
    )
