"""The lowest level at which water leaves a map, by trees of tiles.

Which level connects two rim cells of a tile is held by a tree of at most as many edges as
there are rim cells: cells join in the order of their heights, and an edge is kept where two
groups meet that both have a rim cell. Trees of tiles and the steps between tiles make a graph;
squares of tiles are reduced in the same way to the nodes on their own rim, and so on until one
square is left. Then levels are handed down again, square by square, to the rim of the tiles,
and every tile is flooded from its rim. So cells are looked at twice, however the water runs,
and the largest group is the rim of the map's last squares.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firngrid.sources.shared import staged

#: ``a`` and ``b`` are cells, or ``b`` is null and water leaves the map at ``a``.
EDGES = "ai int, aj int, bi int, bj int, level double"
AROUND = [(a, b) for b in (-1, 0, 1) for a in (-1, 0, 1) if (a, b) != (0, 0)]


def _least_tree(edges: list[tuple[float, int, int]], kept: list[bool]) -> list[tuple[float, int, int]]:
    """Edges between kept nodes that connect them at the same levels as ``edges (level, a, b)`` do."""
    root = list(range(len(kept)))
    name = [k if keep else -1 for k, keep in enumerate(kept)]  # a kept node of each group

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for level, a, b in sorted(edges):
        x, y = find(a), find(b)
        if x != y:
            if name[x] >= 0 and name[y] >= 0:
                out.append((level, name[x], name[y]))
            root[y] = x
            name[x] = name[x] if name[x] >= 0 else name[y]
    return out


def _tree_of_tile(key: tuple, frame: pd.DataFrame, size: int) -> pd.DataFrame:
    n = size + 2
    ii, jj = (frame[c].to_numpy() - key[k] * size + 1 for k, c in enumerate("ij"))
    place = np.full((n, n), -1)
    place[jj, ii] = np.arange(len(frame))
    z = frame["z"].to_numpy(float)
    out = len(frame)  # the node outside of the map
    edges = [(z[k], k, out) for k in np.flatnonzero(frame["border"].to_numpy())]
    for a, b in ((1, 0), (0, 1), (1, 1), (-1, 1)):
        other = place[jj + b, ii + a]
        k = np.flatnonzero(other >= 0)
        edges += zip(np.maximum(z[k], z[other[k]]).tolist(), k.tolist(), other[k].tolist(), strict=True)
    rim = ((ii == 1) | (ii == size) | (jj == 1) | (jj == size)).tolist()
    return _as_edges(_least_tree(edges, [*rim, True]), list(zip(frame["i"], frame["j"], strict=True)), out)


def _as_edges(found: list[tuple[float, int, int]], spots: list[tuple[int, int]], out: int) -> pd.DataFrame:
    rows = []
    for level, a, b in found:
        a, b = (b, a) if a == out else (a, b)
        rows.append((*spots[a], *(spots[b] if b != out else (None, None)), level))
    frame = pd.DataFrame(rows, columns=["ai", "aj", "bi", "bj", "level"])
    return frame.astype({"bi": "Int32", "bj": "Int32"})


def _nodes(frame: pd.DataFrame) -> tuple[dict[tuple[int, int], int], list[tuple[float, int, int]]]:
    """Numbers of the cells of some edges, and the edges by these; the node outside comes last."""
    number: dict[tuple[int, int], int] = {}
    inner = []
    for ai, aj, bi, bj, level in zip(frame["ai"], frame["aj"], frame["bi"], frame["bj"], frame["level"], strict=True):
        a = number.setdefault((int(ai), int(aj)), len(number))
        inner.append((level, a, None if pd.isna(bi) else number.setdefault((int(bi), int(bj)), len(number))))
    return number, [(level, a, len(number) if b is None else b) for level, a, b in inner]


def _squares(edges: DataFrame, side: int, origin: tuple[int, int]) -> DataFrame:
    """Edges with the square ``si, sj`` that holds both ends; those between squares come to both, marked ``leaves``."""
    square = lambda c: F.floor((F.col(c) - origin[c[1] == "j"]) / side).cast("int")
    ends = edges.withColumns({"_si": square("ai"), "_sj": square("aj"), "_ti": F.coalesce(square("bi"), square("ai")), "_tj": F.coalesce(square("bj"), square("aj"))})
    leaves = (F.col("_si") != F.col("_ti")) | (F.col("_sj") != F.col("_tj"))
    both = F.when(leaves, F.array(F.struct("_si", "_sj"), F.struct(F.col("_ti").alias("_si"), F.col("_tj").alias("_sj")))).otherwise(F.array(F.struct("_si", "_sj")))
    return ends.select("ai", "aj", "bi", "bj", "level", leaves.alias("leaves"), F.explode(both).alias("s")).select("ai", "aj", "bi", "bj", "level", "leaves", F.col("s._si").alias("si"), F.col("s._sj").alias("sj"))


def rim_levels(edges: DataFrame, side: int, factor: int) -> DataFrame:
    """``i, j, level`` of every cell of ``edges``, by squares of ``side`` and then ``factor`` times as wide ones."""

    def reduced(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        number, inner = _nodes(frame[~frame["leaves"]])
        going = frame[frame["leaves"]]
        kept = [False] * len(number) + [True]
        for c in (("ai", "aj"), ("bi", "bj")):
            for spot in zip(going[c[0]], going[c[1]], strict=True):
                at = number.get((int(spot[0]), int(spot[1])))
                if at is not None:
                    kept[at] = True
        return _as_edges(_least_tree(inner, kept), list(number), len(number))

    def handed_down(key: tuple, frame: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        number, inner = _nodes(frame)
        level = [math.inf] * len(number) + [-math.inf]
        ways: list[list[tuple[float, int]]] = [[] for _ in level]
        for at, a, b in inner:
            ways[a].append((at, b))
            ways[b].append((at, a))
        for i, j, at in zip(known["i"], known["j"], known["level"], strict=True):
            k = number.get((int(i), int(j)))
            if k is not None:
                level[k] = at
        queue = [(at, k) for k, at in enumerate(level) if at < math.inf]
        heapq.heapify(queue)
        while queue:
            at, k = heapq.heappop(queue)
            if at > level[k]:
                continue
            for up, other in ways[k]:
                if max(at, up) < level[other]:
                    level[other] = max(at, up)
                    heapq.heappush(queue, (level[other], other))
        spots = list(number)
        return pd.DataFrame({"i": [s[0] for s in spots], "j": [s[1] for s in spots], "level": level[:-1]})

    # squares are counted from the corner of the map, so that one of them holds all in the end
    corner = edges.agg(F.min(F.least("ai", "bi")), F.min(F.least("aj", "bj"))).first()
    origin = tuple(0 if c is None else c // side * side for c in corner)
    stages: list[tuple[DataFrame, int]] = []
    while True:
        dealt = staged(_squares(edges, side, origin), "squares")
        stages.append((dealt, side))
        between = dealt.where("leaves")
        if between.isEmpty():
            break
        trees = dealt.groupBy("si", "sj").applyInPandas(reduced, EDGES)
        edges = staged(trees.unionByName(between.select("ai", "aj", "bi", "bj", "level").distinct()), "trees")
        side *= factor
    spark = edges.sparkSession
    known = spark.createDataFrame([], "i int, j int, level double")
    for dealt, wide in reversed(stages):
        at = known.select("*", F.floor((F.col("i") - origin[0]) / wide).cast("int").alias("si"), F.floor((F.col("j") - origin[1]) / wide).cast("int").alias("sj"))
        within = dealt.where("not leaves").groupBy("si", "sj").cogroup(at.groupBy("si", "sj")).applyInPandas(handed_down, "i int, j int, level double")
        # a cell with no edge inside of its square has its level from above
        known = staged(within.unionByName(known).groupBy("i", "j").agg(F.min("level").alias("level")), "levels")
    return known


def levels(cells: DataFrame, size: int, factor: int) -> DataFrame:
    """``cell, i, j, spill`` of ``cells (cell, i, j, z, border)``, all of them with a height."""
    tile = [F.floor(F.col(c) / size).cast("int").alias(t) for c, t in (("i", "ti"), ("j", "tj"))]
    known = staged(cells.select("cell", "i", "j", "z", "border", *tile), "terrain")
    trees = known.groupBy("ti", "tj").applyInPandas(lambda key, frame: _tree_of_tile(key, frame, size), EDGES)
    rim = known.where(F.pmod("i", F.lit(size)).isin(0, size - 1) | F.pmod("j", F.lit(size)).isin(0, size - 1)).select("i", "j", "z", "ti", "tj")
    each = F.array(*[F.struct(F.lit(a).alias("_a"), F.lit(b).alias("_b")) for a, b in ((1, 0), (0, 1), (1, 1), (-1, 1))])
    sent = rim.select(F.col("i").alias("ai"), F.col("j").alias("aj"), F.col("z").alias("_z"), F.col("ti").alias("_ti"), F.col("tj").alias("_tj"), F.inline(each))
    sent = sent.withColumns({"i": F.col("ai") + F.col("_a"), "j": F.col("aj") + F.col("_b")})
    steps = sent.join(rim, ["i", "j"]).where("ti <> _ti or tj <> _tj").select("ai", "aj", F.col("i").alias("bi"), F.col("j").alias("bj"), F.greatest("z", "_z").alias("level"))
    found = rim_levels(staged(trees.unionByName(steps), "trees"), size * factor, factor)

    def flooded(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        n = size + 2  # a ring of nothing around the tile
        ii, jj = (frame[c].to_numpy() - key[k] * size + 1 for k, c in enumerate("ij"))
        z, level = np.full((n, n), np.nan), np.full((n, n), math.inf)
        z[jj, ii] = frame["z"]
        level[jj, ii] = np.where(frame["border"], frame["z"], np.inf)
        level[jj, ii] = np.fmin(level[jj, ii], frame["level"].to_numpy(float))
        queue = [(level[b, a], b, a) for b, a in zip(*np.nonzero(np.isfinite(level)), strict=True)]
        heapq.heapify(queue)
        while queue:
            at, b, a = heapq.heappop(queue)
            if at > level[b, a]:
                continue
            for da, db in AROUND:
                p, q = a + da, b + db
                up = max(at, z[q, p])
                if z[q, p] == z[q, p] and up < level[q, p]:
                    level[q, p] = up
                    heapq.heappush(queue, (up, q, p))
        return frame[["cell", "i", "j"]].assign(spill=level[jj, ii])

    rows = known.join(found, ["i", "j"], "left").select("cell", "i", "j", "z", "border", "level", "ti", "tj")
    cell = known.schema["cell"].dataType.simpleString()
    return rows.groupBy("ti", "tj").applyInPandas(flooded, f"cell {cell}, i int, j int, spill double")
