"""Connected parts of cells: labels inside of tiles, then a small graph of tile borders.

Cells are put together in their tile, many at a time by array operations. Only cells on the
rim of a tile can touch another tile, so the graph that spans the map has a node for each
part of a tile and not for each cell, and its rounds grow with the logarithm of the tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firngrid.operators.components import connected_components
from firngrid.sources.shared import staged

#: One of each pair of opposite directions.
SIDES = ((1, 0), (0, 1))
CORNERS = ((1, 1), (-1, 1))


def whole_groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames that end where a group of ``keys`` ends, and the number of each row's group in its frame.

    The rows of a group stand together. One group at most is carried from frame to frame.
    """
    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        changes = np.zeros(len(frame), bool)
        for k in keys:
            v = frame[k].to_numpy()
            changes[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(changes)
        if len(starts):
            last = starts[-1]
            yield frame.iloc[:last], np.cumsum(changes[:last])
            frame = frame.iloc[last:].reset_index(drop=True)
        rest = frame
    if rest is not None and len(rest):
        yield rest, np.zeros(len(rest), np.int64)


def least_of_parts(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node of the part of each node 0 to n - 1, by edges ``a - b``."""
    parent = np.arange(n)
    while True:
        pa, pb = parent[a], parent[b]
        apart = pa != pb
        if not apart.any():
            return parent
        a, b, pa, pb = a[apart], b[apart], pa[apart], pb[apart]
        np.minimum.at(parent, np.maximum(pa, pb), np.minimum(pa, pb))
        while (parent != parent[parent]).any():
            parent = parent[parent]


def tile_labels(cells: DataFrame, keys: list[str], offsets, size: int) -> DataFrame:
    """``keys, cell, i, j, label``: the least cell of each cell's part inside of its tile."""
    tile = [F.floor(F.col(c) / size).cast("int").alias(t) for c, t in (("i", "_ti"), ("j", "_tj"))]
    dealt = cells.select(*keys, "cell", "i", "j", *tile)
    group = [*keys, "_ti", "_tj"]

    def labelled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, number in whole_groups(frames, group):
            order = np.argsort(frame["cell"].to_numpy(), kind="stable")  # nodes by their cell
            frame, number = frame.iloc[order], number[order]
            i, j = frame["i"].to_numpy() % size, frame["j"].to_numpy() % size
            code = (number * size + j) * size + i
            by_code = np.argsort(code, kind="stable")
            found = []
            for di, dj in offsets:
                inside = np.flatnonzero((i + di >= 0) & (i + di < size) & (j + dj < size))
                wanted = code[inside] + dj * size + di
                at = np.minimum(np.searchsorted(code, wanted, sorter=by_code), len(code) - 1)
                met = code[by_code[at]] == wanted
                found.append((inside[met], by_code[at[met]]))
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            cell = frame["cell"].to_numpy()
            yield frame[[*keys, "cell", "i", "j"]].assign(label=cell[least_of_parts(len(cell), a, b)])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.select(*keys, "cell", "i", "j").schema)
    return dealt.repartition(*group).sortWithinPartitions(*group).mapInPandas(labelled, f"{schema}, label long")


def grid_parts(cells: DataFrame, keys: list[str], corners: bool = False, size: int = 64) -> DataFrame:
    """``keys, cell, part``: connected cells that have equal ``keys``; the least cell names a part.

    Cells touch by their sides, with ``corners`` by these too. Rows with a null key have no part;
    repeated rows count once; no cells give no rows.
    """
    offsets = SIDES + CORNERS if corners else SIDES
    known = cells.select(*keys, F.col("cell").cast("long").alias("cell"), "i", "j").distinct()
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    labels = staged(tile_labels(known, keys, offsets, size), "labels")

    def tile(c: str | Column) -> Column:
        return F.floor((F.col(c) if isinstance(c, str) else c) / size)

    rim = labels.where(F.pmod("i", F.lit(size)).isin(0, size - 1) | F.pmod("j", F.lit(size)).isin(0, size - 1))
    each = F.array(*[F.struct(F.lit(a).alias("_di"), F.lit(b).alias("_dj")) for a, b in offsets])
    i, j = F.col("i") + F.col("_di"), F.col("j") + F.col("_dj")
    leaving = rim.select(*keys, "i", "j", F.col("label").alias("_label"), F.inline(each)).where((tile("i") != tile(i)) | (tile("j") != tile(j)))
    across = leaving.select(*keys, i.alias("i"), j.alias("j"), "_label").join(rim, [*keys, "i", "j"])
    node = lambda c: F.struct(*keys, F.col(c).alias("_cell"))
    found = connected_components(across.select(node("_label").alias("a"), node("label").alias("b")))
    names = found.select(*[F.col(f"node.{k}").alias(k) for k in keys], F.col("node._cell").alias("label"), F.col("component._cell").alias("_part"))
    return labels.join(names, [*keys, "label"], "left").select(*keys, "cell", F.coalesce("_part", "label").alias("part"))
