"""Invariants of grid operators, on the toy terrain and small made-up tables."""

import heapq
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from firngrid.functions import grid as G
from firngrid.operators import catalog, climate, flow, focal, mosaic, parts, pra, raster, relax, tiles, vector
from firngrid.operators.components import connected_components
from firngrid.sources import blobs, sinks
from firngrid.streaming import streams


@pytest.fixture(scope="module")
def toy(spark):
    """Two hills with a closed bowl between them, terraces, and water along one side: cell, i, j, elev, z."""
    rows = []
    for cell in range(11 * 12):
        i, j = cell % 12, cell // 12
        elev = 4.0 * min(abs(i - 2) + abs(j - 8), abs(i - 9) + abs(j - 3), 6) + (3 * i + j) // 4
        if abs(i - 5) <= 1 and abs(j - 6) <= 1:
            elev = 2.5
        rows.append((cell, i, j, -1.0 if j == 0 or (i == 0 and j < 5) else elev + 1.0))
    cells = spark.createDataFrame(rows, "cell long, i int, j int, elev double")
    return cells.withColumn("z", F.when(F.col("elev") > 0, F.col("elev"))).cache()


def _flood(rows):
    """Spill levels by one priority queue over all cells."""
    z = {(r.i, r.j): r.z for r in rows if r.z is not None}
    level = {}
    around = lambda c: [(c[0] + a, c[1] + b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0)]
    queue = [(z[c], c) for c in z if any(n not in z for n in around(c))]
    heapq.heapify(queue)
    while queue:
        at, c = heapq.heappop(queue)
        if c in level:
            continue
        level[c] = at
        for n in around(c):
            if n in z and n not in level:
                heapq.heappush(queue, (max(at, z[n]), n))
    return level


@pytest.mark.parametrize("size", [3, 128])
def test_spill_levels_of_the_toy(toy, size):
    found = {(r.i, r.j): r.spill for r in flow.spill_levels(toy, "z", size, factor=2).collect()}
    assert found == _flood(toy.collect())


def test_spill_levels_through_many_tiles(spark):
    rng = random.Random(13)
    # walls with gaps make water go a long way round; two holes in the map, and one cell alone
    height = lambda i, j: 50.0 if j % 6 == 3 and i % 40 != (2 if j % 12 == 3 else 37) else float(rng.randrange(12))
    rows = [(1000 * j + i, i, j, height(i, j)) for i in range(-5, 41) for j in range(30) if not (10 <= i < 13 and 10 <= j < 13)]
    cells = spark.createDataFrame([*rows, (77, 60, 60, 4.0)], "cell long, i int, j int, z double")
    found = {(r.i, r.j): r.spill for r in flow.spill_levels(cells, "z", 4, factor=2).collect()}
    assert found == _flood(cells.collect())
    assert flow.spill_levels(cells.limit(0), "z", 4).count() == 0


def test_flow_edges_lead_out(toy):
    known = toy.where("z is not null")
    spill = flow.spill_levels(toy, "z", 4)
    edges = {r.cell: r.next_cell for r in flow.flow_edges(spill, "spill", flow.edge_cells(known, "z")).collect()}
    level = {r.cell: r.spill for r in spill.collect()}
    for cell in edges:
        at, steps = cell, 0
        while at >= 0:
            assert edges[at] < 0 or level[edges[at]] <= level[at]
            at, steps = edges[at], steps + 1
            assert steps <= len(edges)


def test_flats_are_chained_alike_by_blocks(spark, monkeypatch):
    cells = spark.createDataFrame([(9 * j + i, i, j, 1.0 if i < 6 else 2.0) for i in range(9) for j in range(7)], "cell long, i int, j int, z double")
    edges = []
    for block in (flow.CHAIN_BLOCK, 5, 1):
        monkeypatch.setattr(flow, "CHAIN_BLOCK", block)
        edges.append(sorted(map(tuple, flow.flow_edges(cells, "z", cells.where("i = 0")).collect())))
    assert edges[0] == edges[1] == edges[2]
    low = [c for c, _ in edges[0] if c % 9 < 6]
    assert [n for c, n in edges[0] if c % 9 < 6] == [*low[1:], -1]


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(None, 3), (5, 5), (5, 5)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert dict(found.collect()) == {x: root(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_differences_round_trip(spark):
    cells = spark.createDataFrame([(1, k, k * k % 7, k) for k in range(9)], "aval_id long, cell long, i int, j int")
    coded = mosaic.encode_differences(cells, ["i", "j"], "aval_id", "cell")
    assert sorted(mosaic.decode_differences(coded, ["i", "j"], "aval_id", "cell").collect()) == sorted(cells.collect())


def test_mosaic_is_at_least_each_input(spark):
    rng = random.Random(1)
    rows = [(a, rng.randrange(4), rng.randrange(4), rng.random() * 3, rng.random(), rng.random()) for a in range(60)]
    cells = spark.createDataFrame(rows, "aval_id int, i int, j int, max_vel double, max_height double, depo double")
    layers = {(r.i, r.j): r for r in mosaic.mosaic(cells).collect()}
    again = {(r.i, r.j): r for r in mosaic.mosaic(cells.orderBy("depo")).collect()}
    assert layers == again
    for _, i, j, v, h, d in rows:
        if h > 0.25 and v > 1.0:
            at = layers[i, j]
            assert at.max_height >= h and at.max_velocity >= v and at.deposition >= d


def test_two_focal_forms_agree(spark):
    rng = random.Random(2)
    rows = [(i, j, None if rng.random() < 0.1 else rng.random()) for i in range(20) for j in range(17)]
    cells = spark.createDataFrame(rows, "i int, j int, v double")
    v, w = F.col("v"), F.col("w")
    loose = F.sum(v * w) / F.sum(F.when(v.isNotNull(), w))
    strict = F.when(F.count(v) == F.count("*"), loose)
    small = focal.focal(cells, ["v"], focal.weighted(focal.SMOOTHING), [loose.alias("v"), strict.alias("s")])
    tiles = focal.focal_blocks(cells, "v", focal.SMOOTHING, 8)
    tiles = tiles.select("i", "j", (F.col("total") / F.col("weight")).alias("v"), "unknown")
    large = [focal.mean(cells, "v", focal.weighted(focal.SMOOTHING), s) for s in (False, True)]
    a = {(r.i, r.j): r for r in small.collect()}
    b, c, d = ({(r.i, r.j): r for r in df.collect()} for df in (tiles, *large))
    assert a.keys() == b.keys() == c.keys() == d.keys()
    assert all(abs(a[k].v - x[k].v) < 1e-9 for k in a for x in (b, c))
    assert all((a[k].s is None) == (d[k].v is None) == (b[k].unknown > 0) for k in a)
    assert all(a[k].s is None or abs(a[k].s - d[k].v) < 1e-9 for k in a)


def test_blur_of_a_grid_narrower_than_the_kernel(spark):
    rng = random.Random(6)
    n, (nx, ny), sigma = {}, (9, 4), 3.0
    for i in range(nx):
        for j in range(ny):
            n[i, j] = rng.random()
    w = focal.gaussian_weights(sigma)
    r = len(w) // 2
    fold = lambda k, size: min(k % (2 * size), 2 * size - 1 - k % (2 * size))
    across = {(i, j): sum(w[d + r] * n[fold(i + d, nx), j] for d in range(-r, r + 1)) for i, j in n}
    both = {(i, j): sum(w[d + r] * across[i, fold(j + d, ny)] for d in range(-r, r + 1)) for i, j in n}
    cells = spark.createDataFrame([(i, j, v) for (i, j), v in n.items()], "i int, j int, v double")
    found = {(x.i, x.j): x.v for x in focal.blur(cells, "v", sigma).collect()}
    assert found.keys() == both.keys() and all(abs(found[k] - both[k]) < 1e-9 for k in both)


def _relaxed(values):
    """Unknown cells by a direct solve."""
    holes = [k for k, v in values.items() if v is None]
    at = {k: n for n, k in enumerate(holes)}
    a, b = np.zeros((len(holes), len(holes))), np.zeros(len(holes))
    for (i, j), n in at.items():
        for k in ((i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)):
            if k in values:
                a[n, n] += 1
                if k in at:
                    a[n, at[k]] -= 1
                else:
                    b[n] += values[k]
    return dict(zip(holes, np.linalg.solve(a, b), strict=True))


@pytest.mark.parametrize("at_once", [65_536, 3])
def test_wide_holes_relax_to_the_direct_solution(spark, monkeypatch, at_once):
    monkeypatch.setattr(relax, "AT_ONCE", at_once)  # with 3, the system of tiles is solved in rounds as well
    rng = random.Random(11)
    values = {(i, j): None if (2 < i < 20 and 3 < j) or rng.random() < 0.2 else 100 * rng.random() + 5 * i for i in range(24) for j in range(18) if (i, j) != (9, 9)}
    cells = spark.createDataFrame([(i, j, v) for (i, j), v in values.items()], "i int, j int, v double")
    found = {(r.i, r.j): r.v for r in relax.filled(cells, "v", 0.1, 8).collect()}
    assert found.keys() == values.keys() and all(found[k] == v for k, v in values.items() if v is not None)
    around = lambda i, j: [found[k] for k in ((i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)) if k in found]
    assert all(abs(np.mean(around(*k)) - found[k]) <= 0.1 for k, v in values.items() if v is None)
    exact = _relaxed(values)
    assert max(abs(found[k] - v) for k, v in exact.items()) < 5


def test_holes_without_a_known_neighbour_stay(spark):
    row = lambda known: spark.createDataFrame([(i, 0, 1.0 if i == 0 and known else float("nan") if i == 5 else None) for i in range(30)], "i int, j int, v double")
    assert [r.v for r in relax.filled(row(True), "v").collect()] == pytest.approx([1.0] * 30, abs=1.0)
    assert relax.filled(row(False), "v").where("v is not null").count() == 0
    both = row(True).unionByName(spark.createDataFrame([(0, 2, None), (1, 2, None)], "i int, j int, v double"))
    assert sorted((r.i, r.j) for r in relax.filled(both, "v").where("v is null").collect()) == [(0, 2), (1, 2)]
    assert relax.filled(row(True).limit(0), "v").count() == 0


@pytest.mark.parametrize("corners", [False, True])
def test_parts_of_grids_equal_a_search(spark, corners):
    rng = random.Random(4)
    shift = 3_000_000_000  # beyond any 32-bit cell number
    rows = {(k, i, j): shift + 1000 * j + i for k in "ab" for i in range(-9, 13) for j in range(14) if rng.random() < (0.45 if corners else 0.6)}
    rows |= {("c", i, 3): shift + i for i in range(40)}  # one part through many tiles
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0) and (corners or not a * b)]
    expected, seen = {}, set()
    for start in sorted(rows, key=rows.get):
        if start in seen:
            continue
        todo, name = [start], rows[start]
        seen.add(start)
        while todo:
            k, i, j = todo.pop()
            expected[k, rows[k, i, j]] = name
            for a, b in steps:
                near = k, i + a, j + b
                if near in rows and near not in seen:
                    seen.add(near)
                    todo.append(near)
    table = [(k, c, i, j) for (k, i, j), c in rows.items()]
    cells = spark.createDataFrame([*table, table[0], (None, 5, 1, 1)], "k string, cell long, i int, j int")
    found = parts.grid_parts(cells, ["k"], corners, size=4)
    assert {(r.k, r.cell): r.part for r in found.collect()} == expected and found.count() == len(expected)
    assert parts.grid_parts(cells.limit(0), ["k"], corners).count() == 0


def test_wide_blur_in_strips_equals_sums(spark):
    rng = np.random.default_rng(5)
    nx, sigma = 700, 40.0  # half width 160: transforms, three strips
    v = rng.normal(100, 20, nx)
    v[300:480] = np.nan
    w = np.array(focal.gaussian_weights(sigma))
    r = len(w) // 2
    padded = np.pad(v, r, mode="symmetric")
    known = ~np.isnan(padded)
    whole = np.array([np.nansum(padded[k : k + 2 * r + 1] * w) / (known[k : k + 2 * r + 1] * w).sum() for k in range(nx)])
    cells = spark.createDataFrame([(k, 0, None if np.isnan(x) else float(x)) for k, x in enumerate(v)], "i int, j int, v double")
    found = {r.i: r.v for r in focal.blur(cells, "v", sigma).collect()}
    assert len(found) == nx and max(abs(found[k] - whole[k]) for k in found) < 1e-8
    # where the kernel meets no known cell there is no value
    far = {r.i: r.v for r in focal.blur(cells.where("i < 640").withColumn("v", F.when(F.col("i") < 10, 1.0)), "v", 10.0).collect()}
    assert far[40] == pytest.approx(1.0) and far[60] is None and far[639] is None


def test_tiles_of_several_bands_equal_neighbours(spark):
    rng = random.Random(7)
    rows = [(i, j, rng.random(), None if rng.random() < 0.2 else rng.random()) for i in range(21) for j in range(19) if rng.random() < 0.9]
    cells = spark.createDataFrame(rows, "i int, j int, a double, b double")
    kernel = np.arange(9.0).reshape(3, 3)
    wide = np.ones((5, 5))
    found = {(r.i, r.j): r for r in tiles.kernel_sums(cells, {"x": ("a", kernel), "y": ("b", wide)}, 8).collect()}
    a, b = {(r[0], r[1]): r[2] for r in rows}, {(r[0], r[1]): r[3] for r in rows if r[3] is not None}
    assert found.keys() == a.keys()
    for (i, j), r in found.items():
        x = sum(kernel[dj + 1, di + 1] * a.get((i + di, j + dj), 0) for di in (-1, 0, 1) for dj in (-1, 0, 1))
        near = [b[i + di, j + dj] for di in range(-2, 3) for dj in range(-2, 3) if (i + di, j + dj) in b]
        assert r.x == pytest.approx(x) and r.y_n == len(near) and (r.y == pytest.approx(sum(near)) if near else r.y is None)


def test_gradients_of_a_grid_of_one_column(spark):
    rng = random.Random(9)
    height, value = [rng.random() * 50 for _ in range(7)], [rng.random() * 9 for _ in range(7)]
    make = lambda nx: spark.createDataFrame([(i, j, height[j], value[j]) for i in range(nx) for j in range(7)], "i int, j int, h double, v double")
    narrow, wide = ({r.j: r.lapse for r in focal.gradient_lapse(make(nx), "h", "v", 10.0).where("i = 0").collect()} for nx in (1, 5))
    assert narrow == pytest.approx(wide)


def test_blur_by_height_across_tiles(spark):
    rng = random.Random(3)
    cells = {(i, j): (None if rng.random() < 0.1 else rng.random(), rng.random() * 300) for i in range(140) for j in range(3)}
    frame = spark.createDataFrame([(i, j, v, h) for (i, j), (v, h) in cells.items()] + [(200, 0, 1.0, None)], "i int, j int, v double, h double")
    found = {(r.i, r.j): r.v for r in focal.blur_by_height(frame, "v", "h", 10.0, (20.0, 20.0, 150.0)).collect()}
    assert found.keys() == cells.keys()
    for i, j in [(0, 0), (126, 1), (127, 2), (128, 0), (131, 1), (139, 2)]:
        total = weight = 0.0
        for a in range(-4, 5):
            for b in range(-4, 5):
                v, h = cells.get((i + a, j + b), (None, 0))
                q = 0.25 * (a * a + b * b) + ((h - cells[i, j][1]) / 150) ** 2
                if v is not None and q <= 4 and a * a + b * b <= 16:
                    total, weight = total + v * math.exp(-q / 2), weight + math.exp(-q / 2)
        assert found[i, j] == (pytest.approx(total / weight) if weight else None)


def test_nearest_looks_as_far_as_it_must(spark):
    rng = random.Random(8)
    spots = [(rng.randrange(400), rng.randrange(400)) for _ in range(12)] + [(0, 0), (399, 399)]
    points = [(k, rng.randrange(400), rng.randrange(400)) for k in range(30)]
    found = vector.nearest(spark.createDataFrame(points, "cell long, i int, j int"), spark.createDataFrame(spots, "i int, j int"), 5, 8)
    by_cell = {}
    for r in found.collect():
        by_cell.setdefault(r.cell, []).append(r.distance)
    for k, i, j in points:
        assert sorted(by_cell[k]) == pytest.approx(sorted(math.hypot(i - a, j - b) for a, b in spots)[:5])


def test_a_second_run_takes_only_new_files(spark):
    rows = spark.createDataFrame([(k, f"t{k}") for k in range(4)], "id long, name string")
    source, out = sinks.scratch(rows, "lots"), sinks.scratch(rows, "copied")
    for lot in (0, 1):
        rows.where(F.col("id") % 2 == lot).write.mode("append").parquet(source)
        seen = []
        stream = streams.files(spark, source, rows.schema)
        copied = streams.drained(stream, out)
        seen.append(copied.count())
        assert seen == [2 * (lot + 1)]  # were the first lot read again, its rows would stand twice


def test_coarse_sums_keep_the_total(spark):
    cells = spark.range(400).select((F.col("id") % 20).cast("int").alias("i"), F.floor(F.col("id") / 20).cast("int").alias("j"), F.col("id").cast("double").alias("v"))
    coarse = raster.coarsen(cells, 3, [F.sum("v").alias("v")])
    assert coarse.agg(F.sum("v")).first()[0] == sum(range(400))


def test_burn_counts_the_area_of_a_box(spark):
    ring = [{"x": float(x), "y": float(y)} for x, y in ((1, 2), (6, 2), (6, 9), (1, 9))]
    cells = vector.burn(spark.createDataFrame([(7, ring)], "id long, ring array<struct<x:double,y:double>>"), "id")
    assert cells.count() == 35


def _ring(*spots):
    return [{"x": float(x), "y": float(y)} for x, y in spots]


_POINT = "struct<x:double,y:double>"


def test_burn_of_a_star_with_a_hole_equals_a_test_of_every_cell(spark):
    outer = _ring((0, 0), (9.3, 4.1), (18, -3), (13.7, 9.2), (21, 17), (9.1, 12.6), (-2.4, 19), (4.2, 8.8))
    hole = _ring((7, 5), (11, 6), (9, 10))
    found = vector.burn(spark.createDataFrame([(1, [outer, hole]), (2, [_ring((0.6, 0.6), (0.9, 0.6), (0.7, 0.9))])], f"id long, rings array<array<{_POINT}>>"), "id")
    cells = {(r.i, r.j) for r in found.collect()}
    grid = spark.range(30 * 30).select((F.col("id") % 30 - 5).alias("i"), (F.floor(F.col("id") / 30) - 5).alias("j"))
    ring = lambda r: F.array(*[F.struct(F.lit(p["x"]).alias("x"), F.lit(p["y"]).alias("y")) for p in r])
    inside = lambda r: vector.inside_ring(F.col("i") + 0.5, F.col("j") + 0.5, ring(r))
    assert cells == {(r.i, r.j) for r in grid.where(inside(outer) != inside(hole)).collect()} and found.count() == len(cells) > 100


def test_overlap_of_slanted_and_concave_polygons(spark):
    square = _ring((0, 0), (4, 0), (4, 4), (0, 4))
    turned = _ring((2, -1), (5, 2), (2, 5), (-1, 2))  # cuts off the four corners of the square, two sides of 1 each
    comb = _ring((0, 0), (4, 0), (4, 4), (3, 4), (3, 1), (1, 1), (1, 4), (0, 4))[::-1]
    frame = [_ring((0, 0), (4, 0), (4, 4), (0, 4)), _ring((1, 1), (3, 1), (3, 3), (1, 3))]
    pairs = {1: ([square], [turned]), 2: ([square], [comb]), 3: (frame, [turned]), 4: (frame, [_ring((1.5, 1.5), (2.5, 1.5), (2.5, 2.5))]), 5: ([comb], [_ring((0, 2), (4, 2), (4, 3), (0, 3))]), 6: ([square], [_ring((9, 9), (10, 9), (9, 10))]), 7: ([turned], [turned])}
    table = lambda k: spark.createDataFrame([(i, p[k]) for i, p in pairs.items()], f"id long, rings array<array<{_POINT}>>")
    found = {r.id: (r.area_a, r.area_b, r.area_both) for r in vector.overlap_area(table(0), table(1), "id").collect()}
    expected = {1: (16, 18, 14), 2: (16, 10, 10), 3: (12, 18, 10), 4: (12, 0.5, 0), 5: (10, 4, 2), 6: (16, 0.5, 0), 7: (18, 18, 18)}
    assert all(found[k] == pytest.approx(v) for k, v in expected.items())


def test_least_rectangle_of_a_turned_row(spark):
    cells = spark.createDataFrame([(1, k, k) for k in range(10)], "id long, i int, j int")
    found = vector.least_rectangles(vector.hulls(cells, "id"), "id").first()
    assert found.area == pytest.approx(2 * math.sqrt(0.5) * (10 * math.sqrt(2)), rel=1e-9)
    corners = np.array([(p.x, p.y) for p in found.ring])
    sides = np.linalg.norm(np.roll(corners, -1, 0) - corners, axis=1)
    assert sides[0] * sides[1] == pytest.approx(found.area)


def test_outline_rings_close(spark):
    cells = spark.createDataFrame([(1, i, j) for i in range(3) for j in range(3) if (i, j) != (1, 1)], "id long, i int, j int")
    rings = flow.outline_rings(cells, "id").collect()
    assert sorted(len(r.points) // 2 for r in rings) == [4, 12]


def test_runout_stops_and_voids(spark):
    rows = [(j * 12 + i, i, j, float(100 - 8 * i) if 0 < i < 11 else 0.0) for i in range(12) for j in range(3)]
    cells = spark.createDataFrame(rows, "cell long, i int, j int, h double")
    wide = cells.union(spark.createDataFrame([(1000 + k, i, j, 200.0) for k, (i, j) in enumerate((a, b) for a in range(-1, 13) for b in (-1, 3))], cells.schema))
    release = spark.createDataFrame([(1, 12 + 4), (2, 12 + 1)], "pra_id long, cell long")
    found = flow.runout(release, wide, "h", 10.0, max_runout=25.0)
    reached = sorted(r.cell for r in found.where("pra_id = 1").collect())
    assert 12 + 4 in reached and all(c % 12 >= 4 for c in reached) and max(c % 12 for c in reached) <= 7


def test_runouts_are_alike_in_tiles_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(flow, "AREAS", 2)  # areas of a tile are shared by several tasks
    rng = random.Random(2)
    height = lambda i, j: 400.0 - 9 * i - abs(j - 8) * 3 + rng.randrange(8)
    rows = [(1000 * j + i, i, j, None if (i, j) == (30, 4) else height(i, j)) for i in range(34) for j in range(17)]
    cells = spark.createDataFrame(rows, "cell long, i int, j int, h double")
    release = spark.createDataFrame([(p, 1000 * rng.randrange(2, 15) + rng.randrange(2, 20)) for p in range(12) for _ in range(3)], "pra_id long, cell long")
    found = [sorted(map(tuple, flow.runout(release, cells, "h", 10.0, min_alpha=10.0, max_runout=90.0, tile=t).collect())) for t in (3, 64)]
    assert found[0] == found[1] and len({p for p, _ in found[0]}) > 2
    cell_of = {c: (i, j) for c, i, j, _ in rows}
    assert any(cell_of[c][0] // 3 != cell_of[d][0] // 3 for (p, c), (q, d) in zip(found[0], found[0][1:], strict=False) if p == q)


def test_reachable_takes_few_rounds_and_ends_on_circles(spark):
    edges = [(k, k + 1) for k in range(100)] + [(100, -1), (200, 201), (201, 202), (202, 200)]
    start = [(1, 0), (1, 90), (2, 98), (3, 201), (4, 555)]
    found = flow.reachable(spark.createDataFrame(start, "root long, cell long"), spark.createDataFrame(edges, "cell long, next_cell long"))
    expected = {(1, k) for k in range(101)} | {(2, k) for k in (98, 99, 100)} | {(3, k) for k in (200, 201, 202)} | {(4, 555)}
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_quantiles_are_exact_wherever_the_ranges_are_cut(spark):
    from firngrid.operators import stats

    rng = random.Random(8)
    groups = {"a": [rng.gauss(0, 1) for _ in range(501)], "b": [3.0] * 400 + [1.0, 9.0], "c": [7.5], "d": [1.0, 2.0]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("a", None), ("a", float("nan")), (None, 1.0), ("e", None)]
    frame = spark.createDataFrame(rows, "k string, v double")
    found = {r.k: r for r in stats.quantiles(frame, ["k"], "v", {"low": 0.1, "mid": 0.5, "top": 1.0}).collect()}
    assert found.keys() == groups.keys()
    for k, vs in groups.items():
        assert found[k].n == len(vs)
        assert [found[k].low, found[k].mid, found[k].top] == pytest.approx(np.quantile(vs, [0.1, 0.5, 1.0]).tolist())
    every = stats.quantiles(frame, [], "v", {"mid": 0.5}).first()
    assert every.mid == pytest.approx(np.median([v for vs in groups.values() for v in vs] + [1.0]))
    none = stats.scaled_by_median_ratio(spark.createDataFrame([(1.0, 0.0)], "v double, w double"), "v", "w").collect()
    assert [r.scaled for r in none] == [None]


def test_nearest_where_there_are_too_few_or_none(spark):
    points = spark.createDataFrame([(1, 0, 0), (2, 900, 5)], "cell long, i int, j int")
    spots = spark.createDataFrame([(3, 4), (3, 4), (-700, 0)], "i int, j int")
    found = sorted(map(tuple, vector.nearest(points, spots, 9, 8).collect()))
    assert found == [(1, 5.0), (1, 5.0), (1, 700.0), *sorted((2, math.hypot(900 - i, 5 - j)) for i, j in ((3, 4), (3, 4), (-700, 0)))]
    assert vector.nearest(points, spots.limit(0), 2, 8).count() == 0 and vector.nearest(points.limit(0), spots, 2, 8).count() == 0


def test_readers_follow_the_newest_version(spark):
    rows = spark.createDataFrame([(1, 5, "full"), (2, 6, "christen")], "aval_id long, cell long, extent_type string")
    folder = sinks.scratch(rows, "extents")
    with pytest.raises(FileNotFoundError):
        sinks.read_extents(spark, folder, "full")
    sinks.write_extents(rows, folder)
    before = sinks.read_extents(spark, folder, "full")
    assert sinks.read_extents(spark, folder, "tetra1").count() == 0  # a type without cells
    rows.withColumn("cell", F.lit(0)).write.parquet(f"{folder}/version-unfinished")  # no row names it
    assert [r.cell for r in sinks.read_extents(spark, folder, "full").collect()] == [5]
    sinks.write_extents(rows.withColumn("cell", F.col("cell") + 1), folder)
    assert [r.cell for r in sinks.read_extents(spark, folder, "full").collect()] == [6]
    assert [r.cell for r in before.collect()] == [5]  # the old version is still whole
    sinks.write_extents(rows.limit(0), folder)
    assert sinks.read_extents(spark, folder, "full").count() == 0
    assert sinks.drop_old_versions(spark, folder, 1) == 2
    assert sinks.read_extents(spark, folder, "full").count() == 0


def _status_rows(spark, rows):
    full = [(i, c, f"2024-01-{d:02d} 00:00:00", s) for i, c, d, s in rows]
    return spark.createDataFrame(full, "id long, chunkid int, t string, id_status int").select("id", "chunkid", F.to_timestamp("t").alias("ts"), "id_status")


def test_latest_status_with_late_rows_and_compaction(spark):
    first = _status_rows(spark, [(1, 0, 1, 2), (2, 0, 1, 5), (1, 0, 3, 6), (1, 0, 3, 4)])
    source, out = sinks.scratch(first, "status"), sinks.scratch(first, "latest")
    run = lambda rows: (rows.coalesce(1).write.mode("append").parquet(source), {(r.id, r.chunkid): r.id_status for r in streams.latest_status_table(streams.files(spark, source, first.schema), "2 days", out).collect()})[1]
    assert run(first) == {(1, 0): 6, (2, 0): 5}
    assert streams.compact(spark, out) > 0 and streams.compact(spark, out) == 0
    # a row that is older than what is known, and one that is far too late
    assert run(_status_rows(spark, [(1, 0, 2, 1), (3, 0, 9, 4)])) == {(1, 0): 6, (2, 0): 5, (3, 0): 4}
    assert run(_status_rows(spark, [(4, 0, 1, 3), (2, 0, 10, 6)])) == {(1, 0): 6, (2, 0): 6, (3, 0): 4}
    streams.compact(spark, out)
    assert {(r.id, r.id_status) for r in streams.status_table(spark, out).collect()} == {(1, 6), (2, 6), (3, 4)}


def test_state_of_idle_keys_ends(spark):
    days = [_status_rows(spark, [(k, 0, d, 1) for k in range(d, d + 3)]) for d in (1, 5, 20, 28)]
    source, log = sinks.scratch(days[0], "events"), sinks.scratch(days[0], "log")
    kept = []
    for rows in days:
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = streams.latest_status(streams.files(spark, source, rows.schema), "1 day", idle_days=7)
        query = stream.writeStream.outputMode("update").option("checkpointLocation", log).trigger(availableNow=True).foreachBatch(lambda df, n: df.count()).start()
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert kept[0] == 3 and kept[-1] <= 6 < 12  # the keys of the first days are gone


def test_area_query_waits_until_all_are_ready(spark):
    from firngrid.operators import status

    box = "x0 double, y0 double, x1 double, y1 double"
    tiles = spark.createDataFrame([(0, 0, 0.0, 0.0, 10.0, 10.0), (1, 0, 10.0, 0.0, 20.0, 10.0), (5, 0, 50.0, 0.0, 60.0, 10.0)], f"idom int, jdom int, {box}")
    combos = spark.createDataFrame([("past",), ("future",)], "era string")
    runs = spark.createDataFrame([(1, 0, 0, 6, 1.0, 1.0, 2.0, 2.0), (2, 1, 0, 6, 12.0, 1.0, 13.0, 2.0), (3, 5, 0, 6, 51.0, 1.0, 52.0, 2.0), (4, 0, 0, 1, 1.0, 1.0, 2.0, 2.0)], f"id long, idom int, jdom int, id_status int, {box}")
    state = combos.crossJoin(tiles.select("idom", "jdom")).withColumn("combo_status", F.when((F.col("era") == "past") & (F.col("idom") == 1), 2).otherwise(6))
    ask = lambda area, **more: sorted((r.era, r.id) for r in status.area_query(tiles, combos, runs, area, 1.0, (5, 6), **more).collect())
    assert ask((0, 0, 9, 9)) == [("future", 1), ("past", 1)]
    assert ask((0, 0, 13, 9)) == ask("west", named={"west": (0, 0, 13, 9)}) == [("future", 1), ("future", 2), ("past", 1), ("past", 2)]
    with pytest.raises(ValueError, match="unknown extent"):
        ask("east")
    with pytest.raises(ValueError, match="below status"):
        ask((0, 0, 13, 9), combo_status=state, least=5)
    assert ask((0, 0, 13, 9), combo_status=state, least=5, force=True) == [("future", 1), ("future", 2), ("past", 1)]
    assert ask((0, 0, 8, 9), combo_status=state, least=5) == [("future", 1), ("past", 1)]
    assert ask("tile", chosen=runs.where("id = 3")) == [("future", 3), ("past", 3)]
    assert ask("aval", chosen=runs.where("id in (2, 4)")) == [("future", 2), ("past", 2)]
    assert status.area_extent(status.area_boxes("aval", runs.where("id < 3"), tiles)) == (1.0, 1.0, 13.0, 2.0)


def test_gev_fit_finds_its_parameters(spark):
    rng = np.random.default_rng(4)
    x = 50 + 10 / 0.1 * (1 - (-np.log(rng.uniform(size=400))) ** 0.1)
    rows = [(1, float(v)) for v in x] + [(2, 0.0)] * 5 + [(3, 4.0)]
    found = {r.cell: r for r in climate.likelihood_fit(spark.createDataFrame(rows, "cell long, v double")).collect()}
    assert abs(found[1]["loc"] - 50) < 3 and abs(found[1]["scale"] - 10) < 2 and abs(found[1]["shape"] - 0.1) < 0.15
    assert found[2]["scale"] == 0.0 and found[3]["scale"] is None


def test_spiral_is_one_to_one(spark):
    n = spark.range(500).select(F.col("id").cast("int").alias("n"))
    x, y = G.spiral_cell(F.col("n"))
    back = n.select("n", x.alias("x"), y.alias("y")).select("n", G.spiral_number(F.col("x"), F.col("y")).alias("m"))
    assert back.where("n <> m").count() == 0


def test_projection_of_the_origin(spark):
    x, y = G.albers(F.lit(-154.0), F.lit(50.0))
    assert spark.range(1).select(x, y).first() == pytest.approx((0.0, 0.0), abs=1e-6)


def test_specs():
    assert catalog.parse_spec("ak-..-30") == ["ak", None, None, "30"]


def test_chunks_have_bounded_size(spark):
    areas = spark.range(1203).select("id", F.lit("T").alias("pra_size"))
    counts = [r["count"] for r in pra.chunked(areas).groupBy("chunkid").count().collect()]
    assert sorted(counts) == [203, 500, 500]


def test_result_files(spark, tmp_path):
    cells = spark.createDataFrame([(1, k, 1.0 * k, 0.5, 0.25) for k in range(4)], "aval_id long, cell long, max_vel double, max_height double, depo double")
    content = blobs.pack(cells).first().content
    (tmp_path / "1.out").write_bytes(bytes(content))
    (tmp_path / "2.out").write_bytes(bytes(content)[:-3])
    read = blobs.read_blobs(spark, str(tmp_path)).withColumn("aval_id", F.regexp_extract("path", r"(\d+)\.out", 1).cast("long"))
    assert [r.max_vel for r in blobs.decode_out(read).orderBy("pos").collect()] == [0.0, 1.0, 2.0, 3.0]
    assert [r.aval_id for r in blobs.inconsistent(read).collect()] == [2]


def test_publishing_replaces_only_its_partitions(spark, tmp_path):
    row = lambda layer, v: ("e", "w", layer, 1, 1, v)
    schema = "exp string, wcombo string, layer string, idom int, jdom int, value double"
    path = str(tmp_path / "out")
    sinks.publish(spark.createDataFrame([row("a", 1.0), row("b", 2.0)], schema), path)
    before = sinks.published(spark, path)
    out = sinks.publish(spark.createDataFrame([row("a", 3.0)], schema), path)
    assert sorted(r.value for r in out.collect()) == [2.0, 3.0] and out.columns == ["exp", "wcombo", "layer", "idom", "jdom", "value"]
    assert sorted(r.value for r in before.collect()) == [1.0, 2.0]  # a reader that began before still sees the old ones
    # a write that failed before its last row is not seen
    spark.createDataFrame([("e", "w", "a", 1, 1, 9.0)], schema).write.partitionBy(*sinks.PUBLISH_KEYS).parquet(f"{path}/data/version=lost")
    assert sorted(r.value for r in sinks.published(spark, path).collect()) == [2.0, 3.0]
    sinks.publish(spark.createDataFrame([row("b", 4.0), row("001", 5.0), row("skipped", 6.0)], schema), path, skip=("skipped",))
    now = sinks.published(spark, path)
    assert sorted((r.layer, r.value) for r in now.collect()) == [("001", 5.0), ("a", 3.0), ("b", 4.0)]
    assert sinks.drop_unpublished(spark, path) == 1 and now.count() == 3


def test_registered_variables(spark):
    from firngrid.operators import stats

    stats.register_variable("depth", F.col("swe"), F.lit(200.0))
    rows = spark.createDataFrame([("a", 400.0), ("a", 0.0)], "k string, swe double")
    assert stats.variable_statistics(rows, ["k"], ["depth"]).first().depth == 1.0


def test_experiment_hooks(spark):
    own = catalog.Experiment("ak", ("era", "forest"), mosaic_filter=lambda df: df.where("n > 1"), sizes=pra.SIZES_RUN)
    assert own.mosaic_filter(spark.range(4).toDF("n")).count() == 2 and set(own.sizes) == {"For", "NoFor"}


def test_order_weights_are_the_published_ones():
    # fixed values: best linear weights for two, three and four values, smallest first
    location = {2: [0.916373, 0.083627], 3: [0.656320, 0.255714, 0.087966], 4: [0.510998, 0.263943, 0.153680, 0.071380]}
    scale = {2: [-0.721348, 0.721348], 3: [-0.630541, 0.255816, 0.374725], 4: [-0.558619, 0.085903, 0.223919, 0.248797]}
    for n in location:
        a, b = zip(*climate.order_weights(n), strict=True)
        assert np.allclose(a, location[n], atol=2e-6) and np.allclose(b, scale[n], atol=2e-6)
    a, b = np.array(climate.order_weights(80)).T
    assert abs(a.sum() - 1) < 1e-6 and abs(b.sum()) < 1e-6


def test_order_fit(spark):
    rng = np.random.default_rng(3)
    cells = {1: [0.0, 0.0, 0.0], 2: [5.0], 3: [4.0, 4.0], 4: [3.0, None, 7.0], 5: rng.gumbel(50, 8, 60).tolist(), 6: [9.0, 1.0, 4.0]}
    frame = spark.createDataFrame([(c, v) for c, vs in cells.items() for v in vs], "cell long, v double")
    found = {r.cell: (r.loc, r.scale, r.shape) for r in climate.order_fit(frame).collect()}
    assert found[1] == (0.0, 0.0, 0.0) and found[2] == found[3] == (None, None, None)
    for cell in (4, 5, 6):
        v = np.sort([x for x in cells[cell] if x is not None])
        assert np.allclose(found[cell], [*(np.array(climate.order_weights(len(v))).T @ v), 0.0])
    assert abs(found[5][0] - 50) < 4 and abs(found[5][1] - 8) < 3
    assert climate.order_fit(frame.limit(0)).count() == 0


def test_spiral_numbers_beyond_an_int(spark):
    at = spark.createDataFrame([(0, 24_000), (-24_000, 3), (5, -30_000)], "i int, j int")
    x, y = G.spiral_cell(G.spiral_number(F.col("i"), F.col("j")))
    assert at.where((x != F.col("i")) | (y != F.col("j"))).count() == 0
    far = at.select(G.absolute_neighbour(F.lit(0), G.relative_neighbour(F.lit(0), F.lit(1_200_007), 50), 50).alias("back"))
    assert far.first().back == 1_200_007


def test_long_ids_stay_whole_in_archive_names(spark, data, tmp_path):
    rows = spark.read.parquet(f"{data}/lineitem.parquet").limit(5).withColumn("l_orderkey", F.lit(8_999_999).cast("long"))
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    from firngrid.plans.queries import QUERIES

    assert {r.id for r in QUERIES["s_07_archive_names"](spark, str(tmp_path)).collect()} == {8_999_999}


def test_republish_shuffles_no_rows_of_a_table(spark):
    layers = spark.range(100).selectExpr("'ak' as exp", "if(id % 9 = 0, 'b', 'a') as wcombo", "'depo' as layer", "id")
    found = sinks.republish(layers, layers.select("exp", "wcombo").where("wcombo = 'a'").distinct().hint("merge"), ["depo"])
    assert found.count() == 88
    assert "BroadcastHashJoin" in found._jdf.queryExecution().toString()


def test_series_are_fitted_many_at_a_time(spark):
    rng = np.random.default_rng(8)
    series = {k: rng.gumbel(100, 20, 5 + k % 3) for k in range(40)}
    rows = [(k, float(v)) for k, x in series.items() for v in x] + [(50, None), (50, 1.0), (50, 2.0), (50, 4.0)]
    fitted = climate.likelihood_fit(spark.createDataFrame(rows, "cell long, v double"))
    assert "FlatMapGroupsInPandas" not in fitted._jdf.queryExecution().toString()
    found = {r.cell: r for r in fitted.collect()}
    assert found[50]["scale"] is None
    for k, x in series.items():
        own = np.array([[found[k]["loc"], math.log(found[k]["scale"]), found[k]["shape"]]])
        best = climate._log_likelihoods(own, x[None])[0]
        near = [climate._log_likelihoods(own + d, x[None])[0] for d in np.diag([0.5, 0.02, 0.02])]
        assert all(best <= v + 1e-4 for v in near)


def test_wide_boxes_are_not_shuffled_by_bins(spark):
    tiles_ = spark.range(60).selectExpr("id", "id % 6 * 10.0D as x0", "id div 6 * 10.0D as y0", "id % 6 * 10.0D + 10 as x1", "id div 6 * 10.0D + 10 as y1").distinct().hint("merge")
    wide = spark.createDataFrame([(1, 0.0, 0.0, 59.0, 99.0), (2, 20.0, 20.0, 20.0, 20.0)], "k long, x0 double, y0 double, x1 double, y1 double")
    met = catalog.box_join(wide, tiles_, 10.0)
    assert "BroadcastHashJoin" in met._jdf.queryExecution().toString()
    assert {r.k: r.n for r in met.groupBy("k").agg(F.count("*").alias("n")).collect()} == {1: 60, 2: 4}


def test_cells_of_a_runout_in_both_forms():
    for places in ({3}, set(range(0, 4096, 2)), set(range(100)), set(range(127)), set(range(128)), set(range(129)), {4095}):
        assert set(flow._places(flow._row_of(places, 4096), 4096).tolist()) == places
    assert len(flow._row_of({1, 4000}, 4096)) == 8 and len(flow._row_of(set(range(4096)), 4096)) == 512


def test_runout_broadcasts_no_cells_or_areas(spark):
    cells = spark.range(400).selectExpr("id as cell", "cast(id % 20 as int) as i", "cast(id div 20 as int) as j", "cast(id as double) as h")
    found = flow.runout(spark.createDataFrame([(1, 205)], "pra_id long, cell long"), cells, "h", 10.0)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" not in flow.lowest_edges(cells, "h")._jdf.queryExecution().toString()


def test_paths_in_circles_are_written_once(spark, monkeypatch):
    written = []
    kept = flow.grown

    def counted(df, name, table=None):
        written.append(df.count())
        return kept(df, name, table)

    monkeypatch.setattr(flow, "grown", counted)
    edges = spark.createDataFrame([(k, (k + 1) % 3) for k in range(3)] + [(k, k - 1) for k in range(3, 12)] + [(20, -1)], "cell long, next_cell long")
    found = flow.reachable(edges.select(F.col("cell").alias("root"), "cell"), edges)
    expected = {(r, c) for r in range(12) for c in range(max(r, 2) + 1)} | {(20, 20)}
    assert {(r.root, r.cell) for r in found.collect()} == expected
    assert sum(written) == len(expected)


def test_outline_rings_across_tiles(spark):
    rng = random.Random(5)
    rows = sorted({(k, rng.randrange(-9, 12), rng.randrange(-9, 12)) for k in (1, 2) for _ in range(160)})
    cells = spark.createDataFrame(rows, "id long, i int, j int")
    rings = flow.outline_rings(cells, "id", 4).collect()
    sides = []
    for r in rings:
        points = list(zip(r.points[::2], r.points[1::2]))
        sides += [(r.id, *p, *q) for p, q in zip(points, points[1:] + points[:1])]
    assert sorted(sides) == sorted(tuple(r) for r in flow.outline_edges(cells, "id").collect())
    assert len({(r.id, r.ring) for r in rings}) == len(rings)
    whole = flow.outline_rings(cells, "id", 64)
    assert sorted((r.id, r.ring, len(r.points)) for r in rings) == sorted((r.id, r.ring, len(r.points)) for r in whole.collect())
    assert "collect_list" not in whole._jdf.queryExecution().toString()


def test_published_tiles_are_no_folders(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(400).selectExpr("'ak' as exp", "'past-30' as wcombo", "element_at(array('depo', 'height'), cast(id % 2 + 1 as int)) as layer", "cast(id % 10 as int) as idom", "cast(id div 10 as int) as jdom", "cast(id as double) as value")
    out = sinks.publish(rows, path)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, rows.collect()))
    folders = {f.parent for f in (tmp_path / "out" / "data").rglob("*.parquet")}
    assert len(folders) == 2 and {f.name for f in folders} == {"layer=depo", "layer=height"}
    assert len(list((tmp_path / "out" / "data").rglob("*.parquet"))) <= 8
    sinks.publish(rows.where("idom = 3 and layer = 'height'").withColumn("value", F.lit(-1.0)), path)  # one layer of some tiles anew
    now = sinks.published(spark, path)
    assert now.count() == 400 and now.where("value = -1").count() == rows.where("idom = 3 and layer = 'height'").count() > 0


def test_areas_of_many_pairs_are_found_together(monkeypatch):
    rng = random.Random(4)
    asked = []
    of_pairs = vector._areas
    monkeypatch.setattr(vector, "_areas", lambda p, q: asked.append(len(p)) or of_pairs(p, q))
    ring = lambda *c: np.array([v for a, b in zip(c, c[1:] + c[:1]) for v in (*a, *b)])
    box = lambda x, y, w, h: ring((x, y), (x + w, y), (x + w, y + h), (x, y + h))
    # a box but for its upper right quarter
    bent = lambda x, y, w, h: ring((x, y), (x + w, y), (x + w, y + h / 2), (x + w / 2, y + h / 2), (x + w / 2, y + h), (x, y + h))
    boxes = [[rng.randrange(1, 9) for _ in range(8)] for _ in range(3000)]
    p, q = pd.Series([(bent if k % 2 else box)(*b[:4]) for k, b in enumerate(boxes)]), pd.Series([box(*b[4:]) for b in boxes])
    found = vector._areas_of_all(p, q).T
    assert sum(asked) == 3000 and len(asked) <= 4
    shared = lambda x, y, w, h, u, v, a, b: max(min(x + w, u + a) - max(x, u), 0) * max(min(y + h, v + b) - max(y, v), 0)
    for k, (x, y, w, h, *other) in enumerate(boxes):
        cut = shared(x + w / 2, y + h / 2, w / 2, h / 2, *other) if k % 2 else 0
        assert found[k] == pytest.approx([w * h * (0.75 if k % 2 else 1), other[2] * other[3], shared(x, y, w, h, *other) - cut])
    assert vector._areas_of_all(p[:0], q[:0]).shape == (3, 0)


@pytest.mark.parametrize("passes", [24, 1])
def test_hulls_of_many_sets_are_found_together(monkeypatch, passes):
    monkeypatch.setattr(vector, "CHAIN_PASSES", passes)
    rng = random.Random(6)
    sets = [[(float(rng.randrange(m)), float(rng.randrange(m))) for _ in range(rng.randrange(8, 60))] for m in (3, 5, 40) for _ in range(60)]
    sets.append([(float(t), float(t * t)) for t in range(60)] + [(61.0, -1e6)])  # each corner goes by the one after it
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    x, y = np.array([p for s in sets for p in s]).T
    at, hx, hy = vector._hulls(of, x, y)
    for k, points in enumerate(sets):
        ordered = sorted(set(points))
        if len({p[0] for p in ordered}) < 2 or len({p[1] for p in ordered}) < 2:
            continue
        expected = vector._half(ordered)[:-1] + vector._half(ordered[::-1])[:-1]
        assert list(zip(hx[at == k].tolist(), hy[at == k].tolist())) == expected


def test_the_status_table_needs_no_state_of_the_stream(spark):
    from pathlib import Path

    rows = _status_rows(spark, [(1, 0, 5, 2), (2, 0, 6, 5)])
    source, out = sinks.scratch(rows, "status"), sinks.scratch(rows, "latest")
    for more in (rows, _status_rows(spark, [(1, 0, 4, 6), (3, 0, 3, 6)]), _status_rows(spark, [(2, 0, 4, 6), (1, 0, 7, 6)])):
        more.coalesce(1).write.mode("append").parquet(source)
        found = streams.latest_status_table(streams.files(spark, source, rows.schema), "2 days", out)
    assert {(r.id, r.id_status) for r in found.collect()} == {(1, 6), (2, 5)}  # the row of day 3 comes too late
    log = Path(f"{out}-log".removeprefix("file://"))
    assert (log / "commits").is_dir() and not (log / "state").exists()


def test_long_holes_settle_in_few_rounds(spark):
    values = {(i, j): 10.0 * i + (i * 7 + j * 3) % 5 if j < 3 else None for i in range(12) for j in range(50)}
    cells = spark.createDataFrame([(i, j, v) for (i, j), v in values.items()], "i int, j int, v double")
    found = {(r.i, r.j): r.x for r in relax.relaxed(relax.hole_system(cells, "v"), 1e-9, 8, margin=1, max_rounds=45).collect()}
    exact = _relaxed(values)
    assert found.keys() == exact.keys() and max(abs(found[k] - v) for k, v in exact.items()) < 1e-5
    weights = relax._mixture(np.array([[4.0, -4.0], [-4.0, 4.0]]))  # of two opposite vectors
    assert weights == pytest.approx([0.5, 0.5]) and relax._mixture(np.array([[0.0]])).tolist() == [1.0]


def test_nearest_deals_its_pairs_to_as_many_tasks_as_there_are_points(spark, monkeypatch):
    monkeypatch.setattr(vector, "NEAREST_POINTS", 100)
    cells = [(c, c % 40, c // 40) for c in range(1600)]
    spots = [(i, j) for _, i, j in cells if (3 * i + 5 * j) % 11 == 0 and j < 20]
    points = spark.createDataFrame(cells, "cell long, i int, j int").coalesce(1)
    found = vector.nearest(points, spark.createDataFrame(spots, "i int, j int").coalesce(1), 4, 4)
    assert found.rdd.getNumPartitions() >= 16  # one file of points was one task
    near = {}
    for cell, distance in found.collect():
        near.setdefault(cell, []).append(distance)
    for c, i, j in cells:
        assert sorted(near[c]) == pytest.approx(sorted(math.hypot(i - a, j - b) for a, b in spots)[:4])


def test_overrun_edges_are_found_without_sending_cells_around(spark):
    rng = random.Random(8)
    own = {(g, i, j) for g in (1, 2) for i in range(-3, 12) for j in range(9) if rng.random() < 0.75}
    out = {(i, j) for i in range(-4, 13) for j in range(-1, 10) if rng.random() < 0.05}
    cells = spark.createDataFrame([(g, 100 * j + i, i, j) for g, i, j in own], "g long, cell long, i int, j int")
    edge = flow.overrun_edge(cells, "g", spark.createDataFrame(list(out), "i int, j int"))
    beside = lambda i, j: [(i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)]
    expected = {(g, i, j) for g, i, j in own if any((g, *b) not in own for b in beside(i, j)) and not any(b in out for b in beside(i, j))}
    assert sorted((r.g, r.i, r.j) for r in edge.collect()) == sorted(expected)
    plan = edge._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1  # of the cells masked out alone


def test_avalanche_cells_are_grouped_in_tasks_of_bounded_size(spark, data, monkeypatch):
    from firngrid.plans.fixtures import Fixtures
    from firngrid.sources import shared

    monkeypatch.setattr(shared, "TASK_ROWS", 500)
    cells = Fixtures(spark, data).aval
    rows = spark.read.parquet(f"{data}/lineitem.parquet").select("l_orderkey", "l_partkey")
    assert cells.rdd.getNumPartitions() >= rows.count() // 500
    assert cells.count() == rows.distinct().count()
    assert max(cells.groupBy(F.spark_partition_id()).count().select("count").toPandas()["count"]) <= 1000


@pytest.mark.parametrize("turned", [False, True])
@pytest.mark.parametrize("small_side", [200_000, 40])
def test_tall_boxes_meet_others_by_few_pieces(spark, monkeypatch, turned, small_side):
    monkeypatch.setattr(catalog, "SMALL_SIDE", small_side)
    rng = random.Random(11)
    box = lambda x, y, w, h: tuple(map(float, (x, y, x + w, y + h)))
    rows = [box(rng.uniform(-30, 30), rng.uniform(-3000, 3000), rng.choice([0, 0.5, 7, 20]), rng.choice([0, 3, 15, 900, 4000])) for _ in range(250)]
    boxes = [box(rng.uniform(-30, 30), rng.uniform(-3000, 3000), rng.choice([0, 1, 12]), rng.choice([0, 1, 25])) for _ in range(60)]
    rows += [box(0, 0, 10, 100), box(0, 0, 0, 5000)]
    boxes += [box(10, 100, 4, 1), box(-1, 5000, 1, 0)]  # they touch by a corner and by an end
    turn = (lambda b: (b[1], b[0], b[3], b[2])) if turned else (lambda b: b)
    names = "x0 double, y0 double, x1 double, y1 double"
    left = spark.createDataFrame([(k, *turn(b)) for k, b in enumerate(rows)], f"id long, {names}")
    right = spark.createDataFrame([turn(b) for b in boxes], names)
    found = catalog.boxes_met(left, ["id"], right, 10.0)
    touch = lambda a, b: a[0] <= b[2] and b[0] <= a[2] and a[1] <= b[3] and b[1] <= a[3]
    assert sorted(r.id for r in found.collect()) == [k for k, a in enumerate(rows) if any(touch(a, b) for b in boxes)]
    assert catalog.boxes_met(left.limit(0), ["id"], right, 10.0).count() == catalog.boxes_met(left, ["id"], right.limit(0), 10.0).count() == 0
    pieces = spark.range(1).select(F.inline(catalog._filling(F.lit(-1234), F.lit(98_765)))).collect()
    assert len(pieces) < 40 and sorted(n for p in pieces for n in range(p.at << p.level, (p.at + 1) << p.level)) == list(range(-1234, 98_766))


def test_neighbours_are_dealt_in_bounded_tasks(spark, monkeypatch):
    from firngrid.sources import shared

    monkeypatch.setattr(shared, "TASK_ROWS", 500)
    n = 40
    cells = spark.range(n * n).selectExpr("id as cell", f"cast(id % {n} as int) as i", f"cast(id div {n} as int) as j", "cast((id * 7919) % 101 as double) as z")
    near = flow.neighbours(cells, ["z"])
    sizes = near.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 4 * (n - 1) * (2 * n - 1) and len(sizes) > 20 and max(sizes) < 2000
    z = {r.cell: r.z for r in cells.collect()}
    around = {c: [d for d in z if d != c and abs(d % n - c % n) <= 1 and abs(d // n - c // n) <= 1] for c in (0, 39, 777, 1599)}
    lowest = {r.cell: r.lowest for r in flow.lowest_neighbour(cells, "z").collect()}
    assert len(lowest) == n * n and all(lowest[c] == min(d, key=lambda k: (z[k], k)) for c, d in around.items())


def test_joins_of_flow_edges_are_dealt_in_bounded_tasks(spark, toy, monkeypatch):
    from firngrid.sources import shared

    monkeypatch.setattr(shared, "TASK_ROWS", 50)
    known = toy.where("z is not null")
    plan = flow.flow_edges(known, "z", flow.edge_cells(known, "z"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(f", {known.count() * 8 // 50 + 1}\n") == 6  # neighbours, their flats, and those of the others


def test_long_holes_are_solved_without_rounds(spark, monkeypatch):
    rng = random.Random(5)
    values = {(i, j): 5e5 + 1e4 * rng.random() if j < -20 or rng.random() < 0.02 else None for i in range(-3, 9) for j in range(-25, 30) if (i, j) != (2, 10)}
    cells = spark.createDataFrame([(i, j, v) for (i, j), v in values.items()], "i int, j int, v double")
    exact = _relaxed(values)
    system = relax.hole_system(cells, "v").localCheckpoint()
    for hand, rounds in ((128, False), (3, True)):
        monkeypatch.setattr(relax, "AT_HAND", hand)
        found = relax.solved(system, 4)
        assert (found is None) == rounds
        if not rounds:
            found = {(r.i, r.j): r.x for r in found.collect()}
            assert found.keys() == exact.keys() and max(abs(found[k] - v) for k, v in exact.items()) < 1e-7
    monkeypatch.setattr(relax, "AT_HAND", 4_096)
    monkeypatch.setattr(relax, "relaxed", None)  # no rounds
    found = {(r.i, r.j): r.v for r in relax.filled(cells, "v", 1e-9).collect()}
    assert found.keys() == values.keys() and max(abs(found[k] - v) for k, v in exact.items()) < 1e-7


def test_holes_too_wide_for_a_task_are_relaxed(spark, monkeypatch):
    values = {(i, j): float(i * j) if i in (0, 15) or j == 0 else None for i in range(16) for j in range(20)}
    cells = spark.createDataFrame([(i, j, v) for (i, j), v in values.items()], "i int, j int, v double")
    monkeypatch.setattr(relax, "AT_HAND", 20)
    found = {(r.i, r.j): r.v for r in relax.filled(cells, "v", 1e-6, 8).collect()}
    assert max(abs(found[k] - v) for k, v in _relaxed(values).items()) < 1e-3


@pytest.mark.parametrize("small_side", [200_000, 40, 0])
def test_boxes_meet_once_in_blocks(spark, monkeypatch, small_side):
    monkeypatch.setattr(catalog, "SMALL_SIDE", small_side)
    rng = random.Random(2)

    def boxes(n):
        spots = [(rng.randrange(-300, 300) / 2.0, rng.randrange(-90, 90) / 2.0) for _ in range(n)]
        return [(k, x, y, x + rng.choice([0.0, 1.0, 10.0, 35.5, 250.0]), y + rng.choice([0.0, 0.5, 10.0, 120.0])) for k, (x, y) in enumerate(spots)] + [(n, None, 0.0, 1.0, 1.0), (n + 1, 0.0, 0.0, 1.0, None)]

    few, many = boxes(30), boxes(60)
    frame = lambda rows, key: spark.createDataFrame(rows, f"{key} long, x0 double, y0 double, x1 double, y1 double")
    known = lambda rows: [r for r in rows if None not in r]
    touch = lambda a, b: a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]
    for a, b in ((few, many), (many, few)):
        expected = sorted((p[0], q[0]) for p in known(a) for q in known(b) if touch(p, q))
        met = catalog.box_join(frame(a, "k"), frame(b, "m"), 10.0)
        assert met.columns == ["k", "x0", "y0", "x1", "y1", "m"]
        assert sorted((r.k, r.m) for r in met.collect()) == expected
    assert catalog.box_join(frame(few, "k"), frame(few[-2:], "m"), 10.0).count() == 0
    assert catalog.box_join(frame(few, "k"), frame(few, "m").limit(0), 10.0).count() == 0


def test_boxes_much_wider_than_bins_meet(spark):
    wide = spark.createDataFrame([(1, -1e12, -1e12, 1e12, 1e12), (2, 0.0, 0.0, 5.0, 5.0)], "k long, x0 double, y0 double, x1 double, y1 double")
    spots = spark.createDataFrame([(1, 4.0, 4.0, 6.0, 6.0), (2, 9e11, 0.0, 9e11, 0.0), (3, -2e12, 0.0, 2e12, 1.0)], "m long, x0 double, y0 double, x1 double, y1 double")
    found = {(r.k, r.m) for r in catalog.box_join(wide, spots, 10.0).collect()}
    assert found == {(1, 1), (1, 2), (1, 3), (2, 1), (2, 3)}
