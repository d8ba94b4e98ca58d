"""Queries on flow, outlines, polygons and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from firngrid.functions import grid as G
from firngrid.operators import flow, raster, vector
from firngrid.plans.registry import query
from firngrid.sources import blobs
from firngrid.sources.sinks import scratch
from firngrid.streaming import streams

_TERRACE = """
t as (select cell, i, j, floor(elev / 50) * 50 as z from fx_dem where landcover <> 11),
nb as (select a.cell, b.cell as other, b.z, a.z as own from t a join t b on abs(a.i - b.i) <= 1 and abs(a.j - b.j) <= 1 and a.cell <> b.cell),
ed as (select cell from t where cell not in (select cell from nb group by 1 having count(*) = 8))
"""


def _terraces(fx):
    return fx.dem.where("landcover <> 11").select("cell", "i", "j", (F.floor(F.col("elev") / 50) * 50).cast("double").alias("z"))


@query("g_01_spill_levels", "dem", _TERRACE + """
, lv as (select distinct z as level from t),
r(level, cell) as (select level, cell from lv, ed join t using (cell) where z <= level union select r.level, nb.cell from r join nb on nb.other = r.cell where nb.own <= r.level)
select cell, min(level) as spill from r group by 1""")
def spill_levels(fx):
    return flow.spill_levels(_terraces(fx), "z").select("cell", "spill")


_FLATS = _TERRACE + """
, fr(cell, reached) as (select cell, cell from t union select fr.cell, nb.other from fr join nb on nb.cell = fr.reached where nb.z = nb.own),
fl as (select cell, min(reached) as flat from fr group by 1)
"""


@query("g_02_flat_classes", "dem", _FLATS + "select cell, flat from fl")
def flat_classes(fx):
    return flow.flat_classes(_terraces(fx), "z")


_EDGES = _FLATS + """
, ex as (select a.flat, b.flat as exit, row_number() over (partition by a.flat order by nb.z, nb.other) as k from nb join fl a on a.cell = nb.cell join fl b on b.cell = nb.other where a.flat <> b.flat),
lf as (select distinct flat from fl join ed using (cell)),
fe as (select fl.cell, cast(coalesce(lead(fl.cell) over (partition by fl.flat order by fl.cell), case when lf.flat is not null then -1 else coalesce(exit, -1) end) as bigint) as next_cell
  from fl left join (select flat, exit from ex where k = 1) x using (flat) left join lf on lf.flat = fl.flat)
"""


@query("g_03_flow_edges", "dem", _EDGES + "select cell, next_cell from fe")
def flow_edges(fx):
    cells = _terraces(fx)
    return flow.flow_edges(cells, "z", flow.edge_cells(cells, "z"))


_RUNOUT = """
t as (select cell, i, j, case when landcover <> 11 then elev end as h, greatest(case when landcover <> 11 then elev else 0 end, 0) as z from fx_dem),
nb as (select a.cell, b.cell as other, b.z, min(b.z) over (partition by a.cell) as least, count(*) over (partition by a.cell) as n from t a join t b on abs(a.i - b.i) <= 1 and abs(a.j - b.j) <= 1 and a.cell <> b.cell),
le as (select cell, other from nb join t using (cell) where nb.z = least and least <= t.z),
bad as (select cell from t where h is null union select cell from nb where n < 8),
p as (select id, cell as c0, i as i0, j as j0, h as h0 from fx_pra join t using (cell)),
r(id, cell) as (select id, cell from fx_pra union select r.id, le.other from r join p using (id) join t on t.cell = r.cell join le on le.cell = r.cell
  where r.cell = c0 or (10 * sqrt((i - i0) ** 2 + (j - j0) ** 2) <= 10000 and h0 - coalesce(h, 0) >= tan(radians(18)) * 10 * sqrt((i - i0) ** 2 + (j - j0) ** 2))),
ro as (select id as pra_id, cell from r where id not in (select id from r join bad using (cell)))
"""


def _rectangle_sql(key: str, src: str) -> str:
    """The area of the least rectangle around the cells of each key of ``src``."""
    return f"""
re as (select {key}, j, min(i) as a, max(i) + 1 as b from {src} group by 1, 2),
rc as (select distinct {key}, x::double as x, (j + d)::double as y from (select {key}, j, unnest([a, b]) as x from re), (values (0), (1)) d(d)),
rl as (select {key}, y, min(x) as x0, max(x) as x1 from rc group by 1, 2),
rp as (select distinct {key}, unnest([x0, x1]) as x, y from rl),
rt as (select distinct {key}, round(a - floor(a / (pi() / 2)) * (pi() / 2), 12) as t from (select p.{key}, atan2(q.y - p.y, q.x - p.x) as a from rp p join rp q on q.{key} = p.{key} and (q.x, q.y) <> (p.x, p.y))),
rf as (select {key}, t, (max(x * cos(t) + y * sin(t)) - min(x * cos(t) + y * sin(t))) * (max(y * cos(t) - x * sin(t)) - min(y * cos(t) - x * sin(t))) as area from rt join rp using ({key}) group by 1, 2)
select {key}, round(min(area), 4) as area from rf group by 1"""


@query("g_04_runout", "dem pra", _RUNOUT + "select pra_id, cell from ro")
def runout(fx):
    cells = fx.dem.select("cell", "i", "j", F.when(F.col("landcover") != 11, F.col("elev")).alias("h"))
    return flow.runout(fx.pra.select(F.col("id").alias("pra_id"), "cell"), cells, "h", 10.0)


_GROUPS = "k as (select distinct aval_id % 200 as grp, cell, i, j from fx_aval where max_height > 0.25 and max_vel > 1)"


def _groups(fx):
    hit = fx.aval.where(raster.extent_predicates()["christen"])
    return hit.select((F.col("aval_id") % 200).alias("grp"), "cell", "i", "j").distinct()


_PARTS = _GROUPS + """,
b as (select x.grp, x.cell, y.cell as other from k x join k y on x.grp = y.grp and abs(x.i - y.i) + abs(x.j - y.j) = 1),
pr(grp, cell, reached) as (select grp, cell, cell from k union select pr.grp, pr.cell, b.other from pr join b on b.grp = pr.grp and b.cell = pr.reached),
pt as (select grp, cell, min(reached) as part from pr group by 1, 2)
"""


@query("g_05_extent_parts", "aval", _PARTS + "select grp, cell, part from pt")
def extent_parts(fx):
    return flow.extent_parts(_groups(fx), "grp")


_SIDES = _GROUPS + """,
s as (select grp, i as x0, j as y0, i + 1 as x1, j as y1 from k union all select grp, i + 1, j, i + 1, j + 1 from k union all select grp, i + 1, j + 1, i, j + 1 from k union all select grp, i, j + 1, i, j from k)
"""


_USED_ONCE = ", u as (select *, count(*) over (partition by grp, least(x0, x1), least(y0, y1), greatest(x0, x1), greatest(y0, y1)) as n from s)\n"


@query("g_06_outline_edges", "aval", _SIDES + _USED_ONCE + "select grp, x0, y0, x1, y1 from u where n = 1")
def outline_edges(fx):
    return flow.outline_edges(_groups(fx), "grp")


@query("g_06_outline_lengths", "aval", _SIDES + _USED_ONCE + "select grp, count(*) as length from u where n = 1 group by 1")
def outline_lengths(fx):
    rings = flow.outline_rings(_groups(fx), "grp")
    return rings.groupBy("grp").agg(F.sum(F.size("points") / 2).cast("long").alias("length"))


_EDGE = _GROUPS + """,
o as (select i, j from fx_dem where landcover = 11),
oe as (select * from k where (select count(*) from k y where y.grp = k.grp and abs(y.i - k.i) + abs(y.j - k.j) = 1) < 4 and not exists (select 1 from o where abs(o.i - k.i) + abs(o.j - k.j) = 1))
"""


@query("g_07_overrun_edge", "aval dem", _EDGE + "select grp, cell from oe")
def overrun_edge(fx):
    return flow.overrun_edge(_groups(fx), "grp", fx.dem.where("landcover = 11")).select("grp", "cell")


@query("g_08_overrun_test", "aval dem", _EDGE + """,
f as (select grp, bool_or(cell % 3 > 0) as flowing from oe group by 1), g as (select distinct grp from k)
select grp, grp % 2 = 0 and (grp % 5 = 0 or (coalesce(flowing, false) and not grp % 3 = 0)) as overran from g left join f using (grp)""")
def overrun_test(fx):
    cells = _groups(fx)
    edge = flow.overrun_edge(cells, "grp", fx.dem.where("landcover = 11"))
    g = F.col("grp")
    runs = cells.select("grp").distinct().select("grp", (g % 2 == 0).alias("reported"), (g % 3 == 0).alias("low_flux"), (g % 5 != 0).alias("has_mask"))
    return flow.overruns(edge, runs, "grp", F.col("cell") % 3)


@query("g_09_reachable", "dem", _EDGES + """,
w(root, cell) as (select cell, cell from t union select w.root, fe.next_cell from w join fe on fe.cell = w.cell where fe.next_cell >= 0)
select root, cell from w""")
def reachable(fx):
    cells = _terraces(fx)
    edges = flow.flow_edges(cells, "z", flow.edge_cells(cells, "z"))
    return flow.reachable(cells.select(F.col("cell").alias("root"), "cell"), edges)


@query("a_28_dissolved_extents", "aval", """
k as (select distinct cell, i, j from fx_aval where max_height > 0.85 and max_vel > 45), b as (select x.cell, y.cell as other from k x join k y on abs(x.i - y.i) + abs(x.j - y.j) = 1),
r(cell, reached) as (select cell, cell from k union select r.cell, b.other from r join b on b.cell = r.reached)
select cell, min(reached) as part from r group by 1""")
def dissolved_extents(fx):
    cells = fx.aval.where("max_height > 0.85 and max_vel > 45").select("cell", "i", "j").distinct().withColumn("one", F.lit(0).cast("long"))
    return flow.extent_parts(cells, "one").select("cell", "part")


def _corner_ring(fx, dx: float, dy: float):
    """A box without its upper right quarter: a concave ring."""
    x0, y0, x1, y1 = F.col("x0") + dx, F.col("y0") + dy, F.col("x1") + dx, F.col("y1") + dy
    xm, ym = (x0 + x1) / 2, (y0 + y1) / 2
    return fx.boxes.select("aval_id", G.points((x0, y0), (x1, y0), (x1, ym), (xm, ym), (xm, y1), (x0, y1)).alias("ring"))


@query("j_08_burn", "boxes", """
p as (select aval_id, x0, y0, a, b, a + 0.5::double as x, b + 0.5::double as y from fx_boxes, (select unnest(range(-3, 6)) as a), (select unnest(range(-3, 6)) as b))
select aval_id, count(*) as n, cast(sum(x0 + a) as bigint) as sum_i from p
where 3.2 * y - 1.1 * x > 0 and -1.1 * (y - 1.1) - 3.2 * (x - 3.2) > 0 and -3.2 * (y - 4.3) + 1.1 * (x - 2.1) > 0 and 1.1 * (y - 3.2) + 3.2 * (x + 1.1) > 0 group by 1""")
def burn(fx):
    x, y = F.col("x0"), F.col("y0")
    turned = G.points((x, y), (x + 3.2, y + 1.1), (x + 2.1, y + 4.3), (x - 1.1, y + 3.2))  # a square that is not parallel to the axes
    cells = vector.burn(fx.boxes.select("aval_id", turned.alias("ring")), "aval_id")
    return cells.groupBy("aval_id").agg(F.count("*").alias("n"), F.sum("i").cast("long").alias("sum_i"))


@query("j_19_overlap_area", "boxes", """
h as (select aval_id, x0, y0, x1, y1, (x0 + x1) / 2 as xm, (y0 + y1) / 2 as ym from fx_boxes),
p as (select aval_id, x0 as a, y0 as b, x1 as c, ym as d from h union all select aval_id, x0, ym, xm, y1 from h),
o as (select aval_id, sum(greatest(least(p.c, q.c + 3) - greatest(p.a, q.a + 3), 0) * greatest(least(p.d, q.d + 2) - greatest(p.b, q.b + 2), 0)) as shared from p join p q using (aval_id) group by 1),
s as (select aval_id, sum((c - a) * (d - b)) as area from p group by 1)
select aval_id, round(area, 4) as area_a, round(area, 4) as area_b, round(shared, 4) as area_both from s join o using (aval_id)""")
def overlap_area(fx):
    out = vector.overlap_area(_corner_ring(fx, 0.0, 0.0), _corner_ring(fx, 3.0, 2.0), "aval_id")
    return out.select("aval_id", *[F.round(c, 4).alias(c) for c in ("area_a", "area_b", "area_both")])


#: How far a hull reaches in each of twelve directions tells it apart from any other hull of its cells.
_REACH = "max(x * cos(k * pi() / 6) + y * sin(k * pi() / 6))"


@query("v_01_convex_hulls", "aval", f"""
c as (select aval_id, i + a as x, j + b as y from fx_aval, (values (0, 0), (0, 1), (1, 0), (1, 1)) t(a, b))
select aval_id, cast(k as int) as k, round({_REACH}, 6) as reach from c, (select unnest(range(12)) as k) group by 1, 2""")
def convex_hulls(fx):
    h = vector.hulls(fx.aval, "aval_id").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(11))))
    turn = F.col("k") * F.pi() / 6
    reach = F.array_max(F.transform("ring", lambda p: p["x"] * F.cos(turn) + p["y"] * F.sin(turn)))
    return h.select("aval_id", "k", F.round(reach, 6).alias("reach"))


@query("v_02_least_rectangles", "aval", _rectangle_sql("aval_id", "fx_aval"))
def least_rectangles(fx):
    return vector.least_rectangles(vector.hulls(fx.aval, "aval_id"), "aval_id", 2.0).select("aval_id", F.round("area", 4).alias("area"))


@query("v_03_domains", "dem pra", _RUNOUT + ", rs as (select pra_id, i, j from ro join t using (cell)),\n" + _rectangle_sql("pra_id", "rs"))
def domains(fx):
    cells = fx.dem.select("cell", "i", "j", F.when(F.col("landcover") != 11, F.col("elev")).alias("h"))
    found = vector.domains(fx.pra.select(F.col("id").alias("pra_id"), "cell"), cells, "h", 10.0, 2.0)
    return found.select("pra_id", F.round("area", 4).alias("area"))


_PATHS = """,
w(root, cell) as (select cell, cell from t union select w.root, fe.next_cell from w join fe on fe.cell = w.cell where fe.next_cell >= 0)
"""


@query("v_04_buffered_paths", "dem", _EDGES + _PATHS + """,
ws as (select w.root, t.i, t.j from w join t using (cell) join t o on o.cell = w.root where greatest(abs(t.i - o.i), abs(t.j - o.j)) <= 20),
""" + _rectangle_sql("root", "ws"))
def buffered_paths(fx):
    cells = _terraces(fx)
    edges = flow.flow_edges(cells, "z", flow.edge_cells(cells, "z"))
    found = vector.buffered_paths(cells.select(F.col("cell").alias("root"), "cell"), edges, cells, 20.0, 2.0)
    return found.select("root", F.round("area", 4).alias("area"))


@query("v_06_extent_rows", "aval dem pra", _PARTS + """
select grp, count(distinct part) as n_parts, count(*) as ext_n, count(*) filter (landcover = 41) as ext_n41, count(*) filter (landcover = 42) as ext_n42, count(*) filter (landcover = 43) as ext_n43, max(area_m2) as area_m2
from pt join fx_dem using (cell) left join fx_pra p on p.id = grp group by 1""")
def extent_rows(fx):
    sizes = fx.pra.select(F.col("id").alias("grp"), "area_m2")
    return vector.extent_rows(_groups(fx), fx.dem, sizes, "grp")


@query("st_01_incremental_archive", "aval", """
select aval_id, cast(row_number() over (partition by aval_id order by cell) - 1 as int) as pos, max_vel from fx_aval""")
def incremental_archive(fx):
    packed = blobs.pack(fx.aval)
    path, archive = scratch(packed, "results"), scratch(packed, "archive")
    for part in (0, 1):  # files come in two lots, and the second run takes the second lot only
        packed.where(F.col("aval_id") % 2 == part).write.mode("append").parquet(path)
        decoded = streams.archived(streams.files(fx.spark, path, packed.schema))
        out = streams.drained(decoded, archive)
    return out.select("aval_id", "pos", F.col("max_vel").cast("double").alias("max_vel"))


def _events(fx):
    """The events as a folder of files, written in order of time."""
    rows = fx.jobs.withColumn("ts", F.col("ts").cast("timestamp")).repartitionByRange(4, "ts").sortWithinPartitions("ts")
    path = scratch(rows, "events")
    rows.write.parquet(path)
    return streams.files(fx.spark, path, rows.schema)


@query("st_02_latest_status", "status", "select id, chunkid, id_status from fx_status")
def latest_status(fx):
    return streams.latest_status_table(_events(fx), "2 days", scratch(fx.jobs, "status"))


@query("st_03_streamed_sums", "", """
select user_id as cell, cast(timestamp '2024-01-01' + interval 3 day * (datediff('day', date '2024-01-01', cast(ts as date)) // 3) as varchar) as start, round(sum(value), 4) as acsnow
from events group by 1, 2 having max(ts) is not null""")
def streamed_sums(fx):
    rows = fx.table("events").select(F.col("user_id").alias("cell"), F.col("ts").cast("timestamp").alias("ts"), "value")
    path = scratch(rows, "steps")
    # one later row without a cell, by which the last window closes
    last = rows.agg((F.max("ts") + F.expr("interval 10 days")).alias("ts")).select(F.lit(None).cast("long").alias("cell"), "ts", F.lit(0.0).alias("value"))
    rows.select(F.col("cell").cast("long").alias("cell"), "ts", F.col("value").cast("double").alias("value")).unionByName(last).repartitionByRange(4, "ts").write.parquet(path)
    sums = streams.snow_sums(streams.files(fx.spark, path, "cell long, ts timestamp, value double"), "1 day", "1 day")
    out = streams.drained(sums, scratch(rows, "sums")).where("cell is not null")
    return out.select("cell", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), F.round("acsnow", 4).alias("acsnow"))


@query("st_04_without_duplicates", "jobs", "select distinct id, chunkid from fx_jobs")
def without_duplicates(fx):
    return streams.drained(streams.without_duplicates(_events(fx), ["id", "chunkid"], "60 days"), scratch(fx.jobs, "runs")).select("id", "chunkid")
