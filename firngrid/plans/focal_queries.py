"""Queries on neighbourhoods and regridding."""

from __future__ import annotations

from pyspark.sql import functions as F

from firngrid.functions import climate as CF
from firngrid.operators import focal, raster, relax
from firngrid.plans.registry import query
from firngrid.plans.stats_queries import _MOMENTS

#: Each cell of fx_dem with the cells around it.
_NEAR = "n as (select a.cell, a.i, a.j, a.elev as own, b.i - a.i as di, b.j - a.j as dj, b.elev as z, b.landcover as lc from fx_dem a join fx_dem b on b.i between a.i - {r} and a.i + {r} and b.j between a.j - {r} and a.j + {r})"


def _near(r: int) -> str:
    return _NEAR.format(r=r)


def _r(name: str, digits: int = 6):
    return F.round(name, digits).alias(name)


def _kernel_case(kernel) -> str:
    r = len(kernel) // 2
    arms = " ".join(f"when di = {b - r} and dj = {a - r} then {float(w)}::double" for a, row in enumerate(kernel) for b, w in enumerate(row))
    return f"case {arms} end"


@query("r_00_focal_sums", "dem", _near(2) + f" select i, j, round(sum(z * {_kernel_case(focal.SMOOTHING)}), 5) as total, round(sum({_kernel_case(focal.SMOOTHING)}), 5) as weight from n group by 1, 2")
def focal_sums(fx):
    out = focal.focal_blocks(fx.dem.select("i", "j", "elev"), "elev", focal.SMOOTHING, 16)
    return out.select("i", "j", _r("total", 5), _r("weight", 5))


@query("r_01_weighted_mean", "dem", _near(2) + f""" select i, j, case when count(*) filter (lc = 11) = 0 then round(sum(z * {_kernel_case(focal.SMOOTHING)}) / sum({_kernel_case(focal.SMOOTHING)}), 6) end as elev from n group by 1, 2""")
def weighted_mean(fx):
    cells = fx.dem.withColumn("elev", F.when(F.col("landcover") != 11, F.col("elev")))
    return focal.mean(cells, "elev", focal.weighted(focal.SMOOTHING), strict=True).select("i", "j", _r("elev"))


@query("r_02_mean_3x3", "dem", _near(1) + " select i, j, round(avg(z), 6) as elev from n group by 1, 2")
def mean_3x3(fx):
    return focal.mean(fx.dem, "elev", focal.box(1)).select("i", "j", _r("elev"))


def _z(di: int, dj: int) -> str:
    return f"max(z) filter (di = {di} and dj = {dj})"


_TERRAIN = _near(1) + f""",
g as (select i, j, ({_z(1, -1)} + 2 * {_z(1, 0)} + {_z(1, 1)} - {_z(-1, -1)} - 2 * {_z(-1, 0)} - {_z(-1, 1)}) / 80 as dx,
  ({_z(-1, 1)} + 2 * {_z(0, 1)} + {_z(1, 1)} - {_z(-1, -1)} - 2 * {_z(0, -1)} - {_z(1, -1)}) / 80 as dy from n group by 1, 2),
t as (select i, j, degrees(atan(sqrt(dx * dx + dy * dy))) as slope, case when dx is null or dy is null then null when dx = 0 and dy = 0 then -1
  when degrees(atan2(-dx, dy)) < 0 then degrees(atan2(-dx, dy)) + 360 else degrees(atan2(-dx, dy)) end as aspect from g)
"""


def _terrain(fx):
    return focal.slope_aspect(fx.dem, "elev", 10.0)


@query("r_03_slope_aspect", "dem", _TERRAIN + "select i, j, round(slope, 6) as slope, round(aspect, 6) as aspect from t")
def slope_aspect(fx):
    return _terrain(fx).select("i", "j", _r("slope"), _r("aspect"))


_CURVE = _near(1) + f""",
p as (select i, j, (({_z(-1, 0)} + {_z(1, 0)}) / 2 - {_z(0, 0)}) / 100 as d, (({_z(0, -1)} + {_z(0, 1)}) / 2 - {_z(0, 0)}) / 100 as e,
  (-{_z(-1, -1)} + {_z(1, -1)} + {_z(-1, 1)} - {_z(1, 1)}) / 400 as f, ({_z(1, 0)} - {_z(-1, 0)}) / 20 as g, ({_z(0, -1)} - {_z(0, 1)}) / 20 as h from n group by 1, 2),
c as (select i, j, case when d + e + f + g + h is not null then coalesce(200 * (d * h * h + e * g * g - f * g * h) / nullif(g * g + h * h, 0), 0) end as plan,
  case when d + e + f + g + h is not null then coalesce(-200 * (d * g * g + e * h * h + f * g * h) / nullif(g * g + h * h, 0), 0) end as profile from p)
"""


@query("r_04_curvature", "dem", _CURVE + "select i, j, round(plan, 4) as plan, round(profile, 4) as profile from c")
def curvature(fx):
    return focal.curvature(fx.dem, "elev", 10.0).select("i", "j", _r("plan", 4), _r("profile", 4))


@query("r_05_rescaled", "dem", """
v as (select i, j, elev - 500 as v from fx_dem), m as (select min(v) as lo, max(v) as hi from v)
select i, j, round(case when v = 0 then 0 when v < 0 then v * (200 / -lo) else v * (200 / hi) end, 6) as v from v, m""")
def rescaled(fx):
    return focal.rescaled(fx.dem.select("i", "j", (F.col("elev") - 500).alias("v")), "v").select("i", "j", _r("v"))


@query("r_06_ruggedness", "dem", _TERRAIN + """
, u as (select i, j, case when aspect < 0 then 0 else sin(radians(aspect)) * sin(radians(slope)) end as x, case when aspect < 0 then 0 else cos(radians(aspect)) * sin(radians(slope)) end as y, cos(radians(slope)) as z from t),
s as (select a.i, a.j, sum(b.x) as x, sum(b.y) as y, sum(b.z) as z, count(b.z) as n from u a join u b on b.i between a.i - 3 and a.i + 3 and b.j between a.j - 3 and a.j + 3 group by 1, 2)
select i, j, case when n = 49 then round(100 * (1 - sqrt(x * x + y * y + z * z) / 49), 5) end as ruggedness from s""")
def ruggedness(fx):
    return focal.ruggedness(_terrain(fx)).select("i", "j", _r("ruggedness", 5))


@query("r_07_hillshade", "dem", _TERRAIN + """
select i, j, round(greatest(255 * (sin(radians(45)) * cos(radians(slope)) + cos(radians(45)) * sin(radians(slope)) * cos(radians(315) - radians(case when aspect < 0 then 0 else aspect end))), 0), 4) as shade from t where slope is not null""")
def hillshade(fx):
    return focal.hillshade(_terrain(fx).where("slope is not null")).select("i", "j", _r("shade", 4))


@query("r_07_relief", "dem", _near(1) + f"""
, g as (select i, j, ({_z(1, 0)} - {_z(-1, 0)}) / 2 as gx, ({_z(0, 1)} - {_z(0, -1)}) / 2 as gy from n group by 1, 2)
select i, j, round(sqrt(0.5::double) * sin(pi() / 2 - atan(sqrt(gx * gx + gy * gy))) + sqrt(0.5::double) * cos(pi() / 2 - atan(sqrt(gx * gx + gy * gy))) * cos(-atan2(-gy, gx)), 6) as shade from g""")
def relief(fx):
    return focal.relief(fx.dem, "elev").select("i", "j", _r("shade"))


#: Mirror images of the cells of a view beyond the border, again and again on a narrow grid.
_MIRROR = """
b{k} as (select max(i) + 1 as nx, max(j) + 1 as ny from {src}),
tu{k} as (select s, q from (values (1), (-1)) s(s), (select unnest(range(-3, 4)) as q)),
mi{k} as (select * exclude nx from (select case when s = 1 then i else -1 - i end + 2 * q * nx as i, j, {cols}, nx from {src}, b{k}, tu{k}) where i between -{r} and nx - 1 + {r}),
m{k} as (select * exclude ny from (select i, case when s = 1 then j else -1 - j end + 2 * q * ny as j, {cols}, ny from mi{k}, b{k}, tu{k}) where j between -{r} and ny - 1 + {r})
"""


@query("r_08_gradient_lapse", "dem", "src as (select i, j, elev, elev * 0.3::double + (cell % 7) * 10 as v from fx_dem)," + _MIRROR.format(k=1, src="src", cols="elev, v", r=2) + f""",
n as (select a.i, a.j, b.i - a.i as di, b.j - a.j as dj, b.elev, b.v from src a join m1 b on b.i between a.i - 2 and a.i + 2 and b.j between a.j - 2 and a.j + 2),
w as (select *, {_kernel_case(focal.GRADIENT)} as wx, {_kernel_case([list(c) for c in zip(*focal.GRADIENT)])} as wy from n),
g as (select i, j, sum(elev * wx) / 9600 as hx, sum(elev * wy) / 9600 as hy, sum(v * wx) / 9600 as tx, sum(v * wy) / 9600 as ty from w group by 1, 2)
select i, j, round((tx * hx + ty * hy) / nullif(hx * hx + hy * hy, 0), 6) as lapse from g""")  # noqa: B905
def gradient_lapse(fx):
    cells = fx.dem.select("i", "j", "elev", (F.col("elev") * 0.3 + (F.col("cell") % 7) * 10).alias("v"))
    return focal.gradient_lapse(cells, "elev", "v", 10.0).select("i", "j", _r("lapse"))


@query("r_09_difference_lapse", "dem", """
select a.i, a.j, round((e.v - w.v) / nullif(e.elev - w.elev, 0), 6) as lapse_x, round((s.v - n.v) / nullif(s.elev - n.elev, 0), 6) as lapse_y
from fx_dem a left join (select *, elev * elev as v from fx_dem) e on e.i = a.i + 1 and e.j = a.j left join (select *, elev * elev as v from fx_dem) w on w.i = a.i - 1 and w.j = a.j
left join (select *, elev * elev as v from fx_dem) s on s.i = a.i and s.j = a.j + 1 left join (select *, elev * elev as v from fx_dem) n on n.i = a.i and n.j = a.j - 1""")
def difference_lapse(fx):
    cells = fx.dem.withColumn("v", F.col("elev") * F.col("elev"))
    return focal.difference_lapse(cells, "elev", "v").select("i", "j", _r("lapse_x"), _r("lapse_y"))


def _blur_sql(name: str, src: str, band: str, sigma: float) -> str:
    """CTEs for a separable Gaussian of ``band`` of ``src``, ending in ``name``."""
    w = focal.gaussian_weights(sigma)
    r = len(w) // 2
    case = lambda d: "case abs(" + d + ") " + " ".join(f"when {k} then {w[r + k]!r}::double" for k in range(r + 1)) + " end"
    mean = f"sum({band} * w) / sum(w) filter ({band} is not null)"
    along = lambda k, a, of: f"{name}{k} as (select a.i, a.j, {mean} as {band} from (select a.i, a.j, b.{band}, {case(f'b.{a} - a.{a}')} as w from {src} a join m{of} b on b.{'j' if a == 'i' else 'i'} = a.{'j' if a == 'i' else 'i'} and b.{a} between a.{a} - {r} and a.{a} + {r}) a group by 1, 2)"
    image = lambda a, n: f"case when s = 1 then {a} else -1 - {a} end + 2 * k * {n}"
    back = lambda k, of, i, j, n, a: f"m{k} as (select * from (select {i} as i, {j} as j, {band} from {of}, (select max({a}) + 1 as n from {src}) b, (values (1), (-1)) s(s), (select unnest(range(-12, 13)) as k)) x where {a} between -{r} and (select max({a}) from {src}) + {r})"
    return (
        back(f"{name}p", src, image("i", "n"), "j", "n", "i") + "," + along("h", "i", f"{name}p") + ","
        + back(f"{name}q", f"{name}h", "i", image("j", "n"), "n", "j") + "," + along("", "j", f"{name}q")
    )


@query("r_10_blur", "dem", "src as (select i, j, elev from fx_dem)," + _blur_sql("o", "src", "elev", 2.0) + " select i, j, round(elev, 6) as elev from o")
def blur(fx):
    return focal.blur(fx.dem, "elev", 2.0).select("i", "j", _r("elev"))


@query("r_11_blur_with_holes", "dem", "src as (select i, j, case when landcover <> 11 then elev end as elev from fx_dem)," + _blur_sql("o", "src", "elev", 1.5) + " select i, j, round(elev, 6) as elev from o")
def blur_with_holes(fx):
    return focal.blur(fx.dem.withColumn("elev", F.when(F.col("landcover") != 11, F.col("elev"))), "elev", 1.5).select("i", "j", _r("elev"))


_BY_HEIGHT = """
{src},
q as (select a.i, a.j, b.v, (b.i - a.i) ** 2 * 0.25 + (b.j - a.j) ** 2 * 0.25 + ((b.h - a.h) / 150) ** 2 as q from src a join src b on b.i between a.i - 4 and a.i + 4 and b.j between a.j - 4 and a.j + 4
  where (b.i - a.i) ** 2 + (b.j - a.j) ** 2 <= 16),
s as (select i, j, sum(v * exp(-0.5 * q)) / sum(exp(-0.5 * q)) as v from q where q <= 4 group by 1, 2)
"""


@query("r_12_blur_by_height", "dem", _BY_HEIGHT.format(src="src as (select i, j, cast(cell % 10 as double) as v, elev as h from fx_dem where landcover <> 11)") + "select i, j, round(v, 6) as v from s")
def blur_by_height(fx):
    cells = fx.dem.where("landcover <> 11").select("i", "j", (F.col("cell") % 10).cast("double").alias("v"), F.col("elev").alias("h"))
    return focal.blur_by_height(cells, "v", "h", 10.0, (20.0, 20.0, 150.0)).select("i", "j", _r("v"))


@query("r_13_blur_by_levels", "dem", _BY_HEIGHT.format(src="src as (select i, j, cast(cell % 10 as double) as v, floor(elev / 75) * 75 as h from fx_dem)") + "select i, j, round(v * (select sum(v) from src) / (select sum(v) from s), 6) as v from s")
def blur_by_levels(fx):
    cells = fx.dem.select("i", "j", (F.col("cell") % 10).cast("double").alias("v"), F.col("elev").alias("h"))
    return focal.blur_by_levels(cells, "v", "h", 10.0, (20.0, 20.0, 150.0)).select("i", "j", _r("v"))


@query("r_14_nearest", "dem", "g as (select i // 4 as ci, j // 4 as cj, max(elev) as elev from fx_dem group by 1, 2) select i, j, g.elev from fx_dem d join g on ci = i // 4 and cj = j // 4")
def nearest(fx):
    return focal.spread(raster.coarsen(fx.dem, 4, [F.max("elev").alias("elev")]), fx.dem, 4, "elev")


@query("r_16_overlap_regrid", "dem", """
s as (select i, j, elev, unnest(range(cast(floor((i - 0.5) / 3) as bigint), cast(ceil((i + 0.5) / 3) as bigint))) as ti from fx_dem),
t as (select *, unnest(range(cast(floor((j - 0.5) / 3) as bigint), cast(ceil((j + 0.5) / 3) as bigint))) as tj from s),
w as (select ti, tj, elev, (least((i + 0.5) / 3, ti + 1) - greatest((i - 0.5) / 3, ti)) * (least((j + 0.5) / 3, tj + 1) - greatest((j - 0.5) / 3, tj))::double as w from t)
select cast(ti as int) as ti, cast(tj as int) as tj, round(sum(elev * w) / sum(w), 5) as elev from w group by 1, 2""")
def overlap_regrid(fx):
    return raster.overlap_regrid(fx.dem, "elev", 3.0, 0.5).select("ti", "tj", _r("elev", 5))


@query("r_17_bilinear", "dem", """
t as (select cell as key, i + 0.75::double as x, j + 0.9::double as y from fx_dem),
c as (select key, floor(x - 0.5) as i0, floor(y - 0.5) as j0, x - 0.5 - floor(x - 0.5) as wx, y - 0.5 - floor(y - 0.5) as wy from t)
select key, case when count(*) = 4 then round(sum(elev * (case when i = i0 then 1 - wx else wx end) * (case when j = j0 then 1 - wy else wy end)), 5) end as elev
from c join fx_dem on i in (i0, i0 + 1) and j in (j0, j0 + 1) group by 1""")
def bilinear(fx):
    targets = fx.dem.select(F.col("cell").alias("key"), (F.col("i") + 0.75).alias("x"), (F.col("j") + 0.9).alias("y"))
    return raster.bilinear(targets, fx.dem, "elev").select("key", _r("elev", 5))


_COARSE = """
y as (select i // 5 as ci, j // 5 as cj, cell % 3 as year, sum(cell % 11) as snow from fx_dem group by 1, 2, 3),
a as (select ci, cj, cast(max(snow) as double) as snow from y group by 1, 2),
l as (select ci, cj, snow, ci * 30.0::double as dist from a),
lc as (select ci, cj, snow, case when dist < 90 then 0.0923::double when dist > 240 then 0.0373::double else 0.0923::double + (dist - 90) * (0.0373::double - 0.0923::double) / 150 end as lapse from l),
ce as (select i // 5 as ci, j // 5 as cj, avg(elev) as e from fx_dem group by 1, 2)
"""


def _coarse(fx):
    yearly = fx.dem.groupBy(F.floor(F.col("i") / 5).cast("int").alias("ci"), F.floor(F.col("j") / 5).cast("int").alias("cj"), (F.col("cell") % 3).alias("year")).agg(F.sum(F.col("cell") % 11).alias("snow"))
    return yearly.groupBy("ci", "cj").agg(F.max("snow").cast("double").alias("snow"))


_DOWN = """
fs as (select i, j, snow as v from fx_dem left join {coarse} on ci = i // 5 and cj = j // 5), fl as (select i, j, lapse as v from fx_dem left join {coarse} on ci = i // 5 and cj = j // 5), fe as (select i, j, e as v from fx_dem join ce on ci = i // 5 and cj = j // 5),
""" + _blur_sql("bs", "fs", "v", 5.0) + "," + _blur_sql("bl", "fl", "v", 5.0) + "," + _blur_sql("be", "fe", "v", 5.0)  # fmt: skip


@query("r_18_downscaled", "dem", _COARSE + "," + _DOWN.replace("{coarse}", "lc") + """
select d.i, d.j, round(greatest(bs.v + bl.v * (elev - be.v), 0), 4) as snow from fx_dem d join bs using (i, j) join bl using (i, j) join be using (i, j)""")
def downscaled(fx):
    coarse = _coarse(fx).withColumn("lapse", CF.lapse_rate(F.col("ci") * 30.0))
    return focal.downscaled(fx.dem.select("i", "j", "elev"), coarse, 5, "snow", "lapse").select("i", "j", _r("snow", 4))


_LOCAL = _COARSE + """,
src as (select ci as i, cj as j, elev, snow as v from a join (select i // 5 as ci, j // 5 as cj, avg(elev) as elev from fx_dem group by 1, 2) using (ci, cj)),
""" + _MIRROR.format(k=1, src="src", cols="elev, v", r=2) + f""",
n as (select a.i, a.j, b.i - a.i as di, b.j - a.j as dj, b.elev, b.v from src a join m1 b on b.i between a.i - 2 and a.i + 2 and b.j between a.j - 2 and a.j + 2),
w as (select *, {_kernel_case(focal.GRADIENT)} as wx, {_kernel_case([list(c) for c in zip(*focal.GRADIENT)])} as wy from n),
g as (select i, j, sum(elev * wx) / 48000 as hx, sum(elev * wy) / 48000 as hy, sum(v * wx) / 48000 as tx, sum(v * wy) / 48000 as ty from w group by 1, 2),
u as (select i, j, (tx * hx + ty * hy) / nullif(hx * hx + hy * hy, 0) as lapse from g where sqrt(hx * hx + hy * hy) >= 0.004),
m as (select median(lapse / nullif(v, 0)) as ratio from src join u using (i, j) where lapse >= 0),
lm as (select i as ci, j as cj, v as snow, ratio * v as lapse from src, m)
"""  # noqa: B905


@query("r_19_downscaled_by_local_lapse", "dem", _LOCAL + "," + _DOWN.replace("{coarse}", "lm") + """
select d.i, d.j, round(greatest(bs.v + coalesce(bl.v * (elev - be.v), 0), 0), 4) as snow from fx_dem d join bs using (i, j) join bl using (i, j) join be using (i, j)""")
def downscaled_by_local_lapse(fx):
    height = raster.coarsen(fx.dem, 5, [F.avg("elev").alias("elev")])
    coarse = focal.scaled_lapse(_coarse(fx).join(height, ["ci", "cj"]), 50.0)
    return focal.downscaled(fx.dem.select("i", "j", "elev"), coarse, 5, "snow", "lapse").select("i", "j", _r("snow", 4))


def _filled_sql(src: str, band: str, passes: int, digits: int) -> str:
    """Repeated means of the four neighbours over lists of all cells, so often that they have settled."""
    return f"""
cells as (select i, j, {band} as known, row_number() over (order by j, i) as n from {src}),
nb as (select a.n, list(b.n) as nb from cells a left join cells b on (a.j = b.j and abs(a.i - b.i) = 1) or (a.i = b.i and abs(a.j - b.j) = 1) group by 1),
st as (select list(cast(known as double) order by n) as known, list(nb order by n) as nb from cells join nb using (n)),
passes(k, v) as (select 0, known from st union all
  select k + 1, list_transform(nb, lambda x, p: coalesce(known[p], list_avg(list_transform(x, lambda q: v[q])))) from passes, st where k < {passes}),
o as (select unnest(range(1, len(v) + 1)) as n, unnest(v) as v from passes where k = {passes})
select i, j, round(v + 1e-6, {digits}) as {band} from cells join o using (n)"""


def _settled(layer, band: str, digits: int):
    """Relaxed far below the digits that are compared."""
    return relax.filled(layer, band, tolerance=1e-9).select("i", "j", F.round(F.col(band) + 1e-6, digits).alias(band))


@query("r_20_filled", "dem", "src as (select i, j, case when landcover <> 11 then elev end as elev from fx_dem),\n" + _filled_sql("src", "elev", 800, 4))
def filled(fx):
    return _settled(fx.dem.withColumn("elev", F.when(F.col("landcover") != 11, F.col("elev"))), "elev", 4)


@query("r_21_margin_ring", "dem", "select i, j, not (i between 3 and 46 and j between 3 and (select max(j) from fx_dem) - 3) as margin from fx_dem")
def margin_ring(fx):
    return focal.margin_ring(fx.dem, *focal.grid_size(fx.dem), 3)


@query("r_22_cleaned_lapse", "dem", """
v as (select cell, elev, cast(cell % 5 as double) as snow, case when cell % 7 <> 0 then (cell % 9) - 2.0::double end as lapse from fx_dem),
m as (select avg(lapse) as m from v where elev >= 200 and snow > 0 and lapse >= 0)
select cell, round(case when elev >= 200 and snow > 0 and lapse >= 0 then lapse else m end, 6) as lapse from v, m""")
def cleaned_lapse(fx):
    cells = fx.dem.select("cell", "elev", (F.col("cell") % 5).cast("double").alias("snow"), F.when(F.col("cell") % 7 != 0, (F.col("cell") % 9) - 2.0).alias("lapse"))
    return focal.cleaned_lapse(cells).select("cell", _r("lapse"))


@query("l_04_lowest_neighbour", "dem", """
n as (select a.cell, b.cell as other, b.elev, row_number() over (partition by a.cell order by b.elev, (b.j - a.j) * 3 + b.i - a.i) as k
  from fx_dem a join fx_dem b on abs(a.i - b.i) <= 1 and abs(a.j - b.j) <= 1 and a.cell <> b.cell)
select cell, other as lowest from n where k = 1""")
def lowest_neighbour(fx):
    from firngrid.operators import flow

    return flow.lowest_neighbour(fx.dem, "elev")


@query("c_09_exported_levels", "annual dem", _MOMENTS + """,
lv as (select cell, loc - scale * ln(-ln(1 - 1 / 30::double)) as level from p),
src as (select i, j, level from fx_dem left join lv using (cell)),
""" + _filled_sql("src", "level", 6000, 1))
def exported_levels(fx):
    from firngrid.operators import climate

    fit = climate.moment_fit(climate.block_maxima(fx.annual))
    params = fit.select("cell", F.col("gumbel_loc").alias("loc"), F.col("gumbel_scale").alias("scale"), F.lit(0.0).alias("shape"))
    level = climate.return_levels(params, (30,))
    layer = fx.dem.select("cell", "i", "j").join(level, "cell", "left").select("i", "j", "level")
    return _settled(layer, "level", 1)
