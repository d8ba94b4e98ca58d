"""Queries on joins, aggregates, elevation classes and climatology."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from firngrid.functions import climate as CF
from firngrid.functions import hazard
from firngrid.operators import catalog, climate, raster, stats
from firngrid.plans.registry import query


def _r(name: str, digits: int = 6):
    return F.round(name, digits).alias(name)


@query("j_01_release_domains", "pra boxes", "select p.id, p.area_m2, b.x0, b.y1 from fx_pra p join fx_boxes b on b.aval_id = p.id")
def release_domains(fx):
    domains = fx.boxes.withColumnRenamed("aval_id", "id")
    return fx.pra.join(domains, "id").select("id", "area_m2", "x0", "y1")


@query("j_02_extent_attributes", "pra aval dem", """
e as (select aval_id as id, count(*) as ext_n, min(elev) as mean_dem from fx_aval join fx_dem using (cell) group by 1)
select e.id, ext_n, p.mean_dem, mean_slope from e join fx_pra p on p.id = e.id""")
def extent_attributes(fx):
    extents = fx.aval.join(fx.dem.select("cell", "elev"), "cell").groupBy(F.col("aval_id").alias("id")).agg(F.count("*").alias("ext_n"), F.min("elev").alias("mean_dem"))
    return extents.drop("mean_dem").join(fx.pra, "id").select("id", "ext_n", "mean_dem", "mean_slope")


@query("j_03_value_at_centroid", "boxes dem", """
select b.aval_id, d.elev from fx_boxes b left join fx_dem d on d.i = floor((x0 + x1) / 2) and d.j = floor((y0 + y1) / 2)""")
def value_at_centroid(fx):
    at = fx.boxes.select("aval_id", F.floor((F.col("x0") + F.col("x1")) / 2).cast("int").alias("i"), F.floor((F.col("y0") + F.col("y1")) / 2).cast("int").alias("j"))
    return raster.lookup(at, fx.dem, ["elev"]).select("aval_id", "elev")


@query("j_06_survivors", "aval pra", "select aval_id, cell from fx_aval where aval_id in (select id from fx_pra where mean_dem >= 300)")
def survivors(fx):
    ids = fx.pra.where("mean_dem >= 300").select(F.col("id").alias("aval_id"))
    return fx.aval.select("aval_id", "cell").join(ids, "aval_id", "left_semi")


@query("j_07_box_join", "tiles boxes", """
select b.aval_id, t.idom, t.jdom from fx_boxes b join fx_tiles t on b.x0 <= t.x1 and t.x0 <= b.x1 and b.y0 <= t.y1 and t.y0 <= b.y1""")
def box_join(fx):
    return catalog.box_join(fx.boxes, fx.tiles, 10.0).select("aval_id", "idom", "jdom")


@query("j_09_nearest_sea", "dem", """
o as (select i, j from fx_dem where landcover = 11),
k as (select d.cell, sqrt((d.i - o.i) ** 2 + (d.j - o.j) ** 2) as dist, row_number() over (partition by d.cell order by (d.i - o.i) ** 2 + (d.j - o.j) ** 2) as r
  from fx_dem d, o where d.landcover <> 11)
select cell, round(avg(dist), 6) as distance from k where r <= 30 group by 1""")
def nearest_sea(fx):
    from firngrid.operators import vector

    land, sea = fx.dem.where("landcover <> 11"), fx.dem.where("landcover = 11")
    near = vector.nearest(land.select("cell", "i", "j"), sea.select("i", "j"), 30, 8)
    return near.groupBy("cell").agg(F.round(F.avg("distance"), 6).alias("distance"))


def _class_sql(classes) -> str:
    rows = ", ".join(f"('{n}', {'null' if a is None else a}::double, {'null' if b is None else b}::double)" for n, a, b in classes)
    return f"c as (select * from (values {rows}) t(label, low, high))"


@query("j_11_elevation_classes", "dem", _class_sql(stats.CLASSES) + " select cell, label from fx_dem, c where elev >= low and elev < high")
def elevation_classes(fx):
    return stats.classed(fx.dem.select("cell", "elev"), "elev", stats.class_table(fx.spark, stats.CLASSES)).select("cell", "label")


@query("j_12_open_classes", "dem", _class_sql(stats.CLASSES_1) + " select cell, label from fx_dem, c where (low is null or elev >= low) and (high is null or elev < high)")
def open_classes(fx):
    return stats.classed(fx.dem.select("cell", "elev"), "elev", stats.class_table(fx.spark, stats.CLASSES_1)).select("cell", "label")


@query("j_13_coarse_lookup", "dem", """
g as (select i // 4 as ci, j // 4 as cj, avg(elev) as coarse from fx_dem group by 1, 2)
select cell, round(coarse, 6) as coarse from fx_dem join g on ci = i // 4 and cj = j // 4""")
def coarse_lookup(fx):
    coarse = raster.coarsen(fx.dem, 4, [F.avg("elev").alias("coarse")])
    fine = fx.dem.withColumns({"ci": F.floor(F.col("i") / 4).cast("int"), "cj": F.floor(F.col("j") / 4).cast("int")})
    return fine.join(coarse, ["ci", "cj"]).select("cell", _r("coarse"))


_WEIGHTS = """
l as (select * from (values (0, 100.0::double, 300.0::double), (1, 300.0::double, 600.0::double), (2, 600.0::double, 1000.0::double)) t(k, low, high)),
v as (select cell, least(greatest(elev, 100.0::double), 1000.0::double) as v from fx_dem),
w as (select cell, k, (v - low) / (high - low) as s from v join l on (v >= low or k = 0) and (v < high or k = 2)),
e as (select cell, k as level, 1 - s as weight from w union all select cell, k + 1, s from w)
"""


@query("j_14_interpolation_weights", "dem", _WEIGHTS + "select cell, level, round(weight, 6) as weight from e")
def interpolation_weights(fx):
    return stats.weights_between(fx.dem, "elev", [100.0, 300.0, 600.0, 1000.0]).select("cell", "level", _r("weight"))


@query("j_15_matrix_apply", "dem", _WEIGHTS + "select cell as row, round(sum(weight * (level * 10 + 1)) / sum(weight), 6) as value from e group by 1")
def matrix_apply(fx):
    entries = stats.weights_between(fx.dem, "elev", [100.0, 300.0, 600.0, 1000.0])
    levels = fx.table("region").where("r_regionkey < 4").select(F.col("r_regionkey").alias("col"), (F.col("r_regionkey") * 10.0 + 1).alias("v"))
    return stats.matrix_apply(entries.select(F.col("cell").alias("row"), F.col("level").alias("col"), F.col("weight").alias("w")), levels).select("row", _r("value"))


@query("a_10_bounding_boxes", "aval", "select aval_id, min(i)::double as x0, min(j)::double as y0, max(i)::double + 1 as x1, max(j)::double + 1 as y1 from fx_aval group by 1")
def bounding_boxes(fx):
    return fx.boxes


@query("a_11_union_extent", "boxes", "select aval_id % 10 as k, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1 from fx_boxes group by 1")
def union_extent(fx):
    return fx.boxes.groupBy((F.col("aval_id") % 10).alias("k")).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


@query("a_12_landcover_counts", "aval dem", """
select aval_id, count(*) as n, count(*) filter (landcover = 41) as n41, count(*) filter (landcover = 42) as n42, count(*) filter (landcover = 43) as n43 from fx_aval join fx_dem using (cell) group by 1""")
def landcover_counts(fx):
    code = F.col("landcover")
    return fx.aval.join(fx.dem.select("cell", "landcover"), "cell").groupBy("aval_id").agg(F.count("*").alias("n"), *[F.count_if(code == k).alias(f"n{k}") for k in hazard.FOREST_CODES])


@query("a_13_coarsen_mean", "dem", "select i // 4 as ci, j // 4 as cj, round(avg(case when landcover <> 11 then elev end), 6) as elev from fx_dem group by 1, 2")
def coarsen_mean(fx):
    return raster.coarsen(fx.dem, 4, [F.avg(F.when(F.col("landcover") != 11, F.col("elev"))).alias("elev")]).select("ci", "cj", _r("elev"))


@query("a_14_coarsen_sum", "dem", "select i // 5 as ci, j // 5 as cj, round(sum(elev), 4) as elev from fx_dem group by 1, 2")
def coarsen_sum(fx):
    return raster.coarsen(fx.dem, 5, [F.sum("elev").alias("elev")]).select("ci", "cj", _r("elev", 4))


_HIT = """
h as (select cell, count(*) as n from fx_aval where max_height > 0.85 and max_vel > 45 group by 1),
x as (select d.cell, i, j, case when landcover = 11 then 0 else elev end as elev, least(coalesce(n, 0), 1) as hit, elev / 10 as snow from fx_dem d left join h using (cell))
"""


def _hits(fx):
    hit = fx.aval.where("max_height > 0.85 and max_vel > 45").groupBy("cell").agg(F.count("*").alias("n"))
    elev = F.when(F.col("landcover") == 11, 0.0).otherwise(F.col("elev"))
    return fx.dem.join(hit, "cell", "left").select("cell", "i", "j", elev.alias("elev"), stats.present(F.col("n")).alias("hit"), (F.col("elev") / 10).alias("snow"))


_CLASS_STATS = _HIT + ", " + _class_sql(stats.CLASSES) + """
select label, size, cast(i // size as int) as ci, cast(j // size as int) as cj, count(*) as n_land, round(sum(hit) / count(*), 6) as hit_share, round(sum(snow) / count(*), 6) as snow_mean
from x, c, (values (5), (10), (50)) t(size) where elev > 0 and elev >= low and elev < high group by all"""


@query("a_15_class_statistics", "dem aval", _CLASS_STATS)
def class_statistics(fx):
    out = stats.by_class_and_size(_hits(fx), stats.class_table(fx.spark, stats.CLASSES), (5, 10, 50))
    return out.withColumns({"hit_share": F.round("hit_share", 6), "snow_mean": F.round("snow_mean", 6)})


@query("a_16_presence", "dem aval", _HIT + "select cell, hit from x")
def presence(fx):
    return _hits(fx).select("cell", "hit")


@query("a_17_density", "dem aval", _HIT + "select i // 10 as ci, j // 10 as cj, round(avg(hit) / 100, 8) as per_m2, round(avg(hit) / 100 * 1000000, 4) as per_km2 from x group by 1, 2")
def density(fx):
    mean = F.avg("hit") / 100
    return raster.coarsen(_hits(fx), 10, [F.round(mean, 8).alias("per_m2"), F.round(mean * 1_000_000, 4).alias("per_km2")])


@query("a_18_land_fraction", "dem", "select i // 10 as ci, j // 10 as cj, round(avg(case when landcover in (11, 0) then 0 else 1 end), 6) as land from fx_dem group by 1, 2")
def land_fraction(fx):
    return raster.coarsen(fx.dem, 10, [F.round(F.avg(hazard.is_land(F.col("landcover")).cast("int")), 6).alias("land")])


@query("a_19_combine_tiles", "aval", "select case when aval_id % 2 = 0 then 'past' else 'future' end as wcombo, i, j, count(*) as n from fx_aval group by 1, 2, 3")
def combine_tiles(fx):
    wcombo = F.when(F.col("aval_id") % 2 == 0, "past").otherwise("future")
    tiles = fx.aval.groupBy(wcombo.alias("wcombo"), F.floor(F.col("i") / 10).alias("idom"), F.floor(F.col("j") / 10).alias("jdom"), "i", "j").agg(F.count("*").alias("n"))
    return tiles.select("wcombo", "i", "j", "n")


@query("a_20_scenario_difference", "aval", """
a as (select cell, count(*) as n from fx_aval where aval_id % 2 = 0 group by 1), b as (select cell, count(*) as n from fx_aval where aval_id % 2 = 1 group by 1)
select cell, b.n - a.n as difference from a join b using (cell)""")
def scenario_difference(fx):
    scenario = F.when(F.col("aval_id") % 2 == 0, "past").otherwise("future")
    layers = fx.aval.withColumn("scenario", scenario).groupBy("scenario", "cell").agg(F.count("*").alias("n"))
    return stats.difference(layers, ["cell"], "scenario", "future", "past", "n")


@query("a_21_correlations", "dem aval", _HIT + """
, l as (select max(elev) as elev, cell, max(case when cell % 9 <> 0 then hit end) as hit, max(snow * (cell % 3)) as snow from x group by cell), k as (select * from l where hit is not null)
select 'elev' as a, 'hit' as b, round(corr(elev, hit), 6) as r from k union all select 'elev', 'snow', round(corr(elev, snow), 6) from k union all select 'hit', 'snow', round(corr(hit, snow), 6) from k""")
def correlations(fx):
    layers = _hits(fx).select("elev", F.when(F.col("cell") % 9 != 0, F.col("hit")).alias("hit"), (F.col("snow") * (F.col("cell") % 3)).alias("snow"))
    return stats.correlations(layers, ["elev", "hit", "snow"]).select("a", "b", _r("r"))


@query("a_22_quartiles_by_distance", "dem", """
select floor(i / 30.0 + 0.5) * 30 as bin, count(*) as n, round(quantile_cont(elev, 0.25), 6) as q25, round(quantile_cont(elev, 0.5), 6) as q50, round(quantile_cont(elev, 0.75), 6) as q75
from fx_dem where elev between 100 and 900 group by 1""")
def quartiles_by_distance(fx):
    return stats.quartiles_by_bin(fx.dem, "i", "elev", 30.0, 100.0, 900.0).select("bin", "n", _r("q25"), _r("q50"), _r("q75"))


@query("a_23_median_ratio", "dem", """
m as (select median(elev / nullif(landcover - 11, 0)) as r from fx_dem)
select cell, round(r * (landcover - 11), 6) as scaled from fx_dem, m""")
def median_ratio(fx):
    rows = fx.dem.withColumn("b", (F.col("landcover") - 11).cast("double"))
    return stats.scaled_by_median_ratio(rows, "elev", "b").select("cell", _r("scaled"))


@query("a_24_max_by_period", "annual", """
y as (select cell, year(day) as year, max(v) as v from fx_annual group by 1, 2)
select p as period, cell, max(v) as v from y join (values ('early', 1993, 1997), ('late', 1996, 2000)) t(p, a, b) on year between a and b group by 1, 2""")
def max_by_period(fx):
    yearly = fx.annual.groupBy("cell", F.year("day").alias("year")).agg(F.max("v").alias("v"))
    periods = fx.spark.createDataFrame([("early", 1993, 1997), ("late", 1996, 2000)], "period string, first int, last int")
    return stats.max_by_period(yearly, periods, "cell", "v")


@query("a_25_layer_summary", "dem", "select landcover, count(*) as n, min(elev) as low, max(elev) as high, count(distinct elev) as n_values from fx_dem group by 1")
def layer_summary(fx):
    return fx.dem.groupBy("landcover").agg(F.count("*").alias("n"), F.min("elev").alias("low"), F.max("elev").alias("high"), F.countDistinct("elev").alias("n_values"))


@query("a_26_merge_polygons", "boxes", "select aval_id % 50 as id, count(*) as parts, sum(x0) as sum_x0 from fx_boxes group by 1")
def merge_polygons(fx):
    merged = fx.boxes.groupBy((F.col("aval_id") % 50).alias("id")).agg(F.sort_array(F.collect_list(F.struct("x0", "y0", "x1", "y1"))).alias("rings"))
    return merged.select("id", F.size("rings").cast("long").alias("parts"), F.aggregate("rings", F.lit(0.0), lambda a, r: a + r["x0"]).alias("sum_x0"))


@query("a_27_largest_part", "boxes", """
select id, aval_id from (select aval_id % 50 as id, aval_id, row_number() over (partition by aval_id % 50 order by (x1 - x0) * (y1 - y0) desc, aval_id desc) as k from fx_boxes) where k = 1""")
def largest_part(fx):
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    return fx.boxes.groupBy((F.col("aval_id") % 50).alias("id")).agg(F.max_by("aval_id", F.struct(area, "aval_id")).alias("aval_id"))


@query("a_32_border_duplicates", "boxes", """
g as (select x0, y0, x1, y1, count(distinct aval_id % 7) as n_tiles from fx_boxes group by all)
select * from g where n_tiles > 1""")
def border_duplicates(fx):
    return fx.boxes.groupBy("x0", "y0", "x1", "y1").agg(F.countDistinct(F.col("aval_id") % 7).alias("n_tiles")).where("n_tiles > 1")


@query("l_03_highest_cell", "aval dem", """
select aval_id, arg_max(cell, (elev, -cell)) as cell from fx_aval join fx_dem using (cell) group by 1""")
def highest_cell(fx):
    return fx.aval.join(fx.dem.select("cell", "elev"), "cell").groupBy("aval_id").agg(F.max_by("cell", F.struct("elev", -F.col("cell"))).alias("cell"))


@query("c_01_daily_sums", "", "select user_id as cell, cast(cast(ts as date) as varchar) as day, round(sum(value), 4) as acsnow from events group by 1, 2")
def daily_sums(fx):
    steps = fx.table("events").select(F.col("user_id").alias("cell"), "ts", "value")
    return climate.daily(steps).select("cell", F.col("day").cast("string").alias("day"), _r("acsnow", 4))


_BLOCKS = """
b as (select cell, date '2024-01-01' + cast((day - date '2024-01-01') // 3 * 3 as int) as start, sum(acsnow) as acsnow from fx_snow group by 1, 2),
k as (select * from b where start + 2 <= date '2024-01-29')
"""


@query("c_02_three_day_sums", "snow", _BLOCKS + "select cell, cast(start as varchar) as start, round(acsnow, 4) as acsnow from k")
def three_day_sums(fx):
    return climate.block_sums(fx.snow, "2024-01-01", "2024-01-29").select("cell", F.col("start").cast("string").alias("start"), _r("acsnow", 4))


@query("c_03_missing_days", "snow", """
select cast(d as varchar) as day from (select cast(unnest(generate_series(date '2023-12-25', date '2024-02-05', interval 1 day)) as date) as d) where d not in (select day from fx_snow where day <> date '2024-01-09')""")
def calendar_gaps(fx):
    return climate.missing_days(fx.snow.where("day <> date '2024-01-09'"), "2023-12-25", "2024-02-05").select(F.col("day").cast("string").alias("day"))


@query("c_04_series", "snow", _BLOCKS + "select cell, count(*) as n, round(arg_min(acsnow, start), 4) as first, round(arg_max(acsnow, start), 4) as last from k group by 1")
def series(fx):
    s = climate.series(climate.block_sums(fx.snow, "2024-01-01", "2024-01-29"))
    at = lambda k: F.round(F.element_at("series", k)["acsnow"], 4)
    return s.select("cell", F.size("series").cast("long").alias("n"), at(1).alias("first"), at(-1).alias("last"))


_MAXIMA = """
m as (select cell, make_date(year(day) - case when month(day) < 7 then 1 else 0 end, 7, 1) as year, max(v) as v from fx_annual group by 1, 2)
"""
_MOMENTS = _MAXIMA + """,
r as (select cell, v, row_number() over (partition by cell order by v) - 1 as r from m),
b as (select cell, count(*) as n, avg(v) as b0, sum(r * v) / (count(*) * (count(*) - 1)) as b1, sum(r * (r - 1) * v) / (count(*) * (count(*) - 1) * (count(*) - 2)) as b2 from r group by 1 having count(*) >= 3),
l as (select cell, b0, 2 * b1 - b0 as l2, (2 * b1 - b0) / (3 * b2 - b0) - ln(2) / ln(3) as c from b),
p as (select cell, b0 - 0.5772156649015329::double * l2 / ln(2) as loc, l2 / ln(2) as scale, 7.859::double * c + 2.9554::double * c * c as shape from l where l2 > 0)
"""


@query("c_05_block_maxima", "annual", _MAXIMA + "select cell, cast(year as varchar) as year, v from m")
def block_maxima(fx):
    return climate.block_maxima(fx.annual).select("cell", F.col("year").cast("string").alias("year"), "v")


@query("c_06_moment_fit", "annual", _MOMENTS + "select cell, round(loc, 3) as gumbel_loc, round(scale, 3) as gumbel_scale, round(shape, 6) as shape from p")
def moment_fit(fx):
    fit = climate.moment_fit(climate.block_maxima(fx.annual)).where("gumbel_scale is not null")
    return fit.select("cell", _r("gumbel_loc", 3), _r("gumbel_scale", 3), _r("shape"))


@query("c_06_likelihood_fit")
def likelihood_fit(fx):
    return climate.likelihood_fit(climate.block_maxima(fx.annual))


@query("c_06_order_fit")
def order_fit(fx):
    return climate.order_fit(climate.block_maxima(fx.annual))


@query("c_07_return_levels", "annual dem", _MOMENTS + """
select cell, t as period, round(loc - scale * ln(-ln(1 - 1 / t::double)), 2) as level from p, (values (10), (30), (100), (300)) q(t) where cell in (select cell from fx_dem where landcover <> 11)""")
def return_levels(fx):
    fit = climate.moment_fit(climate.block_maxima(fx.annual)).where("gumbel_scale is not null")
    land = fx.dem.where("landcover <> 11").select("cell")
    params = fit.join(land, "cell", "left_semi").select("cell", F.col("gumbel_loc").alias("loc"), F.col("gumbel_scale").alias("scale"), F.lit(0.0).alias("shape"))
    return climate.return_levels(params).select("cell", "period", _r("level", 2))


@query("c_08_curves", "pra", """
select id, t as period, round(mean_dem + swe / 0.2::double * (1 - (-ln(1 - 1 / t::double)) ** 0.2::double), 6) as level,
  round(greatest(exp(-exp(-(1.5::double))) * exp(-1.5::double) / (swe + 1), 0), 9) as density from fx_pra, (values (2), (5), (50)) q(t)""")
def curves(fx):
    rows = fx.pra.withColumn("period", F.explode(F.array(F.lit(2), F.lit(5), F.lit(50))))
    level = CF.gev_quantile(F.col("mean_dem"), F.col("swe"), F.lit(0.2), F.col("period"))
    dense = CF.gev_density(F.col("mean_dem") + 1.5 * (F.col("swe") + 1), F.col("mean_dem"), F.col("swe") + 1, F.lit(0.0))
    return rows.select("id", "period", F.round(level, 6).alias("level"), F.round(dense, 9).alias("density"))


@query("w_06_year_blocks", "annual", """
f as (select year(day) as year, min(day) as first from fx_annual group by 1)
select year, cast(first as varchar) as first, cast(lead(first) over (order by year) as varchar) as end from f""")
def year_blocks(fx):
    out = climate.year_blocks(fx.annual.select(F.col("day").alias("start")))
    return out.select("year", F.col("first").cast("string").alias("first"), F.col("end").cast("string").alias("end"))


@query("x_08_gev_quantile", "pra", """
select id, round(mean_dem + swe / 0.1::double * (1 - (-ln(1 - 1 / 30.0::double)) ** 0.1::double), 6) as bent, round(mean_dem - swe * ln(-ln(1 - 1 / 30.0::double)), 6) as flat from fx_pra""")
def gev_quantile(fx):
    q = lambda c: F.round(CF.gev_quantile(F.col("mean_dem"), F.col("swe"), F.lit(c), F.lit(30)), 6)
    return fx.pra.select("id", q(0.1).alias("bent"), q(0.0).alias("flat"))


@query("x_09_volumes", "pra", "select id, round(area_m2 * swe / 200 / cos(radians(mean_slope)), 4) as vol from fx_pra")
def volumes(fx):
    return fx.pra.select("id", F.round(hazard.release_volume(F.col("area_m2"), hazard.snow_depth(F.col("swe")), F.col("mean_slope")), 4).alias("vol"))


@query("x_10_day_offsets", "snow", "select cell, cast(day as varchar) as day, cast(day - date '2023-12-01' as int) as offset_days from fx_snow")
def day_offsets(fx):
    offset = F.datediff("day", F.to_date(F.lit("2023-12-01")))
    back = F.date_add(F.to_date(F.lit("2023-12-01")), F.col("offset_days"))
    return fx.snow.select("cell", offset.alias("offset_days")).select("cell", back.cast("string").alias("day"), "offset_days")


@query("x_11_snow_year", "annual", "select cell, v, year(day) - case when month(day) < 7 then 1 else 0 end as year from fx_annual")
def snow_year(fx):
    return fx.annual.select("cell", "v", F.year(CF.snow_year(F.col("day"))).alias("year"))
