"""Queries on masks, release areas and mosaics."""

from __future__ import annotations

from pyspark.sql import functions as F

from firngrid.functions import climate, hazard
from firngrid.operators import mosaic, pra, raster
from firngrid.plans.registry import query

_VOL = "area_m2 * (swe / 200) / cos(radians(mean_slope))"
_SIZE = f"case when {_VOL} < 5000 then 'T' when {_VOL} < 25000 then 'S' when {_VOL} < 60000 then 'M' else 'L' end"


@query("p_04_nonzero_cells", "aval", "select aval_id, cell from fx_aval where max_vel > 0 or max_height > 0 or depo > 0")
def nonzero(fx):
    return raster.nonzero(fx.aval).select("aval_id", "cell")


@query("p_05_extent_masks", "aval", """
select aval_id, cell, k as extent_type from fx_aval, (values ('full'), ('christen'), ('tetra30'), ('tetra1')) t(k)
where case k when 'full' then max_height > 0 and max_vel > 0 when 'christen' then max_height > 0.25 and max_vel > 1
  when 'tetra30' then 300 * max_vel * max_vel > 30 else 300 * max_vel * max_vel > 1 end""")
def extent_masks(fx):
    return raster.extent_masks(fx.aval).select("aval_id", "cell", "extent_type")


@query("p_06_cut_off", "pra", "select id from fx_pra where mean_dem >= 100 and area_m2 >= 1000")
def cut_off(fx):
    return pra.cut_off(fx.pra).select("id")


@query("p_07_clip", "pra dem", """
select id from fx_pra p join fx_dem d using (cell) where i >= 10 and i < 30 and j >= 2 and j < 12 and landcover <> 11""")
def clip(fx):
    mask = fx.dem.select("i", "j", F.when(F.col("landcover") == 11, 0).otherwise(2).alias("mask"))
    areas = fx.pra.withColumns({"i": (F.col("cell") % 50).cast("int"), "j": F.floor(F.col("cell") / 50).cast("int")})
    return pra.clip(areas, mask, 10, 2, 30, 12).select("id")


@query("p_08_forest_filter", "aval dem", """
c as (select a.aval_id as id, count(*) as ext_n, count(*) filter (landcover = 42) as ext_n42, count(*) filter (landcover = 43) as ext_n43,
  count(*) filter (max_vel > 40) as rel_n, count(*) filter (max_vel > 40 and landcover = 41) as rel_n41,
  count(*) filter (max_vel > 40 and landcover = 43) as rel_n43, min(elev) as mean_dem
  from fx_aval a join fx_dem d using (cell) group by 1)
select id, coalesce(mean_dem >= 300 or ((rel_n41 + rel_n43) / nullif(rel_n, 0) < 0.3 and (ext_n42 + ext_n43) / nullif(ext_n, 0) < 0.3), false) as include from c""")
def forest_filter(fx):
    code, rel = F.col("landcover"), F.col("max_vel") > 40
    rows = fx.aval.join(fx.dem.select("cell", "elev", "landcover"), "cell").groupBy(F.col("aval_id").alias("id")).agg(
        F.count("*").alias("ext_n"), F.count_if(code == 42).alias("ext_n42"), F.count_if(code == 43).alias("ext_n43"),
        F.count_if(rel).alias("rel_n"), F.count_if(rel & (code == 41)).alias("rel_n41"), F.count_if(rel & (code == 43)).alias("rel_n43"),
        F.min("elev").alias("mean_dem"))
    return pra.keep_by_forest(rows).select("id", "include")


@query("p_09_sizes_run", "pra", f"""
s as (select id, forest, {_SIZE} as pra_size from fx_pra)
select id, pra_size from s where (forest = 'NoFor' and pra_size in ('L', 'M')) or (forest = 'For' and pra_size in ('S', 'T'))""")
def sizes_run(fx):
    areas = pra.corrected(fx.pra).withColumn("pra_size", hazard.size_class(F.col("vol")))
    return pra.runnable(areas).select("id", "pra_size")


@query("p_12_crop", "aval", "select aval_id, i + 5 as i, j - 3 as j from fx_aval where i + 5 < 40 and j - 3 >= 0 and j - 3 < 20")
def crop(fx):
    return mosaic.placed(fx.aval, 5, -3, 40, 20).select("aval_id", "i", "j")


@query("p_13_forest_mask", "dem", "select cell, landcover in (41, 42, 43) as forest from fx_dem")
def forest_mask(fx):
    return fx.dem.select("cell", hazard.is_forest(F.col("landcover")).alias("forest"))


@query("p_14_land_mask", "dem", "select cell, landcover not in (11, 0) as land from fx_dem")
def land_mask(fx):
    return fx.dem.select("cell", hazard.is_land(F.col("landcover")).alias("land"))


@query("p_15_domain_mask", "dem", """
select i, j, case when landcover = 11 then 0 when exists (select 1 from fx_dem o where o.landcover = 11
  and (o.i - d.i) * (o.i - d.i) + (o.j - d.j) * (o.j - d.j) < 4) then 1 else 2 end as mask from fx_dem d""")
def domain_mask(fx):
    return raster.domain_mask(fx.dem.withColumn("v", F.when(F.col("landcover") != 11, F.col("elev"))), "v", 2)


@query("p_16_release_mask", "dem", """
b as (select cell, elev / 20 as slope, (cell % 13) - 6.0 as curve, cast(cell % 5 as double) as rugged, landcover in (41, 42, 43) as forest from fx_dem)
select cell, s as scenario, case when slope between lo and 60 and abs(curve) <= 5.5 and rugged <= 3.5 and not forest then 200 end as mask
from b, (values ('frequent', 28.0), ('extreme', 30.0)) t(s, lo)""")
def release_mask(fx):
    bands = fx.dem.select("cell", (F.col("elev") / 20).alias("slope"), ((F.col("cell") % 13) - 6.0).alias("plan_curvature"),
                          (F.col("cell") % 5).cast("double").alias("ruggedness"), hazard.is_forest(F.col("landcover")).alias("forest"))
    return raster.release_mask(bands, {"frequent": (28.0, 60.0), "extreme": (30.0, 60.0)})


@query("p_17_perimeter_mask", "dem", """
select cell, case when i < 25 then elev end as elev, case when i < 25 then landcover end as landcover from fx_dem""")
def perimeter_mask(fx):
    inside = fx.dem.where("i < 25").select("cell", F.lit(True).alias("inside"))
    return raster.mask_bands(fx.dem.select("cell", "elev", "landcover"), inside, ["elev", "landcover"])


@query("p_19_corrections", "pra", f"select id, round(swe / 200, 6) as d0, round({_VOL}, 4) as vol from fx_pra")
def corrections(fx):
    return pra.corrected(fx.pra).select("id", F.round("d0", 6).alias("d0"), F.round("vol", 4).alias("vol"))


@query("p_20_wind_and_slope", "pra", """
c as (select id, (swe / 200 + (mean_dem - 1500) / 100 * 0.05::double) * cos(radians(28)) as star,
  case when mean_dem >= 2000 then 0.1 when mean_dem <= 1000 then 0 else (mean_dem - 1000) * 0.0001::double end as wind,
  sin(radians(mean_slope)) as s, cos(radians(mean_slope)) as c from fx_pra)
select id, round((star + wind) * (0.219::double / s - 0.202::double * c), 5) as d0_flat,
  round((star + wind) * (0.291::double / (s - 0.202::double * c)), 5) as d0_steep from c""")
def wind_and_slope(fx):
    args = hazard.snow_depth(F.col("swe")), F.col("mean_dem"), F.col("mean_slope")
    flat, steep = (hazard.corrected_depth(*args, form=f)[3] for f in ("flat", "steep"))
    return fx.pra.select("id", F.round(flat, 5).alias("d0_flat"), F.round(steep, 5).alias("d0_steep"))


@query("p_21_snow_depth", "pra", "select id, swe / 200 as depth from fx_pra")
def snow_depth(fx):
    return fx.pra.select("id", hazard.snow_depth(F.col("swe")).alias("depth"))


@query("p_22_size_class", "pra", f"select id, {_SIZE} as pra_size from fx_pra where mean_dem >= 100 and area_m2 >= 1000")
def size_class(fx):
    return pra.corrected(pra.cut_off(fx.pra)).select("id", hazard.size_class(F.col("vol")).alias("pra_size"))


@query("p_23_pressure", "aval", "select aval_id, cell, round(300 * max_vel * max_vel / 1000, 3) as kpa from fx_aval")
def pressure(fx):
    return fx.aval.select("aval_id", "cell", F.round(hazard.pressure(F.col("max_vel")).cast("double") / 1000, 3).alias("kpa"))


@query("p_24_lapse_rate", "dem", """
select cell, round(case when elev / 3 < 90 then 0.0923 when elev / 3 > 240 then 0.0373
  else 0.0923 + (elev / 3 - 90) * (0.0373::double - 0.0923::double) / 150 end, 8) as lapse from fx_dem""")
def lapse_rate(fx):
    return fx.dem.select("cell", F.round(climate.lapse_rate(F.col("elev") / 3), 8).alias("lapse"))


@query("p_25_names", "names", """
select id, chunk, 'c-' || size || '-' || lpad(cast(chunk as varchar), 5, '0') || 'For_10m_30' || size as chunk_name,
  'ak-past-All-30-' || lpad(cast(chunk as varchar), 3, '0') || '-045-height.tif' as layer_name from fx_names""")
def name_building(fx):
    lit = F.lit
    return fx.names.select("id", "chunk", hazard.chunk_name(F.col("size"), F.col("chunk"), lit("For"), lit(10), lit(30)).alias("chunk_name"),
                           hazard.layer_name(lit("ak"), lit("past"), lit("NoFor"), lit(30), F.col("chunk"), lit(45), "height").alias("layer_name"))


@query("p_26_forest_all", "combos", "select region, era, return_period, 'All' as forest from fx_combos")
def forest_all(fx):
    return fx.combos.withColumn("forest", F.lit("All"))


@query("p_27_aspect_classes", "dem", """
s as (select cell, cast(floor((((cell * 37) % 361) - 1 + 22.5) / 45) as int) % 8 as k, ((cell * 37) % 361) - 1 >= 0 as ok from fx_dem)
select cell, case when ok then [0, 100, 200, 100, 0, -100, -200, -100][k + 1] end as north0,
  case when ok then [200, 100, 0, -100, -200, -100, 0, 100][k + 1] end as northmax from s""")
def aspect_classes(fx):
    aspect = ((F.col("cell") * 37) % 361 - 1).cast("double")
    return fx.dem.select("cell", hazard.aspect_class(aspect, "north0").alias("north0"), hazard.aspect_class(aspect, "northmax").alias("northmax"))


@query("a_01_mosaic", "aval", """
select i, j, count(*) as domain_count, count(*) filter (max_height > 0.25 and max_vel > 1) as avalanche_count,
  round(coalesce(max(max_height) filter (max_height > 0.25 and max_vel > 1), 0), 4) as max_height,
  coalesce(max(max_vel) filter (max_height > 0.25 and max_vel > 1), 0) as max_velocity,
  round(coalesce(max(depo) filter (max_height > 0.25 and max_vel > 1), 0), 4) as deposition,
  round(coalesce(max(300 * max_vel * max_vel) filter (max_height > 0.25 and max_vel > 1), 0), 1) as max_pressure
from fx_aval group by 1, 2""")
def mosaic_query(fx):
    out = mosaic.mosaic(fx.aval)
    return out.withColumns({"max_height": F.round("max_height", 4), "deposition": F.round("deposition", 4), "max_pressure": F.round("max_pressure", 1)})


@query("w_01_encode_differences", "aval", """
select aval_id, cell, i - lag(i, 1, 0) over w as i, j - lag(j, 1, 0) over w as j from fx_aval window w as (partition by aval_id order by cell)""")
def encode_differences(fx):
    return mosaic.encode_differences(fx.aval.select("aval_id", "cell", "i", "j"), ["i", "j"], "aval_id", "cell")


@query("w_02_decode_differences", "aval", "select aval_id, cell, i, j from fx_aval")
def decode_differences(fx):
    coded = mosaic.encode_differences(fx.aval.select("aval_id", "cell", "i", "j"), ["i", "j"], "aval_id", "cell")
    return mosaic.decode_differences(coded, ["i", "j"], "aval_id", "cell")


@query("w_05_chunk_numbers", "pra", f"""
s as (select id, {_SIZE} as pra_size from fx_pra where mean_dem >= 100 and area_m2 >= 1000)
select id, pra_size, cast((row_number() over (partition by pra_size order by id) - 1) // 500 + case pra_size when 'T' then 8 else 0 end as int) as chunkid from s""")
def chunk_numbers(fx):
    areas = pra.corrected(pra.cut_off(fx.pra)).select("id", hazard.size_class(F.col("vol")).alias("pra_size"))
    current = fx.spark.createDataFrame([("T", 7)], "pra_size string, last int")
    return pra.chunked(areas, current)


@query("a_02_pra_counts", "pra", "select cell, count(*) as pra_count from fx_pra group by 1")
def pra_counts(fx):
    return fx.pra.groupBy("cell").agg(F.count("*").alias("pra_count"))
