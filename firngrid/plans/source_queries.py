"""Queries on scans, sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from firngrid.operators import raster
from firngrid.plans.registry import query
from firngrid.sources import blobs, cells, names, sinks


@query("s_01_scan_cells", "dem", "select cell, i, j, elev from fx_dem where j >= 10")
def scan_cells(fx):
    raw = cells.read_cells(fx.spark, f"{fx.sf_dir}/part.parquet", ["p_partkey", "p_size", "p_retailprice"], "p_partkey >= 500")
    return raw.select(
        F.col("p_partkey").alias("cell"),
        (F.col("p_partkey") % 50).cast("int").alias("i"),
        F.floor(F.col("p_partkey") / 50).cast("int").alias("j"),
        (F.col("p_size") * 20.0 + (F.col("p_retailprice") - 900.0)).alias("elev"),
    )


@query("s_02_extract", "dem", "select cell, elev from fx_dem where i between 5 and 20 and j between 2 and 9")
def extract(fx):
    return cells.extract(fx.dem, 20, 9, 5, 2).select("cell", "elev")


@query("s_03_union_tiles", "dem", """
select i, j, case when i >= 20 then elev + 1 else elev end as elev from fx_dem where i < 30 or i >= 20""")
def union_tiles(fx):
    west, east = fx.dem.where("i < 30"), fx.dem.where("i >= 20").withColumn("elev", F.col("elev") + 1)
    return cells.union_tiles([west, east], "elev")


@query("s_04_tile_inventory", "", """
select cast(p_partkey as int) as tile, 'Cell_' || p_partkey || '/dem/DTM_' || p_brand || '.tif' as path
from part where p_size % 3 = 0""")
def tile_inventory(fx):
    kind = F.when(F.col("p_size") % 3 == 0, "DTM_").otherwise("DSM_")
    path = F.concat(F.lit("Cell_"), F.col("p_partkey"), F.lit("/dem/"), kind, F.col("p_brand"), F.lit(".tif"))
    listing = fx.table("part").select(path.alias("path"))
    found = listing.select(names.tile_number(F.col("path")).alias("tile"), "path").where("tile is not null")
    return found.orderBy("tile")


@query("s_05_decode_results", "aval", """
select aval_id, cast(row_number() over (partition by aval_id order by cell) - 1 as int) as pos,
  round(max_vel, 3) as max_vel, round(max_height, 3) as max_height, round(depo, 3) as depo from fx_aval""")
def decode_results(fx):
    out = blobs.decode_out(blobs.pack(fx.aval))
    return out.select("aval_id", "pos", *[F.round(F.col(c).cast("double"), 3).alias(c) for c in ("max_vel", "max_height", "depo")])


@query("s_06_inconsistent_results", "aval", """
select aval_id, 4 + 12 * count(*) - 5 as n_bytes from fx_aval where aval_id % 50 = 0 group by 1""")
def inconsistent_results(fx):
    content = F.when(F.col("aval_id") % 50 == 0, F.expr("substring(content, 1, octet_length(content) - 5)")).otherwise(F.col("content"))
    return blobs.inconsistent(blobs.pack(fx.aval).withColumn("content", content))


@query("s_07_archive_names", "names", """
select size, id, case when flag = 'R' then 5 else 6 end as id_status from fx_names""")
def archive_names(fx):
    name = F.concat(F.lit("aval-"), "size", F.lit("-"), F.format_string("%06d", "id"), F.lit("-"), F.when(F.col("flag") == "R", "overrun").otherwise(""), F.lit(".nc"))
    return fx.names.select(*names.archive_parts(name))


@query("s_08_release_names", "names", """
select size as pra_size, chunk as chunkid, case when id % 2 = 0 then 'For' else 'NoFor' end as forest,
  cast(10 as int) as resolution, cast(case when part % 2 = 0 then 30 else 300 end as int) as return_period from fx_names""")
def release_names(fx):
    name = F.format_string("c-%s-%05d%s_10m_%d%s_rel.shp", "size", "chunk", F.when(F.col("id") % 2 == 0, "For").otherwise("NoFor"), F.when(F.col("part") % 2 == 0, 30).otherwise(300), "size")
    return fx.names.select(*names.release_parts(name))


@query("s_09_scene_folders", "tiles", """
select case when idom % 2 = 0 then 'x' else 'arc' end as scenetype, idom, jdom from fx_tiles""")
def scene_folders(fx):
    kind = F.when(F.col("idom") % 2 == 0, "x").otherwise("arc")
    path = F.format_string("/data/ak/past/%s-%03d-%03d/CHUNKS", kind, "idom", "jdom")
    return fx.tiles.select(*names.scene_parts(path, -2))


@query("s_10_job_names", "names", "select 'ak-past-For-30' as combo, chunk as chunkid, id from fx_names")
def job_names(fx):
    return fx.names.select(*names.job_parts(F.format_string("ak-past-For-30-%d-%d", "chunk", "id")))


@query("s_11_log_volumes", "", """
select o_orderkey as id, o_totalprice as outflow, case when o_orderkey % 3 = 0 then null else o_totalprice / 2 end as inflow from orders""")
def log_volumes(fx):
    initial = F.when(F.col("o_orderkey") % 3 == 0, "no volume").otherwise(F.concat(F.lit("INITIAL FLOW VOLUME: "), (F.col("o_totalprice") / 2).cast("string")))
    log = F.concat(F.lit("start\n"), initial, F.lit("\nFINAL OUTFLOW VOLUME: "), F.col("o_totalprice").cast("decimal(20,2)").cast("string"), F.lit(" m3\n"))
    return fx.table("orders").select(F.col("o_orderkey").alias("id"), log.alias("log")).select(
        "id", names.volume(F.col("log"), names.OUTFLOW).alias("outflow"), names.volume(F.col("log"), names.INFLOW).alias("inflow")
    )


@query("s_12_log_flags", "", "select o_orderkey as id, o_orderstatus = 'F' as low_flux from orders")
def log_flags(fx):
    log = F.when(F.col("o_orderstatus") == "F", "step 9\nLOW MASS FLUX, FINISHING CALCULATION!!!!").otherwise("step 9\nend")
    return fx.table("orders").select(F.col("o_orderkey").alias("id"), names.low_flux(log).alias("low_flux"))


def _layers(fx):
    layer = F.explode(F.array(F.struct(F.lit("height").alias("layer"), F.col("max_height").alias("value")), F.struct(F.lit("depo").alias("layer"), F.col("depo").alias("value")), F.struct(F.lit("domain").alias("layer"), F.lit(1.0).alias("value"))))
    return fx.aval.select(F.lit("ak").alias("exp"), F.when(F.col("aval_id") % 2 == 0, "past-30").otherwise("future-30").alias("wcombo"), F.floor(F.col("i") / 10).cast("int").alias("idom"), F.floor(F.col("j") / 10).cast("int").alias("jdom"), "aval_id", "cell", layer.alias("l")).select("exp", "wcombo", "idom", "jdom", "aval_id", "cell", "l.layer", "l.value")


_LAYER_SQL = """
lay as (select 'ak' as exp, case when aval_id % 2 = 0 then 'past-30' else 'future-30' end as wcombo,
  cast(i // 10 as int) as idom, cast(j // 10 as int) as jdom, aval_id, cell, layer,
  case layer when 'height' then max_height else depo end as value
  from fx_aval, (values ('height'), ('depo')) l(layer))
"""


@query("s_13_publish", "aval", _LAYER_SQL + "select * from lay")
def publish(fx):
    layers = _layers(fx)
    return sinks.publish(layers, sinks.scratch(layers, "publish"), skip=("domain",))


@query("s_14_republish", "aval", _LAYER_SQL + "select * from lay where layer = 'depo' and wcombo = 'past-30'")
def republish(fx):
    layers = _layers(fx)
    chosen = layers.select("exp", "wcombo").where("wcombo = 'past-30'").distinct()
    return sinks.republish(layers, chosen, ["depo"])


@query("s_15_write_extents", "aval", """
select aval_id, cell, k as extent_type from fx_aval, (values ('full'), ('christen'), ('tetra30'), ('tetra1')) t(k)
where case k when 'full' then max_height > 0 and max_vel > 0 when 'christen' then max_height > 0.25 and max_vel > 1
  when 'tetra30' then 300 * max_vel * max_vel > 30 else 300 * max_vel * max_vel > 1 end""")
def write_extents(fx):
    rows = raster.extent_masks(fx.aval).select("aval_id", "cell", "extent_type")
    folder = sinks.scratch(rows, "extents")
    sinks.write_extents(rows.limit(0), folder)  # a first version without rows
    sinks.write_extents(rows, folder)
    kinds = [sinks.read_extents(fx.spark, folder, kind) for kind in ("full", "christen", "tetra30", "tetra1")]
    return reduce(lambda a, b: a.unionByName(b), kinds)


@query("s_16_variable_inventory", "", """
select cast(cast(ts as date) as varchar) as day, max(case when event_type = 'view' then 'x' end) as acsnow,
  max(case when event_type = 'click' then 'x' end) as t2, max(case when event_type = 'error' then 'x' end) as rain
from events group by 1""")
def variable_inventory(fx):
    known = F.when(F.col("event_type") == "view", "acsnow").when(F.col("event_type") == "click", "t2").when(F.col("event_type") == "error", "rain")
    seen = fx.table("events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), known.alias("variable"))
    return seen.groupBy("day").pivot("variable", ["acsnow", "t2", "rain"]).agg(F.first(F.lit("x")))


@query("s_17_missing_days", "snow", """
select cell, cast(day as varchar) as day, cast(cast(case when day in (date '2024-01-05', date '2024-01-20') then day - interval 1 day else day end as date) as varchar) as source_day from fx_snow""")
def missing_days(fx):
    missing = fx.spark.createDataFrame([("2024-01-05",), ("2024-01-20",)], "day string").select(F.to_date("day").alias("day"), F.lit(True).alias("gone"))
    return fx.snow.join(missing, "day", "left").select("cell", F.col("day").cast("string").alias("day"), F.when(F.col("gone"), F.date_sub("day", 1)).otherwise(F.col("day")).cast("string").alias("source_day"))
