"""Queries on tiles, specs and status."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from firngrid.functions import grid as G
from firngrid.operators import catalog, status
from firngrid.plans.registry import query


@query("t_01_tile_grid", "dem", """
select cast(i as int) as idom, cast(j as int) as jdom, 100 + i * 30.0::double as x0, 500 - (j + 1) * 30.0::double as y0, 130 + i * 30.0::double as x1, 500 - j * 30.0::double as y1,
  92 + i * 30.0::double as mx0, 492 - (j + 1) * 30.0::double as my0, 138 + i * 30.0::double as mx1, 508 - j * 30.0::double as my1
from (select unnest(range(0, (select max(i) + 1 from fx_dem))) as i), (select unnest(range(0, (select max(j) + 1 from fx_dem))) as j)""")
def tile_grid(fx):
    nx, ny = fx.dem.agg(F.max("i") + 1, F.max("j") + 1).first()
    return catalog.tile_grid(fx.spark, nx, ny, 100.0, 500.0, 30.0, -30.0, 8.0)


@query("t_02_active_tiles", "tiles boxes", """
select idom, jdom from fx_tiles t where exists (select 1 from fx_boxes b where (b.x1 - b.x0) * (b.y1 - b.y0) <= 12
  and t.x0 <= b.x1 and b.x0 <= t.x1 and t.y0 <= b.y1 and b.y0 <= t.y1)""")
def active_tiles(fx):
    region = fx.boxes.where("(x1 - x0) * (y1 - y0) <= 12").drop("aval_id")
    return catalog.box_join(fx.tiles, region.withColumn("k", F.lit(1)), 10.0).select("idom", "jdom").distinct()


@query("t_03_tiles_near_roads", "tiles", """
s as (select n_nationkey * 2.0::double as ax, n_nationkey % 7 * 5.0::double as ay, n_nationkey * 2.0::double + 6 as ex, n_nationkey % 5 * 4.0::double as ey from nation),
c as (select idom, jdom, (x0 + x1) / 2 as x, (y0 + y1) / 2 as y, s.* from fx_tiles, s),
d as (select *, greatest(0, least(1, ((x - ax) * (ex - ax) + (y - ay) * (ey - ay)) / ((ex - ax) * (ex - ax) + (ey - ay) * (ey - ay)))) as t from c)
select distinct idom, jdom from d where (x - ax - t * (ex - ax)) ** 2 + (y - ay - t * (ey - ay)) ** 2 <= 49""")
def tiles_near_roads(fx):
    k = F.col("n_nationkey")
    roads = fx.table("nation").select((k * 2.0).alias("ax"), (k % 7 * 5.0).alias("ay"), (k * 2.0 + 6).alias("bx"), (k % 5 * 4.0).alias("by"))
    centres = fx.tiles.select("idom", "jdom", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"))
    return catalog.near_segments(centres, roads, 7.0, ["idom", "jdom"])


@query("t_04_excluded_tiles", "tiles dem", """
select idom, jdom from fx_tiles where idom between 1 and 3 and (idom, jdom) not in ((1, 0), (2, 1))
  and exists (select 1 from fx_dem where i // 10 = idom and j // 10 = jdom and landcover <> 11)""")
def excluded_tiles(fx):
    out = fx.spark.createDataFrame([(1, 0), (2, 1)], "idom int, jdom int")
    land = fx.dem.where("landcover <> 11").select(F.floor(F.col("i") / 10).cast("int").alias("idom"), F.floor(F.col("j") / 10).cast("int").alias("jdom"))
    return fx.tiles.where("idom between 1 and 3").join(out, ["idom", "jdom"], "left_anti").join(land, ["idom", "jdom"], "left_semi").select("idom", "jdom")


@query("t_05_spiral_order", "tiles", """
n as (select idom, jdom, idom - 2 as x, jdom - 1 as y from fx_tiles)
select idom, jdom, case when idom = 0 and jdom = 0 then 0 else 1 end as priority,
  cast(4 * greatest(abs(x), abs(y)) * greatest(abs(x), abs(y)) + (case when x < y then -1 else 1 end) * (2 * greatest(abs(x), abs(y)) + x + y) as int) as spiral from n""")
def spiral_order(fx):
    return catalog.spiral_order(fx.tiles, 2, 1, [(0, 0)])


@query("t_06_ordered_union", "tiles", """
select idom, jdom, case when idom = 2 then 0 when jdom < 2 then 1 else 2 end as segment from fx_tiles""")
def ordered_union(fx):
    return catalog.ordered_union([fx.tiles.where("idom = 2"), fx.tiles.where("jdom < 2"), fx.tiles], ["idom", "jdom"])


@query("t_07_expand_experiment", "tiles combos", "select idom, jdom, region, era, forest, return_period from fx_tiles, fx_combos where return_period in (30, 300)")
def expand_experiment(fx):
    return fx.tiles.select("idom", "jdom").crossJoin(fx.combos.where("return_period in (30, 300)"))


@query("t_08_expand_forest", "combos", """
select region, era, return_period, f as forest from fx_combos, (values ('For'), ('NoFor')) t(f)
where (return_period = 10 and f = forest) or (return_period <> 10 and forest = 'For')""")
def expand_forest(fx):
    known = fx.combos.where("return_period = 10 or forest = 'For'")
    spec = known.withColumn("forest", F.when(F.col("return_period") == 10, F.col("forest")))
    spec = spec.withColumn("forest", F.when(F.col("return_period") == 10, F.col("forest")))
    return catalog.expand_forest(spec).select("region", "era", "return_period", "forest")


@query("t_09_extent_of_tiles", "tiles", "select min(x0) - 3 as x0, min(y0) - 3 as y0, max(x1) + 3 as x1, max(y1) + 3 as y1 from fx_tiles where idom > 0")
def extent_of_tiles(fx):
    return catalog.extent_of(fx.tiles.where("idom > 0"), 3.0)


@query("t_10_label_columns", "tiles", """
select jdom, idom from (select *, row_number() over (partition by jdom order by idom) as k from fx_tiles where idom > 0) where k = 2""")
def label_columns(fx):
    return catalog.label_columns(fx.tiles.where("idom > 0"), 2)


@query("t_11_hash_split", "", """
select c_custkey as id, cast(('0x' || substr(sha256('ak-' || c_custkey), 1, 8))::bigint % 7 as int) as part from customer""")
def hash_split(fx):
    return fx.table("customer").select(F.col("c_custkey").alias("id"), catalog.hash_part(F.concat(F.lit("ak-"), F.col("c_custkey").cast("string")), 7).alias("part"))


@query("t_12_stride_and_section", "combos", """
r as (select *, row_number() over (order by region, era, forest, return_period) - 1 as k, count(*) over () as n from fx_combos)
select region, era, forest, return_period, cast(k % 3 as int) as stride, cast(k * 3 // n as int) as section from r""")
def stride_and_section(fx):
    order = Window.orderBy("region", "era", "forest", "return_period")  # a few combos of an experiment
    ranked = fx.combos.withColumn("k", F.row_number().over(order) - 1).withColumn("n", F.count("*").over(Window.partitionBy()))
    return ranked.select("region", "era", "forest", "return_period", catalog.stride_part(F.col("k"), 3).alias("stride"), catalog.section_part(F.col("k"), F.col("n"), 3).alias("section"))


@query("t_13_grid_shift", "tiles", "select idom, jdom, cast(round(-(-100 - x0) / 10) as int) as shift from fx_tiles")
def grid_shift(fx):
    return fx.tiles.select("idom", "jdom", F.round(-(-100.0 - F.col("x0")) / 10.0).cast("int").alias("shift"))


@query("p_01_wildcard_spec", "combos", "select * from fx_combos where era = 'past' and return_period = 30")
def wildcard_spec(fx):
    return fx.combos.where(catalog.spec_predicate(".-past-.-30", ["region", "era", "forest", "return_period"]))


@query("p_02_id_list", "pra", "select id, forest from fx_pra where id in (select o_orderkey from orders where o_orderstatus = 'P')")
def id_list(fx):
    ids = fx.table("orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"))
    return catalog.by_ids(fx.pra.select("id", "forest"), ids)


_SPECS = """
s as (select p_type || '-' || case when p_partkey % 5 = 0 then 'x' when p_partkey % 5 = 1 then '' else cast(p_partkey as varchar) end || '-' || p_size as spec from part)
"""


@query("p_03_validate_specs", "", _SPECS + """
select spec, count(*) as n, split_part(spec, '-', 1) in ('PROMO', 'SMALL', 'LARGE') and (split_part(spec, '-', 2) = '' or try_cast(split_part(spec, '-', 2) as int) is not null) as valid from s group by spec""")
def validate_specs(fx):
    k = F.col("p_partkey")
    middle = F.when(k % 5 == 0, "x").when(k % 5 == 1, "").otherwise(k.cast("string"))
    specs = fx.table("part").select(F.concat_ws("-", "p_type", middle, F.col("p_size").cast("string")).alias("spec")).groupBy("spec").agg(F.count("*").alias("n"))
    return catalog.validated(specs, {0: ("PROMO", "SMALL", "LARGE")}, (1, 2), (1,), 3)


@query("p_10_status_set", "status", "select id, chunkid from fx_status where id_status in (5, 6) or id_status <= 0")
def status_set(fx):
    return fx.status.where(F.col("id_status").isin(5, 6) | (F.col("id_status") <= 0)).select("id", "chunkid")


@query("p_11_ready_gate", "status", "select coalesce(bool_and(id_status >= 0), true) as ready from fx_status")
def ready_gate(fx):
    return status.all_ready(fx.status, 0)


@query("p_18_named_predicates", "status", """
select id, chunkid, true as p_all, false as p_none, id_status = 5 as p_overrun, chunkid > 0 as p_resubmitted from fx_status""")
def named_predicates(fx):
    return fx.status.select("id", "chunkid", *[p().alias(f"p_{n}") for n, p in catalog.PREDICATES.items()])


@query("a_03_forest_pairs", "combos", """
select region, era, return_period, string_agg(forest, ',' order by forest) as members from fx_combos group by all""")
def forest_pairs(fx):
    return fx.combos.groupBy("region", "era", "return_period").agg(F.array_join(F.sort_array(F.collect_set("forest")), ",").alias("members"))


@query("a_04_least_status", "status", "select id, min(id_status) filter (id_status <> 0) as status from fx_status group by 1")
def least_status(fx):
    return fx.status.groupBy("id").agg(status.least_status((0,)).alias("status"))


_FILES = """
f as (select o_orderkey as id, case when o_orderkey % 11 <> 0 then o_custkey end as in_ts, case when o_orderkey % 4 <> 0 then o_orderkey % 900 end as out_ts,
  case when o_orderkey % 3 = 0 then o_orderkey % 1000 end as arc_ts, o_orderkey % 6 as in_size, (o_orderkey // 2) % 5 as out_size,
  case when o_orderkey % 13 = 0 then 1 end as queue_status, o_orderstatus = 'F' as overran from orders)
"""


def _files(fx):
    k = F.col("o_orderkey")
    return fx.table("orders").select(
        k.alias("id"), F.when(k % 11 != 0, F.col("o_custkey")).alias("in_ts"), F.when(k % 4 != 0, k % 900).alias("out_ts"),
        F.when(k % 3 == 0, k % 1000).alias("arc_ts"), (k % 6).alias("in_size"), (F.floor(k / 2) % 5).alias("out_size"),
        F.when(k % 13 == 0, 1).alias("queue_status"), (F.col("o_orderstatus") == "F").alias("overran"))


_DERIVED = """case when in_ts is null then 2 when queue_status is not null then queue_status when arc_ts > out_ts and out_ts > in_ts then 6
  when out_ts is null then 0 when in_size = 0 and out_size = 0 then 6 when out_size = 0 then 0 when overran then 5 else 6 end"""


@query("a_05_derive_status", "", _FILES + f"select id, {_DERIVED} as id_status from f")
def derive_status(fx):
    return _files(fx).select("id", status.derived_status().alias("id_status"))


@query("a_06_quick_status", "", """
g as (select o_custkey as combo, bool_or(o_orderstatus = 'F') as archived, bool_and(o_orderkey % 5 <> 0) as all_extents, bool_or(o_orderkey % 9 = 0) as has_dir, bool_and(o_orderkey % 2 = 0) as all_empty from orders group by 1)
select combo, case when archived and all_extents then 9 when archived then 7 when not has_dir then 2 when all_empty then 6 else 10 end as quick from g""")
def quick_status(fx):
    k = F.col("o_orderkey")
    flags = fx.table("orders").groupBy(F.col("o_custkey").alias("combo")).agg(
        F.bool_or(F.col("o_orderstatus") == "F").alias("archived"), F.bool_and(k % 5 != 0).alias("all_extents"),
        F.bool_or(k % 9 == 0).alias("has_dir"), F.bool_and(k % 2 == 0).alias("all_empty"))
    return flags.select("combo", status.quick_status().alias("quick"))


@query("a_07_completion", "", """
select o_custkey as chunk, bool_and(o_orderkey in (select l_orderkey from lineitem where l_linenumber >= 2)) as complete from orders group by 1""")
def completion(fx):
    expected = fx.table("orders").select(F.col("o_orderkey").alias("file"), F.col("o_custkey").alias("chunk"))
    present = fx.table("lineitem").where("l_linenumber >= 2").select(F.col("l_orderkey").alias("file"))
    return status.completed(expected, present, "file", "chunk")


@query("a_08_finished_tiles", "tiles dem", """
select t.idom, t.jdom, coalesce(n, 0) as n from fx_tiles t left join (select cast(i // 10 as int) as idom, cast(j // 10 as int) as jdom, count(*) as n from fx_dem where landcover = 41 and i < 30 group by 1, 2) using (idom, jdom)""")
def finished_tiles(fx):
    done = fx.dem.where("landcover = 41 and i < 30").groupBy(F.floor(F.col("i") / 10).cast("int").alias("idom"), F.floor(F.col("j") / 10).cast("int").alias("jdom")).agg(F.count("*").alias("n"))
    return fx.tiles.select("idom", "jdom").join(done, ["idom", "jdom"], "left").fillna(0, ["n"])


@query("a_09_status_listing", "status", "select chunkid, id_status, string_agg(cast(id as varchar), ',' order by id) as ids from fx_status group by 1, 2")
def status_listing(fx):
    return status.listing(fx.status, ["chunkid"]).withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))


@query("a_29_group_releases", "", """
select o_custkey as output, case when count(distinct o_orderstatus) = 1 then min(o_orderstatus) end as status,
  case when count(distinct o_orderpriority) = 1 then min(o_orderpriority) end as priority from orders group by 1""")
def group_releases(fx):
    rows = fx.table("orders").select(F.col("o_custkey").alias("output"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return status.common_or_null(rows, "output", ["status", "priority"])


@query("a_30_progress", "jobs", """
l as (select id, max(ts) as ts, arg_max(id_status, (ts, id_status)) as id_status from fx_jobs group by 1),
p as (select 'done' as kind, null::bigint as id, count(*) filter (id_status >= 6) as n from l union all select 'todo', null, count(*) filter (id_status < 6) from l
  union all select 'recent', id, 1 from l where id_status >= 6 and ts > timestamp '2024-01-30 22:00:00' - interval 24 hours)
select * from p union all select 'next', id, 1 from (select id from l where id_status < 6 order by id limit 5)""")
def progress(fx):
    latest = fx.jobs.groupBy("id").agg(F.max("ts").alias("ts"), F.max_by("id_status", F.struct("ts", "id_status")).alias("id_status"))
    return status.progress(latest, F.to_timestamp(F.lit("2024-01-30 22:00:00")))


@query("a_31_empty_combos", "", "select o_custkey as combo, bool_and(o_orderkey % 3 = 0) as empty from orders group by 1")
def empty_combos(fx):
    files = fx.table("orders").select(F.col("o_custkey").alias("combo"), (F.col("o_orderkey") % 3).alias("size"))
    return status.is_empty(files, "combo")


@query("a_33_status_rollup", "jobs", """
select id % 5 as exp, id % 25 as combo, chunkid, min(id_status) as status, count(*) as n, cast(grouping(id % 5, id % 25, chunkid) as bigint) as level
from fx_jobs group by rollup (id % 5, id % 25, chunkid)""")
def status_rollup(fx):
    rows = fx.jobs.select((F.col("id") % 5).alias("exp"), (F.col("id") % 25).alias("combo"), "chunkid", "id_status")
    return status.rolled_up(rows, ["exp", "combo", "chunkid"])


@query("w_03_last_chunk", "status", "select id, max(chunkid) as chunkid, arg_max(id_status, chunkid) as id_status from fx_status group by 1")
def last_chunk(fx):
    return status.last_chunk(fx.status, ["id"])


@query("w_04_repaired_overruns", "status", """
s as (select id, chunkid, case when id_status = 1 then 5 else id_status end as id_status from fx_status),
d as (select *, count(*) over (partition by id) as n, row_number() over (partition by id order by chunkid desc) as k from s where id_status in (5, 6))
select id, chunkid, case when n > 1 and k = 1 and id_status = 5 then 6 else id_status end as id_status from d
union all select * from s where id_status not in (5, 6)""")
def repaired_overruns(fx):
    rows = fx.status.withColumn("id_status", F.when(F.col("id_status") == 1, 5).otherwise(F.col("id_status")))
    return status.repaired_overruns(rows, ["id"])


_RUNS = """
r as (select b.aval_id as id, b.aval_id % 40 as combo, cast(c as int) as chunkid, case when b.aval_id % 40 = 3 and c = 0 then 0 when (b.aval_id // 40 + c) % 3 = 0 then 6 else 5 end as id_status, x0, y0, x1, y1
  from fx_boxes b, (values (0), (1)) t(c))
"""


def _runs(fx):
    k, c = F.col("aval_id"), F.col("chunkid")
    rows = fx.boxes.withColumn("chunkid", F.explode(F.array(F.lit(0), F.lit(1))))
    state = F.when((k % 40 == 3) & (c == 0), 0).when((F.floor(k / 40) + c) % 3 == 0, 6).otherwise(5)
    return rows.select(k.alias("id"), (k % 40).alias("combo"), "chunkid", state.alias("id_status"), "x0", "y0", "x1", "y1")


@query("v_05_resubmission", "boxes", _RUNS + """
select combo, id, 2 as chunkid, x0 - 2500 as x0, y0 - 2500 as y0, x1 + 2500 as x1, y1 + 2500 as y1
from r where chunkid = 1 and id_status = 5 and combo not in (select combo from r group by 1 having min(id_status) < 5)""")
def resubmission(fx):
    return status.to_resubmit(_runs(fx), ["combo"])


_BOXED_RUNS = """
r as (select aval_id as id, cast(floor(x0 / 10) as int) as idom, cast(floor(y0 / 10) as int) as jdom, x0, y0, x1, y1, case when aval_id % 3 = 0 then 6 when aval_id % 3 = 1 then 5 else 0 end as id_status from fx_boxes)
"""


def _boxed_runs(fx):
    k = F.col("aval_id")
    return fx.boxes.select(k.alias("id"), F.floor(F.col("x0") / 10).cast("int").alias("idom"), F.floor(F.col("y0") / 10).cast("int").alias("jdom"),
                           "x0", "y0", "x1", "y1", F.when(k % 3 == 0, 6).when(k % 3 == 1, 5).otherwise(0).alias("id_status"))


_ANSWER = ("region", "era", "forest", "return_period", "id")


@query("v_07_area_query", "boxes tiles combos", _BOXED_RUNS + """,
t as (select idom, jdom from fx_tiles where x0 - 3 <= 18 and x1 + 3 >= 12 and y0 - 3 <= 9 and y1 + 3 >= 4)
select region, era, forest, return_period, id from fx_combos, t join r using (idom, jdom)
where return_period = 30 and id_status in (5, 6) and x0 <= 18 and x1 >= 12 and y0 <= 9 and y1 >= 4""")
def area_query(fx):
    combos = fx.combos.where("return_period = 30")
    return status.area_query(fx.tiles, combos, _boxed_runs(fx), "glacier", 3.0, (5, 6), named={"glacier": (12, 4, 18, 9)}).select(*_ANSWER)


@query("v_07_area_of_tiles", "boxes tiles combos", _BOXED_RUNS + """,
ch as (select * from r where id % 500 = 3 and x0 >= 20),
e as (select distinct t.* from fx_tiles t join ch using (idom, jdom)),
s as (select * exclude (x0, y0, x1, y1) from fx_tiles t where exists (select 1 from e where t.x0 <= e.x1 + 3 and t.x1 >= e.x0 - 3 and t.y0 <= e.y1 + 3 and t.y1 >= e.y0 - 3))
select region, era, forest, return_period, id from fx_combos, s join r using (idom, jdom)
where return_period = 30 and not (era = 'past' and (idom + jdom) % 4 = 1) and id_status in (5, 6)
  and exists (select 1 from e where r.x0 <= e.x1 and r.x1 >= e.x0 and r.y0 <= e.y1 and r.y1 >= e.y0)""")
def area_of_tiles(fx):
    combos, runs = fx.combos.where("return_period = 30"), _boxed_runs(fx)
    # with force, scenarios that are not ready are left out
    ready = F.when((F.col("era") == "past") & ((F.col("idom") + F.col("jdom")) % 4 == 1), 4).otherwise(6)
    state = combos.crossJoin(fx.tiles.select("idom", "jdom")).withColumn("combo_status", ready)
    chosen = runs.where("id % 500 = 3 and x0 >= 20")
    return status.area_query(fx.tiles, combos, runs, "tile", 3.0, (5, 6), chosen=chosen, combo_status=state, least=5, force=True).select(*_ANSWER)


#: A registered experiment: two sets of scenarios, sizes by forest, and runs that never end.
_SAMPLE = catalog.register_experiment(
    catalog.Experiment(
        "sample",
        ("idom", "jdom", "era", "forest", "return_period"),
        mosaic_filter=lambda extents: extents.where("mean_dem >= 300"),
        sizes={"For": ("S", "T"), "NoFor": ("L", "M")},
        ignored=lambda spark: spark.createDataFrame([("past", 0)], "era string, digit int"),
        sets={
            "rare": lambda tiles: tiles.crossJoin(tiles.sparkSession.createDataFrame([(e, f, 300) for e in ("past", "future") for f in ("For", "NoFor")], "era string, forest string, return_period int")),
            "all": lambda tiles: tiles.crossJoin(tiles.sparkSession.createDataFrame([(e, f, p) for e in ("past", "future") for f in ("For", "NoFor") for p in (30, 300)], "era string, forest string, return_period int")),
        },
    )
)


@query("f_01_experiment_runs", "dem pra tiles", """
a as (select id, cast(i // 10 as int) as idom, cast(j // 10 as int) as jdom, forest, case id % 4 when 0 then 'S' when 1 then 'L' when 2 then 'T' else 'M' end as pra_size, mean_dem, cast(id % 10 as int) as digit from fx_pra join fx_dem using (cell)),
s as (select idom, jdom, era, f as forest, z as pra_size from fx_tiles, (values ('past'), ('future')) e(era), (values ('For', 'S'), ('For', 'T'), ('NoFor', 'L'), ('NoFor', 'M')) z(f, z))
select 'sample' as exp, idom, jdom, era, forest, 300 as return_period, pra_size, id from s join a using (idom, jdom, forest, pra_size) where not (era = 'past' and digit = 0) and mean_dem >= 300""")
def experiment_runs(fx):
    key = F.col("id")
    size = F.element_at(F.array(*map(F.lit, "SLTM")), (key % 4 + 1).cast("int"))
    tile = [F.floor(F.col(c) / 10).cast("int").alias(t) for c, t in (("i", "idom"), ("j", "jdom"))]
    areas = fx.pra.join(fx.dem, "cell").select("id", *tile, "forest", size.alias("pra_size"), "mean_dem", (key % 10).cast("int").alias("digit"))
    own = catalog.EXPERIMENTS["sample"]
    return own.mosaic_filter(own.runs("rare", fx.tiles.select("idom", "jdom"), areas)).select("exp", *own.keys, "pra_size", "id")


@query("j_04_left_status", "status", """
select o_orderkey as id, coalesce(s.id_status, 2) as id_status from orders o left join fx_status s on s.id = o.o_orderkey and s.chunkid = 1""")
def left_status(fx):
    cat = fx.table("orders").select(F.col("o_orderkey").alias("id"))
    return status.with_status(cat, fx.status.where("chunkid = 1").select("id", "id_status"), ["id"])


@query("j_05_ignored_ids", "status", "select id, chunkid, id_status from fx_status where id not in (select n_nationkey from nation)")
def ignored_ids(fx):
    ignored = fx.table("nation").select(F.col("n_nationkey").cast("long").alias("id"))
    return fx.status.join(ignored, "id", "left_anti")


@query("j_10_combos_by_tiles", "combos tiles", "select * from fx_combos, (select idom, jdom from fx_tiles where x0 <= 18 and x1 >= 12)")
def combos_by_tiles(fx):
    return fx.combos.crossJoin(fx.tiles.where("x0 <= 18 and x1 >= 12").select("idom", "jdom"))


@query("j_16_status_diff", "jobs", """
a as (select id, arg_max(id_status, (ts, id_status)) as s from fx_jobs where ts < timestamp '2024-01-15' group by 1),
b as (select id, arg_max(id_status, (ts, id_status)) as s from fx_jobs group by 1)
select a.id, a.s as id_status from a left join b using (id) where a.s = b.s""")
def status_diff(fx):
    state = F.max_by("id_status", F.struct("ts", "id_status"))
    before = fx.jobs.where("ts < timestamp '2024-01-15'").groupBy("id").agg(state.alias("id_status"))
    after = fx.jobs.groupBy("id").agg(state.alias("after"))
    return before.join(after, "id", "left").where("id_status = after").select("id", "id_status")


@query("j_17_outdated", "", _FILES + "select id from f where in_ts is not null and (out_ts is null or in_ts > out_ts)")
def outdated(fx):
    files = _files(fx)
    sources = files.where("in_ts is not null").select("id", F.col("in_ts").alias("src_ts"))
    return status.outdated(sources, files.where("out_ts is not null").select("id", "out_ts"), "id")


@query("j_18_queue_status", "", _FILES + f"select id, {_DERIVED} as id_status from f")
def queue_status(fx):
    files = _files(fx)
    queue = files.where("queue_status is not null").select("id", "queue_status")
    outputs = files.where("out_ts is not null").select("id", "out_ts", "out_size", "overran")
    archive = files.where("arc_ts is not null").select("id", "arc_ts")
    rows = files.select("id", "in_ts", "in_size").join(queue, "id", "left").join(outputs, "id", "left").join(archive, "id", "left")
    return rows.select("id", status.derived_status().alias("id_status"))


@query("l_01_sorted_runs", "status", "select id, chunkid, id_status from fx_status")
def sorted_runs(fx):
    return fx.status.orderBy("id", "chunkid")


@query("l_02_head", "pra", "select id, area_m2 from fx_pra order by area_m2 desc, id limit 20")
def head(fx):
    return fx.pra.select("id", "area_m2").orderBy(F.desc("area_m2"), "id").limit(20)


@query("u_01_concat", "status", "select id, chunkid from fx_status where chunkid = 0 union all select id, chunkid from fx_status where chunkid > 0")
def concat(fx):
    keys = fx.status.select("id", "chunkid")
    return keys.where("chunkid = 0").unionByName(keys.where("chunkid > 0"))


@query("u_02_distinct_keys", "combos", "select distinct region, era, return_period from fx_combos")
def distinct_keys(fx):
    return fx.combos.select("region", "era", "return_period").distinct()


@query("u_03_missing_inputs", "", "select o_orderkey as id from orders except select l_orderkey from lineitem")
def missing_inputs(fx):
    return fx.table("orders").select(F.col("o_orderkey").alias("id")).exceptAll(fx.table("lineitem").select(F.col("l_orderkey").alias("id")).distinct())


@query("u_04_common_tiles", "dem", "select distinct i, landcover from fx_dem where j < 10 intersect select distinct i, landcover from fx_dem where j >= 30")
def common_tiles(fx):
    keys = fx.dem.select("i", "landcover")
    return keys.where(fx.dem["j"] < 10).intersect(fx.dem.where("j >= 30").select("i", "landcover"))


@query("x_01_spiral", "dem", """
n as (select cell, i - 25 as x, j - 20 as y from fx_dem)
select cell, cast(4 * greatest(abs(x), abs(y)) * greatest(abs(x), abs(y)) + (case when x < y then -1 else 1 end) * (2 * greatest(abs(x), abs(y)) + x + y) as int) as n, x, y from n""")
def spiral(fx):
    n = G.spiral_number(F.col("i") - 25, F.col("j") - 20)
    x, y = G.spiral_cell(F.col("n"))
    return fx.dem.select("cell", n.alias("n")).select("cell", "n", x.alias("x"), y.alias("y"))


@query("x_02_neighbour_index", "dem", """
select cell, case when cell % 17 = 0 then -1 else (cell * 7) % 2000 end as back, case when cell % 17 = 0 then -1 else 1 end as sign from fx_dem""")
def neighbour_index(fx):
    other = F.when(F.col("cell") % 17 == 0, -1).otherwise((F.col("cell") * 7) % 2000)
    rows = fx.dem.select("cell", G.relative_neighbour(F.col("cell"), other, 50).alias("n"))
    return rows.select("cell", G.absolute_neighbour(F.col("cell"), F.col("n"), 50).alias("back"), F.when(F.col("n") < 0, -1).otherwise(1).alias("sign"))


@query("x_03_cell_coordinates", "dem", "select cell, 100 + (i + 0.5::double) * 10 as x, 900 + (j + 0.5::double) * -10 as y, i, j from fx_dem")
def cell_coordinates(fx):
    g = G.Grid(100.0, 10.0, 900.0, -10.0, 50, 40)
    x, y = G.cell_to_xy(F.col("i"), F.col("j"), g)
    i, j = G.xy_to_cell(F.col("x"), F.col("y"), g)
    return fx.dem.select("cell", x.alias("x"), y.alias("y")).select("cell", "x", "y", i.alias("i"), j.alias("j"))


def _ring(fx):
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    return fx.boxes.select("aval_id", "x0", "y0", "x1", "y1", G.points((x0, y0), (x1, y0 + 1), (x1 - 1, y1 + 2), (x0 - 1, y1)).alias("ring"))


@query("x_04_edge_lengths", "boxes", """
select aval_id, round(sqrt((x1 - x0) ** 2 + 1), 6) as e1, round(sqrt(1 + (y1 + 1 - y0) ** 2), 6) as e2, round(sqrt((x1 - x0) ** 2 + 4), 6) as e3, round(sqrt(1 + (y1 - y0) ** 2), 6) as e4 from fx_boxes""")
def edge_lengths(fx):
    e = G.edge_lengths(F.col("ring"))
    return _ring(fx).select("aval_id", *[F.round(F.element_at(e, k), 6).alias(f"e{k}") for k in (1, 2, 3, 4)])


@query("x_05_grown_rectangle", "boxes", """
select aval_id, case when x1 - x0 >= 4 and y1 - y0 >= 4 then round(x0 + 2, 6) end as ax, case when x1 - x0 >= 4 and y1 - y0 >= 4 then round(y1 - 2, 6) end as cy from fx_boxes""")
def grown_rectangle(fx):
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    grown = G.grown_rectangle(G.points((x0, y0), (x1, y0), (x1, y1), (x0, y1)), F.lit(-4.0))
    return fx.boxes.select("aval_id", F.round(F.element_at(grown, 1)["x"], 6).alias("ax"), F.round(F.element_at(grown, 3)["y"], 6).alias("cy"))


@query("x_06_box_margin", "boxes", "select aval_id, x0 - 7 as x0, y0 - 7 as y0, x1 + 7 as x1, y1 + 7 as y1 from fx_boxes")
def box_margin(fx):
    c = G.box_with_margin(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), 7.0)
    return fx.boxes.select("aval_id", *[v.alias(n) for v, n in zip(c, ("x0", "y0", "x1", "y1"), strict=True)])


@query("x_07_centroid_and_area", "boxes", """
p as (select aval_id, unnest([{k: 1, x: x0, y: y0, u: x1, v: y0 + 1}, {k: 2, x: x1, y: y0 + 1, u: x1 - 1, v: y1 + 2}, {k: 3, x: x1 - 1, y: y1 + 2, u: x0 - 1, v: y1}, {k: 4, x: x0 - 1, y: y1, u: x0, v: y0}]) as e from fx_boxes),
s as (select aval_id, sum(e.x * e.v - e.u * e.y) as c, sum((e.x * e.v - e.u * e.y) * (e.x + e.u)) as cx, sum((e.x * e.v - e.u * e.y) * (e.y + e.v)) as cy from p group by 1)
select aval_id, round(abs(c) / 2, 4) as area, round(cx / (3 * c), 4) as cx, round(cy / (3 * c), 4) as cy from s""")
def centroid_and_area(fx):
    cx, cy = G.ring_centroid(F.col("ring"))
    return _ring(fx).select("aval_id", F.round(G.ring_area(F.col("ring")), 4).alias("area"), F.round(cx, 4).alias("cx"), F.round(cy, 4).alias("cy"))


@query("x_12_albers", "dem", f"""
r as (select cell, radians(-170 + i * 0.8::double) as lon, sin(radians(52 + j * 0.4::double)) as s from fx_dem),
q as (select cell, lon, {1 - G.ALBERS["e2"]!r}::double * (s / (1 - {G.ALBERS["e2"]!r}::double * s * s) - ln((1 - {G.ALBERS["e"]!r}::double * s) / (1 + {G.ALBERS["e"]!r}::double * s)) / {2 * G.ALBERS["e"]!r}::double) as q from r),
p as (select cell, {G.ALBERS["a"]!r}::double * sqrt({G.ALBERS["c"]!r}::double - {G.ALBERS["n"]!r}::double * q) / {G.ALBERS["n"]!r}::double as rho, {G.ALBERS["n"]!r}::double * (lon - {G.ALBERS["lon0"]!r}::double) as th from q)
select cell, round(rho * sin(th), 3) as x, round({G.ALBERS["rho0"]!r}::double - rho * cos(th), 3) as y from p""")
def albers(fx):
    x, y = G.albers(-170 + F.col("i") * 0.8, 52 + F.col("j") * 0.4)
    return fx.dem.select("cell", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("x_13_name_parts", "", """
select o_orderkey as id, trim(split_part(o_orderpriority, '-', 2)) as word, regexp_extract(o_orderpriority, '([0-9]+)', 1) as digit from orders""")
def name_parts(fx):
    p = F.col("o_orderpriority")
    return fx.table("orders").select(F.col("o_orderkey").alias("id"), F.trim(F.split_part(p, F.lit("-"), F.lit(2))).alias("word"), F.regexp_extract(p, "([0-9]+)", 1).alias("digit"))


@query("x_14_timestamps", "jobs", """
select id, chunkid, strftime(ts, '%Y-%m-%dT%H:%M:%S') as iso, cast(floor(epoch(timestamp '2024-03-01') - floor(epoch(ts))) as bigint) as age from fx_jobs""")
def timestamps(fx):
    return fx.jobs.select("id", "chunkid", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), (F.unix_timestamp(F.lit("2024-03-01 00:00:00")) - F.unix_timestamp("ts")).alias("age"))
