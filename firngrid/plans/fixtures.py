"""Views over the test tables that have the schemas of the hazard tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firngrid.sources.shared import dealt
from firngrid.sources.tables import read_table

#: Columns of the cell grid.
GRID_NX = 50

#: DuckDB form of each view: the views it uses, and its text.
VIEW_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "dem": ((), """
select p_partkey as cell, cast(p_partkey % 50 as int) as i, cast(p_partkey // 50 as int) as j,
  p_size * 20.0::double + (p_retailprice - 900.0::double) as elev,
  case p_type when 'PROMO' then 11 when 'ECONOMY' then 12 when 'STANDARD' then 41
    when 'SMALL' then 42 when 'LARGE' then 43 else 52 end as landcover from part"""),
    "aval": ((), """
select l_orderkey as aval_id, l_partkey as cell, cast(l_partkey % 50 as int) as i,
  cast(l_partkey // 50 as int) as j, max(l_quantity) as max_vel,
  max(round(l_discount * 10, 4)) as max_height, max(round(l_tax * 10, 4)) as depo,
  max(l_linenumber) as chunkid from lineitem group by 1, 2, 3, 4"""),
    "pra": ((), """
select o_orderkey as id, o_custkey as cell, o_totalprice / 10 as area_m2,
  cast((o_orderkey * 7) % 1200 as double) as mean_dem,
  cast(28 + o_orderkey % 28 as double) as mean_slope,
  case when o_orderkey % 2 = 0 then 'For' else 'NoFor' end as forest,
  cast((o_orderkey % 97) * 5 as double) as swe from orders"""),
    "jobs": ((), """
select user_id as id, cast(day(ts) // 10 as int) as chunkid, ts,
  case event_type when 'view' then 0 when 'click' then 1 when 'error' then 4
    when 'signup' then 5 else 6 end as id_status from events"""),
    "status": (("jobs",), """
select id, chunkid, arg_max(id_status, (ts, id_status)) as id_status from fx_jobs group by 1, 2"""),
    "snow": ((), """
select user_id as cell, cast(ts as date) as day, sum(value) as acsnow from events group by 1, 2"""),
    "annual": ((), """
select o_custkey as cell, cast(o_orderdate as date) as day, o_totalprice as v from orders"""),
    "combos": ((), """
select distinct r_name as region, case when month(o_orderdate) < 7 then 'past' else 'future' end as era,
  case when o_totalprice < 150000 then 'For' else 'NoFor' end as forest,
  case o_orderkey % 4 when 0 then 10 when 1 then 30 when 2 then 100 else 300 end as return_period
from orders join region on r_regionkey = o_custkey % 5"""),
    "tiles": (("dem",), """
select distinct cast(i // 10 as int) as idom, cast(j // 10 as int) as jdom,
  cast((i // 10) * 10 as double) as x0, cast((j // 10) * 10 as double) as y0,
  cast((i // 10) * 10 + 10 as double) as x1, cast((j // 10) * 10 + 10 as double) as y1 from fx_dem"""),
    "boxes": (("aval",), """
select aval_id, min(i)::double as x0, min(j)::double as y0, max(i)::double + 1 as x1,
  max(j)::double + 1 as y1 from fx_aval group by 1"""),
    "names": ((), """
select l_orderkey as id, l_linenumber as chunk, case l_linenumber % 4 when 0 then 'T' when 1 then 'S' when 2 then 'M' else 'L' end as size,
  l_returnflag as flag, l_partkey as part from lineitem"""),
}


class Fixtures:
    """The views of one data folder, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        """A table of the folder."""
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def dem(self) -> DataFrame:
        """Terrain cells: cell, i, j, elev, landcover."""
        code = F.col("p_type")
        return self.table("part").select(
            F.col("p_partkey").alias("cell"),
            (F.col("p_partkey") % GRID_NX).cast("int").alias("i"),
            F.floor(F.col("p_partkey") / GRID_NX).cast("int").alias("j"),
            (F.col("p_size") * 20.0 + (F.col("p_retailprice") - 900.0)).alias("elev"),
            F.when(code == "PROMO", 11)
            .when(code == "ECONOMY", 12)
            .when(code == "STANDARD", 41)
            .when(code == "SMALL", 42)
            .when(code == "LARGE", 43)
            .otherwise(52)
            .alias("landcover"),
        )

    @cached_property
    def aval(self) -> DataFrame:
        """Avalanche cells: aval_id, cell, i, j, max_vel, max_height, depo, chunkid.

        Hardly any rows have one cell, so they are dealt before they are grouped: a group table
        of a task is as large as the rows it gets, and a file's part would be as large as the file.
        """
        return (
            dealt(self.table("lineitem"), "l_orderkey", "l_partkey")
            .groupBy(
                F.col("l_orderkey").alias("aval_id"),
                F.col("l_partkey").alias("cell"),
                (F.col("l_partkey") % GRID_NX).cast("int").alias("i"),
                F.floor(F.col("l_partkey") / GRID_NX).cast("int").alias("j"),
            )
            .agg(
                F.max("l_quantity").alias("max_vel"),
                F.max(F.round(F.col("l_discount") * 10, 4)).alias("max_height"),
                F.max(F.round(F.col("l_tax") * 10, 4)).alias("depo"),
                F.max("l_linenumber").alias("chunkid"),
            )
        )

    @cached_property
    def pra(self) -> DataFrame:
        """Release areas: id, cell, area_m2, mean_dem, mean_slope, forest, swe."""
        key = F.col("o_orderkey")
        return self.table("orders").select(
            key.alias("id"),
            F.col("o_custkey").alias("cell"),
            (F.col("o_totalprice") / 10).alias("area_m2"),
            ((key * 7) % 1200).cast("double").alias("mean_dem"),
            (28 + key % 28).cast("double").alias("mean_slope"),
            F.when(key % 2 == 0, "For").otherwise("NoFor").alias("forest"),
            ((key % 97) * 5).cast("double").alias("swe"),
        )

    @cached_property
    def jobs(self) -> DataFrame:
        """Status events: id, chunkid, ts, id_status."""
        kind = F.col("event_type")
        return self.table("events").select(
            F.col("user_id").alias("id"),
            F.floor(F.dayofmonth("ts") / 10).cast("int").alias("chunkid"),
            "ts",
            F.when(kind == "view", 0)
            .when(kind == "click", 1)
            .when(kind == "error", 4)
            .when(kind == "signup", 5)
            .otherwise(6)
            .alias("id_status"),
        )

    @cached_property
    def status(self) -> DataFrame:
        """The latest status of each (id, chunkid)."""
        return self.jobs.groupBy("id", "chunkid").agg(
            F.max_by("id_status", F.struct("ts", "id_status")).alias("id_status")
        )

    @cached_property
    def snow(self) -> DataFrame:
        """Daily snow: cell, day, acsnow."""
        return (
            self.table("events")
            .groupBy(F.col("user_id").alias("cell"), F.to_date("ts").alias("day"))
            .agg(F.sum("value").alias("acsnow"))
        )

    @cached_property
    def annual(self) -> DataFrame:
        """Values to take block maxima of: cell, day, v."""
        return self.table("orders").select(
            F.col("o_custkey").alias("cell"),
            F.to_date("o_orderdate").alias("day"),
            F.col("o_totalprice").alias("v"),
        )

    @cached_property
    def combos(self) -> DataFrame:
        """Scenarios that orders have: region, era, forest, return_period."""
        period = F.element_at(F.array(*[F.lit(t) for t in (10, 30, 100, 300)]), (F.col("o_orderkey") % 4 + 1).cast("int"))
        return (
            self.table("orders")
            .withColumn("r_regionkey", F.col("o_custkey") % 5)
            .join(self.table("region"), "r_regionkey")
            .select(
                F.col("r_name").alias("region"),
                F.when(F.month("o_orderdate") < 7, "past").otherwise("future").alias("era"),
                F.when(F.col("o_totalprice") < 150000, "For").otherwise("NoFor").alias("forest"),
                period.alias("return_period"),
            )
            .distinct()
        )

    @cached_property
    def tiles(self) -> DataFrame:
        """Tiles of 10 x 10 cells: idom, jdom, x0, y0, x1, y1."""
        it, jt = F.floor(F.col("i") / 10).cast("int"), F.floor(F.col("j") / 10).cast("int")
        return self.dem.select(it.alias("idom"), jt.alias("jdom")).distinct().select(
            "idom",
            "jdom",
            (F.col("idom") * 10.0).alias("x0"),
            (F.col("jdom") * 10.0).alias("y0"),
            (F.col("idom") * 10.0 + 10).alias("x1"),
            (F.col("jdom") * 10.0 + 10).alias("y1"),
        )

    @cached_property
    def boxes(self) -> DataFrame:
        """Bounding boxes of avalanches: aval_id, x0, y0, x1, y1.

        Repeated cells do not change a box, so rows are grouped once. They are dealt by avalanche, and
        tasks have as many boxes each whatever their bytes are.
        """
        i, j = (F.col("l_partkey") % GRID_NX).cast("int"), F.floor(F.col("l_partkey") / GRID_NX).cast("int")
        return dealt(self.table("lineitem").select("l_orderkey", "l_partkey"), "l_orderkey").groupBy(F.col("l_orderkey").alias("aval_id")).agg(
            F.min(i).cast("double").alias("x0"),
            F.min(j).cast("double").alias("y0"),
            (F.max(i).cast("double") + 1).alias("x1"),
            (F.max(j).cast("double") + 1).alias("y1"),
        )

    @cached_property
    def names(self) -> DataFrame:
        """Parts of file names: id, chunk, size, flag, part."""
        letter = F.element_at(
            F.array(*[F.lit(x) for x in "TSML"]), (F.col("l_linenumber") % 4 + 1).cast("int")
        )
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("id"),
            F.col("l_linenumber").alias("chunk"),
            letter.alias("size"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_partkey").alias("part"),
        )
