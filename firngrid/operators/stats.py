"""Statistics of map layers by elevation class and resolution."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firngrid.sources.shared import staged

# Elevation classes; the first set overlaps, the second has open ends.
CLASSES = (("040", 0.0, 40.0), ("160", 0.0, 160.0), ("8000", 160.0, 8000.0), ("full", 0.0, 8000.0))
CLASSES_1 = (
    ("0", None, 20.0), ("20", 20.0, 40.0), ("40", 40.0, 80.0), ("80", 80.0, 200.0), ("200", 200.0, 300.0), ("300", 300.0, None),
)


def class_table(spark: SparkSession, classes) -> DataFrame:
    """``label, low, high``; a null bound is open."""
    return spark.createDataFrame(list(classes), "label string, low double, high double")


def classed(cells: DataFrame, value: str, classes: DataFrame) -> DataFrame:
    """A row for each cell and class it is in: low <= value < high. The class table is tiny."""
    v = F.col(value)
    inside = (F.col("low").isNull() | (v >= F.col("low"))) & (F.col("high").isNull() | (v < F.col("high")))
    return cells.join(F.broadcast(classes), inside).drop("low", "high")


def present(n: Column) -> Column:
    """A count as 0 or 1."""
    return F.least(F.coalesce(n, F.lit(0)), F.lit(1))


def by_class_and_size(cells: DataFrame, classes: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """Cells of land, share of them hit, and mean snow, by class and coarse cell at all sizes at once.

    ``cells`` has ``i, j, elev, hit, snow``. Sea (elev <= 0) is left out.
    """
    land = classed(cells.where("elev > 0"), "elev", classes)
    each = land.withColumn("size", F.explode(F.array(*[F.lit(s) for s in sizes])))
    total = F.count("*")
    return each.groupBy(
        "label", "size", F.floor(F.col("i") / F.col("size")).cast("int").alias("ci"), F.floor(F.col("j") / F.col("size")).cast("int").alias("cj")
    ).agg(total.alias("n_land"), (F.sum("hit") / total).alias("hit_share"), (F.sum("snow") / total).alias("snow_mean"))


def difference(layers: DataFrame, key: list[str], scenario: str, later: str, earlier: str, value: str) -> DataFrame:
    """``later - earlier`` for each cell that both scenarios have."""
    take = lambda s: F.max(F.when(F.col(scenario) == s, F.col(value)))
    return layers.groupBy(*key).agg((take(later) - take(earlier)).alias("difference")).where("difference is not null")


def correlations(layers: DataFrame, names: list[str]) -> DataFrame:
    """``a, b, r`` for each pair of layers, over the cells where all are known."""
    known = layers.where(reduce(lambda x, y: x & y, [F.col(n).isNotNull() for n in names]))
    pairs = list(combinations(names, 2))
    row = known.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    return row.select(
        F.inline(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs]))
    )


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """``keys, n`` and, for each ``name: share``, the exact quantile of the known values, between ranks linearly.

    Distinct values are counted and dealt by ranges of key and value. The totals of the ranges
    tell in which of them a rank lies, and only there values are ranked. So no task holds a
    whole group, however few groups there are. Rows with a null key are left out.
    """
    spark = rows.sparkSession
    v = F.col(value).cast("double")
    counted = rows.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, v.alias("_v")).agg(F.count("*").alias("_n"))
    dealt = counted.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, "_v")
    ranges = staged(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    # a row for each group and range that it reaches into
    totals = ranges.groupBy(*keys, "_range").agg(F.sum("_n").alias("_total"))
    before = F.sum("_total").over(Window.partitionBy(*keys).orderBy("_range")) - F.col("_total")
    totals = totals.withColumns({"_before": before, "n": F.sum("_total").over(Window.partitionBy(*keys))})
    each = F.array(*[F.struct(F.lit(name).alias("_name"), F.lit(float(share)).alias("_share")) for name, share in shares.items()])
    at = totals.select("*", F.inline(each)).withColumn("_at", F.col("_share") * (F.col("n") - 1))
    ranks = at.withColumn("_rank", F.explode(F.array(F.floor("_at"), F.ceil("_at")))).where("_rank >= _before and _rank < _before + _total").distinct()
    through = F.sum("_n").over(Window.partitionBy(*keys, "_range").orderBy("_v"))
    met = ranges.join(ranks.select(*keys, "_range").distinct(), [*keys, "_range"], "left_semi").withColumn("_through", through)
    found = ranks.join(met, [*keys, "_range"]).where("_rank - _before < _through and _rank - _before >= _through - _n")
    low, high = F.min("_v"), F.max("_v")
    one = found.groupBy(*keys, "n", "_name").agg((low + (high - low) * F.max(F.col("_at") - F.floor("_at"))).alias("_q"))
    return one.groupBy(*keys, "n").agg(*[F.max(F.when(F.col("_name") == name, F.col("_q"))).alias(name) for name in shares])


def quartiles_by_bin(cells: DataFrame, by: str, value: str, width: float, low: float, high: float) -> DataFrame:
    """Exact quartiles of values within ``low .. high`` by bins centred on multiples of ``width``."""
    centre = F.floor(F.col(by) / width + 0.5) * width
    rows = cells.where(F.col(value).between(low, high)).select(centre.cast("double").alias("bin"), value)
    return quantiles(rows, ["bin"], value, {"q25": 0.25, "q50": 0.5, "q75": 0.75})


def scaled_by_median_ratio(cells: DataFrame, value: str, by: str) -> DataFrame:
    """``by`` times the median of ``value / by``, nulls left out."""
    ratio = F.col(value) / F.nullif(F.col(by), F.lit(0.0))
    middle = quantiles(cells.select(ratio.alias("_ratio")), [], "_ratio", {"_median": 0.5}).select("_median")
    row = cells.sparkSession.range(1).select().join(middle, how="left")  # one row, null where no ratio is known
    return cells.crossJoin(F.broadcast(row)).withColumn("scaled", F.col("_median") * F.col(by)).drop("_median")


def max_by_period(yearly: DataFrame, periods: DataFrame, key: str, value: str) -> DataFrame:
    """Maximum by (overlapping) periods ``period, first, last`` of years."""
    years = periods.select("period", F.explode(F.sequence("first", "last")).alias("year"))
    return yearly.join(years, "year").groupBy("period", key).agg(F.max(value).alias(value))


def weights_between(cells: DataFrame, value: str, levels: list[float]) -> DataFrame:
    """Two rows for each cell: the level below and above its value, with linear weights.

    Outside of all levels the nearest one has the whole weight.
    """
    v = F.least(F.greatest(F.col(value), F.lit(levels[0])), F.lit(levels[-1]))
    at = F.lit(0)
    for k, low in enumerate(levels[1:-1], 1):
        at = F.when(v >= low, k).otherwise(at)
    table = F.array(*[F.lit(float(x)) for x in levels])
    low, high = F.element_at(table, at + 1), F.element_at(table, at + 2)
    share = (v - low) / (high - low)
    return cells.select(
        "cell", F.inline(F.array(F.struct(at.alias("level"), (1 - share).alias("weight")), F.struct((at + 1).alias("level"), share.alias("weight"))))
    )


def matrix_apply(entries: DataFrame, vector: DataFrame) -> DataFrame:
    """``row, value``: weighted mean of ``vector (col, v)`` by sparse ``entries (row, col, w)``."""
    return (
        entries.join(vector, "col")
        .groupBy("row")
        .agg((F.sum(F.col("w") * F.col("v")) / F.nullif(F.sum("w"), F.lit(0.0))).alias("value"))
    )


#: Variables that statistics are made of: the band's expression and what it is divided by.
VARIABLES: dict[str, tuple[Column, Column]] = {}


def register_variable(name: str, value: Column, scale: Column) -> None:
    """Add a variable to VARIABLES."""
    VARIABLES[name] = value, scale


def variable_statistics(cells: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Mean of each named variable by ``keys``."""
    return cells.groupBy(*keys).agg(*[F.avg(VARIABLES[n][0] / VARIABLES[n][1]).alias(n) for n in names])
