"""Tiles, experiment expansion, specs and name-keyed selections."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from firngrid.functions import grid as G
from firngrid.sources.shared import staged, unsent

STATUS = (
    "TODO", "INPROCESS", "NOINPUT", "INCOMPLETE", "FAILED", "OVERRUN", "FINISHED",
    "MARKED_FINISHED", "ARCHIVED", "EXTENT", "UNKNOWN",
)


def tile_grid(spark: SparkSession, nx: int, ny: int, x0: float, y0: float, dx: float, dy: float, margin: float) -> DataFrame:
    """All tiles with rectangle and rectangle with margin; steps may be negative."""
    i, j = F.col("idom"), F.col("jdom")
    left, low = x0 + i * dx, y0 + j * dy
    xs, ys = (left, left + dx), (low, low + dy)
    return (
        spark.range(nx * ny)
        .select((F.col("id") % nx).cast("int").alias("idom"), F.floor(F.col("id") / nx).cast("int").alias("jdom"))
        .select(
            "idom", "jdom",
            F.least(*xs).alias("x0"), F.least(*ys).alias("y0"), F.greatest(*xs).alias("x1"), F.greatest(*ys).alias("y1"),
            (F.least(*xs) - margin).alias("mx0"), (F.least(*ys) - margin).alias("my0"),
            (F.greatest(*xs) + margin).alias("mx1"), (F.greatest(*ys) + margin).alias("my1"),
        )
    )


def boxes_touch(a: str, b: str) -> Column:
    """Whether the boxes of two aliases touch or overlap."""
    return (
        (F.col(f"{a}.x0") <= F.col(f"{b}.x1")) & (F.col(f"{b}.x0") <= F.col(f"{a}.x1"))
        & (F.col(f"{a}.y0") <= F.col(f"{b}.y1")) & (F.col(f"{b}.y0") <= F.col(f"{a}.y1"))
    )


#: Rows that a side has at most to be sent to all tasks.
SMALL_SIDE = 200_000
#: Bins along a side of the blocks that a small side is put into.
BLOCK_BINS = 4


def _binned(boxes: DataFrame, size: float) -> DataFrame:
    spans = [
        F.sequence(F.floor(F.col(a) / size).cast("int"), F.floor(F.col(b) / size).cast("int"))
        for a, b in (("x0", "x1"), ("y0", "y1"))
    ]
    return boxes.withColumn("bx", F.explode(spans[0])).withColumn("by", F.explode(spans[1]))


def _extent(boxes: DataFrame) -> Row:
    """How many boxes there are, and between which values their corners ``x0, y0`` lie."""
    corners = [f(c).alias(f"{f.__name__}_{c}") for c in ("x0", "y0") for f in (F.min, F.max)]
    return boxes.agg(F.count("*").alias("n"), *corners).first()


def _met_in_blocks(many: DataFrame, few: DataFrame, extent: Row, size: float) -> DataFrame:
    """Pairs of boxes that touch: ``a`` of ``many``, and the struct ``_b`` of ``few``, which is sent to all tasks.

    A box of ``few`` is in one block, that of its corner ``x0, y0``. A block has ``BLOCK_BINS`` bins along a side,
    or more where there are fewer boxes than such blocks; wider boxes have wider blocks, by levels. The widest
    box of a level says how far below its own corner a box of ``many`` has to look. So it has a row for
    each block of ``few`` and not for each bin or box it touches, and a pair meets once.
    """
    known = few.where(" and ".join(f"{c} is not null" for c in ("x0", "y0", "x1", "y1")))
    nothing = many.alias("a").crossJoin(few.limit(0).select(F.struct(*few.columns).alias("_b")))
    if extent.min_x0 is None or extent.min_y0 is None:
        return nothing
    wide, tall = extent.max_x0 - extent.min_x0, extent.max_y0 - extent.min_y0
    side = max(BLOCK_BINS * size, math.sqrt(wide / extent.n * tall), wide / extent.n, tall / extent.n)
    level = F.greatest(F.ceil(F.log2(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) / side)).cast("int"), F.lit(0))
    block = lambda c, k: F.floor(c / (side * F.pow(F.lit(2.0), k)))
    leveled = known.withColumn("_level", level)
    leveled = leveled.withColumns({"_bx": block(F.col("x0"), F.col("_level")), "_by": block(F.col("y0"), F.col("_level"))})
    # differences of doubles are off by a share of themselves where they are not exact
    below = [(F.greatest(F.max(F.col(b) - F.col(a)), F.lit(0.0)) * (1 + 1e-9)).alias(a) for a, b in (("x0", "x1"), ("y0", "y1"))]
    ends = [f(c).alias(f"{f.__name__}{c}") for c in ("_bx", "_by") for f in (F.min, F.max)]
    looks = leveled.groupBy("_level").agg(*below, *ends).collect()
    if not looks:
        return nothing
    blocks = leveled.groupBy("_level", "_bx", "_by").agg(F.collect_list(F.struct(*few.columns)).alias("_boxes"))
    asking = many.select("*", F.explode(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in r.asDict().items()]) for r in looks])).alias("_look"))
    for c, low, high in (("_bx", "x0", "x1"), ("_by", "y0", "y1")):
        look = F.col("_look")
        first = F.greatest(block(F.col(low) - look[low], look["_level"]), look[f"min{c}"])
        last = F.least(block(F.col(high), look["_level"]), look[f"max{c}"])
        asking = asking.withColumn(c, F.explode(F.when(F.col(low).isNotNull() & F.col(high).isNotNull() & (first <= last), F.sequence(first, last))))
    asking = asking.withColumn("_level", F.col("_look._level")).drop("_look")
    met = asking.alias("a").join(F.broadcast(blocks), ["_level", "_bx", "_by"]).select(*[F.col(f"a.{c}") for c in many.columns], F.explode("_boxes").alias("_b"))
    return met.alias("a").where(boxes_touch("a", "_b"))


def box_join(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """Pairs of boxes that touch; both sides have ``x0, y0, x1, y1``, the right one's are dropped.

    Where a side is small the other one is not shuffled and meets blocks of it. Else boxes meet in coarse bins,
    and a pair is kept only in the bin of the corner where both begin, so no distinct is needed.
    """
    own = [c for c in right.columns if c not in ("x0", "y0", "x1", "y1")]
    if (extent := _extent(right)).n <= SMALL_SIDE:
        return _met_in_blocks(left, right, extent, size).select(*[f"a.{c}" for c in left.columns], *[f"_b.{c}" for c in own])
    if (extent := _extent(left)).n <= SMALL_SIDE:
        return _met_in_blocks(right, left, extent, size).select(*[f"_b.{c}" for c in left.columns], *[f"a.{c}" for c in own])
    a, b = _binned(left, size).alias("a"), _binned(right, size).alias("b")
    first_x = F.greatest(F.floor(F.col("a.x0") / size), F.floor(F.col("b.x0") / size))
    first_y = F.greatest(F.floor(F.col("a.y0") / size), F.floor(F.col("b.y0") / size))
    met = a.join(b, (F.col("a.bx") == F.col("b.bx")) & (F.col("a.by") == F.col("b.by")))
    met = met.where(boxes_touch("a", "b") & (F.col("a.bx") == first_x) & (F.col("a.by") == first_y))
    return met.select(*[f"a.{c}" for c in left.columns], *[f"b.{c}" for c in own])


_PIECES = "array<struct<level:int,at:bigint>>"


def _filling(low: Column, high: Column) -> Column:
    """The fewest pieces ``level, at`` that fill the numbers ``low`` to ``high``; a piece has 2**level of them."""

    def of_level(level: Column) -> Column:
        width = F.pow(F.lit(2.0), level)
        first, last = F.ceil(low / width), F.floor((high + 1) / width) - 1
        piece = lambda at: F.struct(level.alias("level"), at.alias("at"))
        some = first <= last
        return F.array(F.when(some & (F.pmod(first, F.lit(2)) == 1), piece(first)), F.when(some & (F.pmod(last, F.lit(2)) == 0), piece(last)))

    levels = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(high - low + 1, F.lit(1)).cast("double"))).cast("int"))
    return F.array_compact(F.flatten(F.transform(levels, of_level))).cast(_PIECES)


def boxes_met(rows: DataFrame, key: list[str], boxes: DataFrame, size: float) -> DataFrame:
    """The keys of ``rows`` whose box touches any of ``boxes``, once each; both have ``x0, y0, x1, y1``.

    A box is cut into columns of bins. In a column the bins between its first and its last one are
    filled by pieces of 1, 2, 4 ... bins, so a box as tall as the map has some tens of rows and not
    one for each bin. A piece is filled from below to above, so only what ``boxes`` cover of its
    width matters; the two bins at the ends are compared box by box. Columns run along the axis on
    which the rows are longer.
    """
    at = lambda c: F.floor(F.col(c) / size)
    wide, tall, most_wide, most_tall = rows.agg(*[f(at(b) - at(a)) for f in (F.sum, F.max) for a, b in (("x0", "x1"), ("y0", "y1"))]).first()
    if wide is None:
        return rows.select(*key).limit(0)
    if wide > tall:
        turned = [F.col(a).alias(b) for a, b in (("y0", "x0"), ("x0", "y0"), ("y1", "x1"), ("x1", "y1"))]
        rows, boxes, most_tall = rows.select(*key, *turned), boxes.select(*turned), most_wide
    column, low, high = F.explode(F.sequence(at("x0"), at("x1"))).alias("bx"), at("y0"), at("y1")
    ends = F.transform(F.array_distinct(F.array(low, high)), lambda b: F.struct(F.lit(-1).alias("level"), b.alias("at"))).cast(_PIECES)
    asked = rows.select(*key, "x0", "y0", "x1", "y1", F.inline(F.concat(ends, _filling(low + 1, high - 1)))).select("*", column)

    places = boxes.select("x0", "y0", "x1", "y1", column).select("*", F.explode(F.sequence(low, high)).alias("at"))
    whole = places.select(F.lit(-1).alias("level"), "at", "bx", "x0", "y0", "x1", "y1").distinct()
    inside = F.greatest("x0", F.col("bx") * size), F.least("x1", (F.col("bx") + 1) * size)
    spans = places.select("at", "bx", inside[0].alias("x0"), inside[1].alias("x1")).distinct()
    levels = F.explode(F.array(*[F.lit(k) for k in range(int(most_tall + 1).bit_length() + 1)]))
    spans = spans.select("at", "bx", "x0", "x1", levels.alias("level"))
    spans = spans.select("level", F.floor(F.col("at") / F.pow(F.lit(2.0), "level")).alias("at"), "bx", "x0", "x1").distinct()
    # spans of a piece that touch are one
    before = Window.partitionBy("level", "at", "bx").orderBy("x0", "x1")
    begins = F.coalesce(F.col("x0") > F.max("x1").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    spans = spans.withColumn("_new", begins.cast("int")).withColumn("_run", F.sum("_new").over(before))
    covered = spans.groupBy("level", "at", "bx", "_run").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1")).drop("_run")
    low_y, high_y = F.lit(float("-inf")).alias("y0"), F.lit(float("inf")).alias("y1")
    tiles = staged(whole.unionByName(covered.select("level", "at", "bx", "x0", low_y, "x1", high_y)), "pieces")

    # high levels have few pieces, of which each is asked for by very many rows; low ones have many
    counts = sorted((r.level, r.n) for r in tiles.groupBy("level").agg(F.count("*").alias("n")).collect())
    sent, first = 0, len(counts)
    while first and sent + counts[first - 1][1] <= SMALL_SIDE:
        first -= 1
        sent += counts[first][1]
    from_level = counts[first][0] if first < len(counts) else most_tall + 1
    found = None
    for side, part in ((F.broadcast, F.col("level") >= from_level), (unsent, F.col("level") < from_level)):
        if side is unsent and first == 0:
            continue
        met = asked.where(part).alias("a").join(side(tiles.where(part)).alias("b"), ["level", "at", "bx"]).where(boxes_touch("a", "b")).select(*[f"a.{k}" for k in key])
        found = met if found is None else found.unionByName(met)
    return found.distinct()


def near_segments(points: DataFrame, segments: DataFrame, radius: float, keys: list[str]) -> DataFrame:
    """``points (x, y)`` within ``radius`` of a segment ``ax, ay, bx, by``."""
    size = 2 * radius
    grown = segments.select(
        "*",
        (F.least("ax", "bx") - radius).alias("x0"), (F.greatest("ax", "bx") + radius).alias("x1"),
        (F.least("ay", "by") - radius).alias("y0"), (F.greatest("ay", "by") + radius).alias("y1"),
    )
    cells = _binned(grown.withColumnsRenamed({"bx": "ex", "by": "ey"}), size)
    at = points.withColumns({"bx": F.floor(F.col("x") / size).cast("int"), "by": F.floor(F.col("y") / size).cast("int")})
    dx, dy = F.col("ex") - F.col("ax"), F.col("ey") - F.col("ay")
    along = ((F.col("x") - F.col("ax")) * dx + (F.col("y") - F.col("ay")) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    ox, oy = F.col("x") - F.col("ax") - t * dx, F.col("y") - F.col("ay") - t * dy
    return at.join(cells, ["bx", "by"]).where(ox * ox + oy * oy <= radius * radius).select(*keys).distinct()


def spiral_order(tiles: DataFrame, x0: int, y0: int, first: list[tuple[int, int]]) -> DataFrame:
    """Tiles in the order of the spiral around a centre, those of ``first`` before them."""
    n = G.spiral_number(F.col("idom") - x0, F.col("jdom") - y0)
    rank = F.coalesce(
        *[F.when((F.col("idom") == i) & (F.col("jdom") == j), k) for k, (i, j) in enumerate(first)],
        F.lit(len(first)),
    )
    ordered = tiles.select("idom", "jdom", rank.alias("priority"), n.alias("spiral"))
    return ordered.orderBy("priority", "spiral")


def ordered_union(segments: list[DataFrame], keys: list[str]) -> DataFrame:
    """``keys, segment``: rows of all segments, each in the first one that has it."""
    parts = [s.select(*keys, F.lit(k).alias("segment")) for k, s in enumerate(segments)]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy(*keys).agg(F.min("segment").alias("segment"))


def expand_forest(combos: DataFrame) -> DataFrame:
    """A null forest stands for both flags."""
    both = F.array(F.lit("For"), F.lit("NoFor"))
    return combos.withColumn("forest", F.explode(F.when(F.col("forest").isNull(), both).otherwise(F.array("forest"))))


def extent_of(tiles: DataFrame, margin: float = 0.0) -> DataFrame:
    """The box of all rows, grown on each side."""
    return tiles.agg(
        (F.min("x0") - margin).alias("x0"), (F.min("y0") - margin).alias("y0"),
        (F.max("x1") + margin).alias("x1"), (F.max("y1") + margin).alias("y1"),
    )


def label_columns(tiles: DataFrame, nth: int = 1) -> DataFrame:
    """For each row of tiles, its ``nth`` smallest column."""
    w = Window.partitionBy("jdom").orderBy("idom")
    return tiles.withColumn("k", F.row_number().over(w)).where(F.col("k") == nth).select("jdom", "idom")


def hash_part(key: Column, n: int) -> Column:
    """A part 0..n-1 by the key's sha256."""
    return F.pmod(F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")


def stride_part(rank: Column, n: int) -> Column:
    """A part by ``rank % n``."""
    return (rank % n).cast("int")


def section_part(rank: Column, total: Column, n: int) -> Column:
    """A part of consecutive rows."""
    return F.floor(rank * n / total).cast("int")


def parse_spec(spec: str) -> list[str | None]:
    """Parts of a spec; a part of dots is as many wildcards."""
    parts: list[str | None] = []
    for part in spec.split("-"):
        parts += [None] * len(part) if re.fullmatch(r"\.+", part) else [part]
    return parts


def spec_predicate(spec: str, columns: list[str]) -> Column:
    """Rows whose columns equal the parts of ``spec``; missing parts and wildcards match all."""
    out = F.lit(True)
    for part, column in zip(parse_spec(spec), columns, strict=False):
        if part is not None:
            out = out & (F.col(column).cast("string") == part)
    return out


def by_ids(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Rows with a listed id; no list is the wildcard."""
    return rows if ids is None else rows.join(ids, "id", "left_semi")


def validated(specs: DataFrame, enums: dict[int, tuple[str, ...]], ints: tuple[int, ...], nullable: tuple[int, ...], size: int) -> DataFrame:
    """``spec, valid``: enumerated parts are members, numbered parts are integers."""
    parts = F.split("spec", "-")
    part = lambda k: F.get(parts, F.lit(k))
    ok = F.size(parts) == size
    for k, names in enums.items():
        ok = ok & part(k).isin(*names)
    for k in ints:
        is_int = part(k).try_cast("int").isNotNull()
        ok = ok & ((part(k) == "") | is_int if k in nullable else is_int)
    return specs.withColumn("valid", F.coalesce(ok, F.lit(False)))


PREDICATES: dict[str, Callable[..., Column]] = {}


def predicate(name: str):
    """Register a row predicate by name."""

    def add(fn: Callable[..., Column]) -> Callable[..., Column]:
        PREDICATES[name] = fn
        return fn

    return add


@predicate("all")
def _all() -> Column:
    return F.lit(True)


@predicate("none")
def _none() -> Column:
    return F.lit(False)


@predicate("overrun")
def _overrun(value: bool = True) -> Column:
    return (F.col("id_status") == STATUS.index("OVERRUN")) == value


@predicate("resubmitted")
def _resubmitted() -> Column:
    return F.col("chunkid") > 0


@dataclass
class Experiment:
    """What an experiment supplies: its key columns, filters and sets of scenarios.

    ``sets`` make the scenarios by name; a scenario runs the release sizes that ``sizes`` has
    for its ``forest``; ``ignored`` gives runs (by some of their columns) that are left out;
    ``mosaic_filter`` keeps the extents that go into a mosaic.
    """

    name: str
    keys: tuple[str, ...]
    mosaic_filter: Callable[[DataFrame], DataFrame] = lambda df: df
    sizes: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ignored: Callable[[SparkSession], DataFrame] | None = None
    sets: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    def scenarios(self, which: str, tiles: DataFrame) -> DataFrame:
        """``exp``, the keys and ``pra_size``: all that the named set asks for, in all of ``tiles``."""
        if which not in self.sets:
            raise ValueError(f"{self.name} has no set {which}")
        made = self.sets[which](tiles).select(*self.keys).distinct()
        sizes = made.sparkSession.createDataFrame([(f, s) for f, of in self.sizes.items() for s in of], "forest string, pra_size string")
        return made.join(F.broadcast(sizes), "forest").select(F.lit(self.name).alias("exp"), *self.keys, "pra_size")  # sizes are a few rows

    def runs(self, which: str, tiles: DataFrame, areas: DataFrame) -> DataFrame:
        """The runs of a set: its scenarios by ``areas`` (tile, ``forest, pra_size, id``), without the ignored ones."""
        on = [k for k in (*self.keys, "pra_size") if k in areas.columns]
        found = self.scenarios(which, tiles).join(areas, on)
        if self.ignored is None:
            return found
        left_out = self.ignored(tiles.sparkSession)
        return found.join(left_out, left_out.columns, "left_anti")


#: Experiments by name.
EXPERIMENTS: dict[str, Experiment] = {}


def register_experiment(experiment: Experiment) -> Experiment:
    """Add an experiment to EXPERIMENTS."""
    EXPERIMENTS[experiment.name] = experiment
    return experiment
