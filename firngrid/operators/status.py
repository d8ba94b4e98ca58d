"""Status of runs: derived per id, rolled up, repaired, reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firngrid.operators.catalog import STATUS, boxes_met

CODE = {name: k for k, name in enumerate(STATUS)}


def with_status(catalog: DataFrame, status: DataFrame, keys: list[str]) -> DataFrame:
    """Catalog rows with their status; unknown ones have no input."""
    return catalog.join(status, keys, "left").withColumn(
        "id_status", F.coalesce("id_status", F.lit(CODE["NOINPUT"]))
    )


def derived_status() -> Column:
    """Status of an id from its files: what was looked up first decides.

    Columns: ``in_ts, out_ts, arc_ts`` (null if there is no file), ``in_size, out_size``,
    ``queue_status`` (null if not queued), ``overran``.
    """
    c = F.col
    return (
        F.when(c("in_ts").isNull(), CODE["NOINPUT"])
        .when(c("queue_status").isNotNull(), c("queue_status"))
        .when((c("arc_ts") > c("out_ts")) & (c("out_ts") > c("in_ts")), CODE["FINISHED"])
        .when(c("out_ts").isNull(), CODE["TODO"])
        .when((c("in_size") == 0) & (c("out_size") == 0), CODE["FINISHED"])
        .when(c("out_size") == 0, CODE["TODO"])
        .when(c("overran"), CODE["OVERRUN"])
        .otherwise(CODE["FINISHED"])
    )


def least_status(ignored: tuple[int, ...] = ()) -> Column:
    """The least status of a group, without the ignored ones; null if none is left."""
    s = F.col("id_status")
    return F.min(F.when(~s.isin(*ignored), s) if ignored else s)


def quick_status() -> Column:
    """Status of a scenario from its markers alone: ``archived, all_extents, has_dir, all_empty``."""
    c = F.col
    return (
        F.when(c("archived") & c("all_extents"), CODE["EXTENT"])
        .when(c("archived"), CODE["MARKED_FINISHED"])
        .when(~c("has_dir"), CODE["NOINPUT"])
        .when(c("all_empty"), CODE["FINISHED"])
        .otherwise(CODE["UNKNOWN"])
    )


def rolled_up(rows: DataFrame, levels: list[str]) -> DataFrame:
    """Least status of the ids at every level in one pass, and which level a row is for."""
    return rows.rollup(*levels).agg(
        F.min("id_status").alias("status"), F.count("*").alias("n"), F.grouping_id().cast("long").alias("level")
    )


def last_chunk(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the latest chunk for each key."""
    others = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*others), "chunkid").alias("r")
    return rows.groupBy(*keys).agg(best).select(*keys, "r.*").select(rows.columns)


def repaired_overruns(rows: DataFrame, keys: list[str]) -> DataFrame:
    """If an id ran more than once, an overrun in its last run counts as finished."""
    done = F.col("id_status").isin(CODE["OVERRUN"], CODE["FINISHED"])
    w = Window.partitionBy(*keys, done)
    again = done & (F.count("*").over(w) > 1) & (F.row_number().over(w.orderBy(F.desc("chunkid"))) == 1)
    repaired = F.when(again & (F.col("id_status") == CODE["OVERRUN"]), CODE["FINISHED"]).otherwise(F.col("id_status"))
    return rows.withColumn("id_status", repaired)


def listing(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Ids by status."""
    return rows.groupBy(*keys, "id_status").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def progress(rows: DataFrame, now: Column, n_next: int = 5) -> DataFrame:
    """``kind, id, n``: totals done and todo, what was done in the last day, what comes next."""
    done = F.col("id_status") >= CODE["FINISHED"]
    totals = rows.agg(F.count_if(done).alias("done"), F.count_if(~done).alias("todo")).select(
        F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(None).cast("long").alias("id"), F.col(k).alias("n")) for k in ("done", "todo")]))
    )
    recent = rows.where(done & (F.col("ts") > now - F.expr("interval 24 hours"))).select(
        F.lit("recent").alias("kind"), "id", F.lit(1).cast("long").alias("n")
    )
    following = rows.where(~done).orderBy("id").limit(n_next).select(F.lit("next").alias("kind"), "id", F.lit(1).cast("long").alias("n"))
    return totals.unionByName(recent).unionByName(following)


def common_or_null(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row for each key; a column that differs within the key is null."""
    same = lambda c: (F.min(c).eqNullSafe(F.max(c))) & (F.count(c) == F.count("*"))
    return rows.groupBy(key).agg(*[F.when(same(c), F.min(c)).alias(c) for c in columns])


def completed(expected: DataFrame, present: DataFrame, key: str, group: str) -> DataFrame:
    """``group, complete``: whether all expected files are there."""
    there = present.select(key).distinct().withColumn("there", F.lit(True))
    return expected.join(there, key, "left").groupBy(group).agg(
        F.bool_and(F.coalesce("there", F.lit(False))).alias("complete")
    )


def is_empty(files: DataFrame, key: str) -> DataFrame:
    """``key, empty``: it has files, and all of them are of size 0."""
    return files.groupBy(key).agg(((F.count("*") > 0) & F.bool_and(F.col("size") == 0)).alias("empty"))


def outdated(sources: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Keys whose output is missing or older than the source."""
    return sources.join(outputs, key, "left").where("out_ts is null or src_ts > out_ts").select(key)


def all_ready(rows: DataFrame, least: int) -> DataFrame:
    """One row: whether every scenario has at least the status; true of none."""
    return rows.agg(F.coalesce(F.bool_and(F.col("id_status") >= least), F.lit(True)).alias("ready"))


def to_resubmit(runs: DataFrame, keys: list[str], margin: float = 5000.0) -> DataFrame:
    """Overrun ids of scenarios without unfinished ids: the last run, its box grown, in a new chunk.

    ``runs`` has the keys, ``id, chunkid, id_status`` and a box.
    """
    ready = runs.groupBy(*keys).agg(
        F.min("id_status").alias("least"), (F.max("chunkid") + 1).alias("new_chunk")
    ).where(F.col("least") >= CODE["OVERRUN"])
    last = last_chunk(runs, [*keys, "id"]).where(F.col("id_status") == CODE["OVERRUN"])
    return last.join(ready, keys).select(
        *keys, "id", F.col("new_chunk").alias("chunkid"),
        (F.col("x0") - margin / 2).alias("x0"), (F.col("y0") - margin / 2).alias("y0"),
        (F.col("x1") + margin / 2).alias("x1"), (F.col("y1") + margin / 2).alias("y1"),
    )


def area_boxes(area: tuple | str, chosen: DataFrame, tiles: DataFrame, named: dict[str, tuple] | None = None) -> tuple | DataFrame:
    """The box or boxes ``x0, y0, x1, y1`` of an area.

    ``area`` is four numbers, a name of ``named``, ``tile`` for the tiles that ``chosen`` runs
    lie in, or ``aval`` for the boxes of these runs themselves.
    """
    if area == "tile":
        return tiles.join(chosen.select("idom", "jdom").distinct(), ["idom", "jdom"], "left_semi").select("x0", "y0", "x1", "y1")
    if area == "aval":
        return chosen.select("x0", "y0", "x1", "y1")
    corners = (named or {}).get(area) if isinstance(area, str) else area
    if corners is None:
        raise ValueError(f"unknown extent: {area}")
    return tuple(map(float, corners))


def area_extent(boxes: tuple | DataFrame) -> tuple:
    """The box around all boxes of an area."""
    if isinstance(boxes, tuple):
        return boxes
    return tuple(boxes.agg(F.min("x0"), F.min("y0"), F.max("x1"), F.max("y1")).first())


def _meeting(rows: DataFrame, key: list[str], boxes: tuple | DataFrame, margin: float, bin_size: float) -> DataFrame:
    """``rows`` whose box meets one of ``boxes`` when these are grown by ``margin``."""
    if isinstance(boxes, tuple):
        x0, y0, x1, y1 = boxes
        return rows.where((F.col("x0") <= x1 + margin) & (F.col("x1") >= x0 - margin) & (F.col("y0") <= y1 + margin) & (F.col("y1") >= y0 - margin))
    grown = boxes.distinct().select((F.col("x0") - margin).alias("x0"), (F.col("y0") - margin).alias("y0"), (F.col("x1") + margin).alias("x1"), (F.col("y1") + margin).alias("y1"))
    met = boxes_met(rows.select(*key, "x0", "y0", "x1", "y1"), key, grown, bin_size)
    return rows.join(met, key, "left_semi")


def area_query(
    tiles: DataFrame, combos: DataFrame, runs: DataFrame, area: tuple | str, margin: float, statuses: tuple[int, ...],
    chosen: DataFrame | None = None, named: dict[str, tuple] | None = None, combo_status: DataFrame | None = None,
    least: int = 0, force: bool = False, bin_size: float = 10.0,
) -> DataFrame:
    """Runs of all scenarios that meet an area, in the tiles whose box with a margin meets it.

    ``tiles`` and ``runs`` are keyed ``idom, jdom``; runs have ``id``, boxes and ``id_status``, of
    which the wanted ones are kept. The area is one of ``area_boxes``, for ``chosen`` runs (all
    by default). With ``aval`` the chosen runs themselves are the answer. ``combo_status`` has
    the ``combo_status`` of scenarios and tiles: all that are looked at must have the ``least``,
    or an error is raised; with ``force`` those below are left out. One without a row has none.
    """
    chosen, wanted = runs if chosen is None else chosen, F.col("id_status").isin(*statuses)
    if area == "aval":
        return combos.crossJoin(chosen.where(wanted))
    boxes = area_boxes(area, chosen, tiles, named)
    looked_at = combos.crossJoin(_meeting(tiles, ["idom", "jdom"], boxes, margin, bin_size).select("idom", "jdom"))
    if combo_status is not None:
        keys = looked_at.columns
        looked_at = looked_at.join(combo_status, keys, "left").withColumn("_ok", F.coalesce(F.col("combo_status") >= least, F.lit(False)))
        if not force and not looked_at.where("not _ok").isEmpty():
            raise ValueError(f"scenarios below status {least} meet the area")
        looked_at = looked_at.where("_ok").select(*keys)
    return looked_at.join(_meeting(runs.where(wanted), ["id"], boxes, 0.0, bin_size), ["idom", "jdom"])
