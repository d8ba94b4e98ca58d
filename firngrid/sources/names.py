"""Columns that read the parts of file, folder and job names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The forms of names.
ARCHIVE = r"^aval-([TSML])-([0-9]+)-(overrun)?\.nc$"
RELEASE = r"^c-([TSML])-([0-9]{5})(For|NoFor)_([0-9]+)m_([0-9]+)([TSML])_rel\.shp$"
SCENE = r"^(x|arc)-([0-9]+)-([0-9]+)$"
TILE = r"Cell_([0-9]+)/.*DTM.*\.tif$"
OUTFLOW = r"FINAL OUTFLOW VOLUME: ([0-9.]+)"
INFLOW = r"INITIAL FLOW VOLUME: ([0-9.]+)"
LOW_FLUX = "LOW MASS FLUX"

OVERRUN, FINISHED = 5, 6


def archive_parts(name: Column) -> list[Column]:
    """``size, id, id_status`` of an archive file; nulls if it is none."""
    is_one = name.rlike(ARCHIVE)
    part = lambda k: F.when(is_one, F.regexp_extract(name, ARCHIVE, k))
    return [
        part(1).alias("size"),
        part(2).cast("long").alias("id"),
        F.when(is_one, F.when(part(3) == "overrun", OVERRUN).otherwise(FINISHED)).alias("id_status"),
    ]


def release_parts(name: Column) -> list[Column]:
    """``pra_size, chunkid, forest, resolution, return_period`` of a chunk release file."""
    part = lambda k: F.when(name.rlike(RELEASE), F.regexp_extract(name, RELEASE, k))
    return [
        part(1).alias("pra_size"),
        part(2).cast("int").alias("chunkid"),
        part(3).alias("forest"),
        part(4).cast("int").alias("resolution"),
        part(5).cast("int").alias("return_period"),
    ]


def scene_parts(path: Column, depth: int = -1) -> list[Column]:
    """``scenetype, idom, jdom`` of the folder at ``depth`` from the end of a path."""
    leaf = F.element_at(F.split(path, "/"), depth)
    part = lambda k: F.when(leaf.rlike(SCENE), F.regexp_extract(leaf, SCENE, k))
    return [
        part(1).alias("scenetype"),
        part(2).cast("int").alias("idom"),
        part(3).cast("int").alias("jdom"),
    ]


def job_parts(name: Column) -> list[Column]:
    """``combo, chunkid, id`` of a job name ``<combo parts joined by ->-<chunk>-<id>``."""
    parts = F.split(name, "-")
    return [
        F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 2), "-").alias("combo"),
        F.element_at(parts, -2).cast("int").alias("chunkid"),
        F.element_at(parts, -1).cast("long").alias("id"),
    ]


def tile_number(path: Column) -> Column:
    """The number of the terrain tile that a path holds; null if it holds none."""
    return F.when(path.rlike(TILE), F.regexp_extract(path, TILE, 1).cast("int"))


def volume(log: Column, pattern: str) -> Column:
    """The first volume that a log states after ``pattern``; null if there is none."""
    found = F.regexp_extract(log, pattern, 1)
    return F.when(found != "", found).try_cast("double")


def low_flux(log: Column) -> Column:
    """Whether a run ended because hardly anything flowed any more."""
    return log.contains(LOW_FLUX) & log.contains("FINISHING CALCULATION!!!!")
