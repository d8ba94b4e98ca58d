"""Layers written out."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from firngrid.sources.shared import shared_dir

PUBLISH_KEYS = ("exp", "wcombo", "layer", "idom", "jdom")
#: Those that are folders.
PUBLISH_FOLDERS = PUBLISH_KEYS[:3]


def publish(layers: DataFrame, path: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """Write ``layers`` by section, layer and tile, without the layers of ``skip``; what is published now.

    Only the partitions (the tiles of a layer) that ``layers`` has are replaced. Sections and
    layers are folders. Tiles are as many as the map is large, so they are none: the rows of a
    tile are brought together and stand side by side in one file, and readers of a tile pass
    over the other row groups. They are written beside the old ones, and one small row at the
    end makes them the newest, all at once.
    """
    spark, version = layers.sparkSession, uuid.uuid4().hex
    chosen = layers.where(~F.col("layer").isin(*skip)) if skip else layers
    at = f"{path}/data/version={version}"
    chosen.repartition(*PUBLISH_KEYS).sortWithinPartitions(*PUBLISH_KEYS).write.partitionBy(*PUBLISH_FOLDERS).parquet(at)
    keys = spark.read.schema(chosen.schema).parquet(at).select(*PUBLISH_KEYS).distinct()
    keys.withColumn("version", F.lit(version)).write.mode("append").parquet(f"{path}/_partitions")
    _name_version(spark, path, version, chosen.schema)
    return published(spark, path)


def _newest_partitions(spark: SparkSession, path: str) -> tuple[DataFrame, StructType]:
    """``PUBLISH_KEYS, version`` of each partition in its newest version, and the columns of the table."""
    named = _versions(spark, path)
    if not named:
        raise FileNotFoundError(f"nothing has been published to {path}")
    columns = StructType.fromJson(json.loads(named[0].columns))
    keys = StructType([columns[k] for k in PUBLISH_KEYS])
    rows = spark.read.schema(StructType([*keys, StructField("version", StringType())])).parquet(f"{path}/_partitions")
    order = spark.createDataFrame([(r.path, r.number) for r in named], "version string, number long")  # a row for each publication
    known = rows.join(F.broadcast(order), "version")
    return known.groupBy(*PUBLISH_KEYS).agg(F.max_by("version", F.struct("number", "version")).alias("version")), columns


def _used(newest: DataFrame) -> list[str]:
    """The versions that are the newest of some partition: one for each publication at most."""
    return sorted(r.version for r in newest.select("version").distinct().collect())


def published(spark: SparkSession, path: str) -> DataFrame:
    """All partitions of a published table, each in its newest version; unfinished ones are not seen."""
    newest, columns = _newest_partitions(spark, path)
    wide = StructType([*columns, StructField("version", StringType())])
    used = _used(newest)
    if not used:
        return spark.createDataFrame([], columns)
    # only folders of versions that are in use are listed and read
    rows = spark.read.schema(wide).option("basePath", f"{path}/data").parquet(*[f"{path}/data/version={v}" for v in used])
    return rows.join(newest, [*PUBLISH_KEYS, "version"], "left_semi").select(*columns.names)


def drop_unpublished(spark: SparkSession, path: str) -> int:
    """Delete the versions of which no partition is the newest any more; how many there were."""
    newest, _ = _newest_partitions(spark, path)
    used = _used(newest)
    old = [r.path for r in _versions(spark, path) if r.path not in used]
    for version in old:
        delete(spark, f"{path}/data/version={version}")
    return len(old)


def republish(published: DataFrame, combos: DataFrame, layers: list[str]) -> DataFrame:
    """The chosen layers of the chosen combos.

    A table has few combos and any number of rows of each, so the combos go to the rows.
    """
    return published.where(F.col("layer").isin(*layers)).join(F.broadcast(combos.distinct()), ["exp", "wcombo"], "left_semi")


_VERSION = "number long, path string, columns string"


def _versions(spark: SparkSession, folder: str) -> list[Row]:
    """The versions of a table, newest first; a row for each that is kept."""
    try:
        rows = spark.read.schema(_VERSION).parquet(f"{folder}/_versions").collect()
    except AnalysisException:  # nothing has been written yet
        return []
    return sorted(rows, key=lambda r: (r.number, r.path), reverse=True)


def _name_version(spark: SparkSession, folder: str, path: str, columns: StructType) -> None:
    newest = _versions(spark, folder)
    row = [((newest[0].number if newest else 0) + 1, path, columns.json())]
    spark.createDataFrame(row, _VERSION).coalesce(1).write.mode("append").parquet(f"{folder}/_versions")


def write_version(table: DataFrame, folder: str, *partitions: str) -> str:
    """Write ``table`` as the newest version of ``folder``; its path.

    The files stand in a folder of their own before one small row names them. Readers follow
    the newest such row, so they see the old version or the new one and nothing between, and
    a write that fails leaves no trace for them.
    """
    path = f"{folder}/version-{uuid.uuid4().hex}"
    table.write.partitionBy(*partitions).parquet(path)
    _name_version(table.sparkSession, folder, path, table.schema)
    return path


def read_version(spark: SparkSession, folder: str) -> DataFrame | None:
    """The newest version of ``folder``, also one without rows; None before the first."""
    newest = _versions(spark, folder)
    if not newest:
        return None
    return spark.read.schema(StructType.fromJson(json.loads(newest[0].columns))).parquet(newest[0].path)


def drop_old_versions(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Delete the files of all but the ``keep`` newest versions; how many there were.

    Readers that began before the newest ones were written need theirs until they end.
    """
    old = _versions(spark, folder)[keep:]
    for row in old:
        delete(spark, row.path)
    return len(old)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, whatever store it lies in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def write_extents(extents: DataFrame, folder: str) -> str:
    """All extent types as the newest version of ``folder``, in one pass over ``extents``."""
    return write_version(extents, folder, "extent_type")


def read_extents(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """The newest rows of an extent type; only its partition is read, and it may have no rows."""
    newest = read_version(spark, folder)
    if newest is None:
        raise FileNotFoundError(f"no extents have been written to {folder}")
    return newest.where(F.col("extent_type") == kind)


def scratch(df: DataFrame, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(df.sparkSession)}/firngrid/{name}-{uuid.uuid4().hex}"
