"""Tables written to and read from the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where that is unset, one of our own on a single machine; on a cluster, whose machines do
    not share their folders, an error.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read of the table and not a
    new run of what made it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/firngrid/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that ``dealt`` gives to a task.
TASK_ROWS = 300_000


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in tasks of about ``TASK_ROWS`` rows, however large the table.

    Without this the rows of a task are those of a file's part, of up to 128 MB, or of as many
    shuffled bytes as the planner puts together, and both are compressed.
    """
    return df.repartition(tasks(df), *keys)


def tasks(df: DataFrame, times: int = 1) -> int:
    """Tasks of about ``TASK_ROWS`` rows for ``times`` the rows of ``df``."""
    return df.count() * times // TASK_ROWS + 1


def unsent(df: DataFrame) -> DataFrame:
    """``df`` as a side of joins that do not broadcast it.

    The planner knows a table by the size of its compressed files, of which a few MB may hold
    millions of rows, and a broadcast holds all of them in the driver and in every executor.
    """
    return df.hint("merge")


def grown(df: DataFrame, name: str, table: Callable[[], DataFrame] | None = None) -> Callable[[], DataFrame]:
    """Append ``df`` to a table of the shared folder, a new one without ``table``; what reads it.

    A set that grows by steps is written once, and not again at each step.
    """
    path = table.path if table else f"{shared_dir(df.sparkSession)}/firngrid/{name}-{uuid.uuid4().hex}"
    df.write.mode("append").option("compression", "zstd").parquet(path)

    def read() -> DataFrame:
        return df.sparkSession.read.schema(df.schema).parquet(path)

    read.path = path
    return read
