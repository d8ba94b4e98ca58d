"""The polled parts of the work as streams.

Sources are folders of files; each run takes what is new since the last one and ends
(``availableNow``), or goes on under a trigger of the caller's.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from firngrid.sources import blobs, sinks


def files(spark: SparkSession, path: str, schema: StructType, per_batch: int = 1000) -> DataFrame:
    """New Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def drained(stream: DataFrame, out: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is new, into the folder ``out``; what all runs have written.

    The checkpoint stands beside ``out``, so a later run over the same folders goes on where
    this one ended.
    """
    log = f"{out}-log"
    query = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", log).trigger(availableNow=True).start(out)
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def archived(results: DataFrame) -> DataFrame:
    """Decoded cells of new result blobs."""
    return blobs.decode_out(results)


_LATEST = "id long, chunkid int, ts timestamp, id_status int"


def _status_events(events: DataFrame) -> DataFrame:
    return events.where("ts is not null").select(F.col("id").cast("long").alias("id"), F.col("chunkid").cast("int").alias("chunkid"), "ts", F.col("id_status").cast("int").alias("id_status"))


def latest_status(events: DataFrame, lateness: str, idle_days: int = 30) -> DataFrame:
    """``id, chunkid, ts, id_status``: the latest status of each key that a batch has touched.

    A key keeps one row of state. It is dropped once event time has gone ``idle_days`` beyond
    the key's last event, so the state does not grow with all runs that ever were. Rows later
    than ``lateness`` are left out.
    """

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best = state.get if state.exists else None
        for frame in frames:
            micros = frame["ts"].astype("datetime64[us]").astype("int64")
            found = max(zip(micros.tolist(), frame["id_status"].tolist(), strict=True), default=best)
            best = found if best is None else max(tuple(best), found)
        state.update(tuple(best))
        # event time is in milliseconds here, and an end must lie ahead of the watermark
        ends = best[0] // 1000 + idle_days * 86_400_000
        state.setTimeoutTimestamp(max(ends, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"id": [key[0]], "chunkid": [key[1]], "ts": pd.to_datetime([best[0]], unit="us"), "id_status": [best[1]]})

    return _status_events(events).withWatermark("ts", lateness).groupBy("id", "chunkid").applyInPandasWithState(
        update, _LATEST, "ts long, id_status int", "update", GroupStateTimeout.EventTimeTimeout
    )


def latest_status_table(events: DataFrame, lateness: str, out: str) -> DataFrame:
    """All that is new in ``events``, put into the table ``out``; the latest status of every key so far.

    A batch writes its own folder, once more if it is repeated, and only the keys that it
    touched. The table is all that is remembered of a key, so the stream has no state: beside
    the batches stands the latest time seen up to each, and rows of a batch that are later than
    ``lateness`` before that of the batches before it are left out. ``compact`` puts the
    folders together.
    """
    spark = events.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        seen = spark.read.schema("micros long").parquet(f"{out}/seen/batch={number - 1}").first().micros if number else None
        rows = batch
        if seen is not None:
            rows = rows.where(F.col("ts") > F.timestamp_micros(F.lit(seen // 1000 * 1000)) - F.expr(f"interval {lateness}"))
        latest = F.max(F.struct("ts", "id_status")).alias("s")
        at = f"{out}/batches/batch={number}"
        rows.groupBy("id", "chunkid").agg(latest).select("id", "chunkid", "s.ts", "s.id_status").write.mode("overwrite").parquet(at)
        newest = spark.read.schema(_LATEST).parquet(at).agg(F.greatest(F.lit(seen).cast("long"), F.unix_micros(F.max("ts"))).alias("micros"))
        newest.write.mode("overwrite").parquet(f"{out}/seen/batch={number}")

    stream = _status_events(events).writeStream.option("checkpointLocation", f"{out}-log")
    stream.trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    return status_table(spark, out).select("id", "chunkid", "id_status")


def status_table(spark: SparkSession, out: str) -> DataFrame:
    """``id, chunkid, ts, id_status`` of the newest compacted version and the batches after it."""
    rows = spark.read.schema(f"{_LATEST}, batch long").parquet(f"{out}/batches")
    base = sinks.read_version(spark, f"{out}/base")
    if base is not None:
        through = base.agg(F.max("through")).first()[0]
        rows = rows.where(F.col("batch") > through).drop("batch").unionByName(base.drop("through"))
    latest = F.max(F.struct("ts", "id_status")).alias("s")
    return rows.groupBy("id", "chunkid").agg(latest).select("id", "chunkid", "s.ts", "s.id_status")


def compact(spark: SparkSession, out: str) -> int:
    """Make the batches of a status table its newest version and delete their folders; how many there were.

    Not to be run while a reader of the folders is at work.
    """
    batches = [r.batch for r in spark.read.schema(f"{_LATEST}, batch long").parquet(f"{out}/batches").select("batch").distinct().collect()]
    if batches:
        sinks.write_version(status_table(spark, out).withColumn("through", F.lit(max(batches)).cast("long")), f"{out}/base")
        for number in batches:
            sinks.delete(spark, f"{out}/batches/batch={number}")
        sinks.drop_old_versions(spark, f"{out}/base", 1)
    return len(batches)


def snow_sums(steps: DataFrame, origin_offset: str, lateness: str) -> DataFrame:
    """Three-day sums of ``cell, ts, value``; a window is given once no more rows can come."""
    window = F.window("ts", "3 days", "3 days", origin_offset)
    return steps.withWatermark("ts", lateness).groupBy("cell", window.alias("w")).agg(F.sum("value").alias("acsnow")).select(
        "cell", F.col("w.start").alias("start"), "acsnow"
    )


def without_duplicates(events: DataFrame, keys: list[str], lateness: str) -> DataFrame:
    """The first row of each key within the lateness."""
    return events.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(keys)
