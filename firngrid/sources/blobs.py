"""Binary results of a run: ``.out`` is n as uint32, then n float32 of each of three bands."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROWS = "aval_id long, pos int, max_vel float, max_height float, depo float"


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """``path, content`` of the result files of a folder."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def pack(cells: DataFrame) -> DataFrame:
    """``aval_id, content``: the cells of each avalanche, in order of cell."""
    bands = ("max_vel", "max_height", "depo")
    rows = cells.groupBy("aval_id").agg(
        F.sort_array(F.collect_list(F.struct("cell", *bands))).alias("rows")
    )
    lists = rows.select("aval_id", *[F.col(f"rows.{b}").cast("array<float>").alias(b) for b in bands])

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            content = [
                np.uint32(len(v)).tobytes() + np.concatenate([v, h, d]).astype(np.float32).tobytes()
                for v, h, d in zip(*(frame[b] for b in bands), strict=True)
            ]
            yield pd.DataFrame({"aval_id": frame["aval_id"], "content": content})

    return lists.mapInPandas(packed, "aval_id long, content binary")


def decode_out(blobs: DataFrame) -> DataFrame:
    """``aval_id, pos, max_vel, max_height, depo`` of whole blobs; cut ones give no rows."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, found = [], []
            for key, content in zip(frame["aval_id"], frame["content"], strict=True):
                n = int(np.frombuffer(content, np.uint32, 1)[0]) if len(content) >= 4 else 0
                if n and len(content) == 4 + 12 * n:
                    keys.append(key)
                    found.append(np.frombuffer(content, np.float32, 3 * n, 4).reshape(3, n))
            if keys:
                sizes = [f.shape[1] for f in found]
                bands = np.concatenate(found, axis=1)
                yield pd.DataFrame(
                    {
                        "aval_id": np.repeat(keys, sizes),
                        "pos": np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]),
                        "max_vel": bands[0],
                        "max_height": bands[1],
                        "depo": bands[2],
                    }
                )

    return blobs.select("aval_id", "content").mapInPandas(rows, _ROWS)


def inconsistent(blobs: DataFrame) -> DataFrame:
    """``aval_id, n_bytes``: blobs whose length does not follow from their first number."""
    head = F.substring(F.hex("content"), 1, 8)
    # little-endian: the last byte of the head counts most
    swapped = F.concat(*[F.substring(head, k, 2) for k in (7, 5, 3, 1)])
    told = F.conv(swapped, 16, 10).cast("long")
    size = F.octet_length("content").cast("long")
    return blobs.select("aval_id", size.alias("n_bytes"), told.alias("n")).where(
        "n is null or n_bytes <> 4 + 12 * n"
    ).select("aval_id", "n_bytes")
