"""Small helpers that the text operators share: Arrow batches in, columns out, word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch. Texts run to 100 kB and more, so a batch stays some tens of MB.
BATCH_ROWS = 256
#: Entries of a worker's word memo; it is emptied when full, so memory stays bounded.
MEMO_WORDS = 200_000


def keep_batches_small(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows in this session."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()),
}


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow form of a Spark schema string such as ``"doc_id long, text string"``."""
    return pa.schema([(n, _ARROW[t]) for n, t in (f.split(" ") for f in schema.split(", "))])


def map_batches(
    df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str
) -> DataFrame:
    """``fn`` gets a batch as ``{column: list}`` and returns the columns of ``schema``."""
    keep_batches_small(df.sparkSession)
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch.to_pydict())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)


class _Memo(dict):
    """Word -> 64-bit hash, filled as words come."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_MEMO = _Memo()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(_MEMO.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection, so no two values meet)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return x.view(np.int64)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def sampled(df: DataFrame, wanted: int) -> DataFrame:
    """The ``wanted`` distinct texts of ``df (text)`` with the least hashes, or all if fewer.

    Most rows are cut by their hash alone, so that no task gets more than a few times
    ``wanted`` texts, however many partitions there are.
    """
    texts = df.select("text").where("text is not null").withColumn("h", F.xxhash64("text"))
    near = thinned(texts, wanted)
    return near.dropDuplicates(["h"]).orderBy("h").limit(wanted).select("text")


def thinned(df: DataFrame, wanted: int, by: str | None = None) -> DataFrame:
    """Rows of ``df (h)`` that hold the ``wanted`` least distinct hashes, of each value of ``by``.

    The bound is the least power of two under which so many distinct hashes lie; they are
    counted, so repeated rows do not count and a group with fewer hashes keeps all its rows.
    """
    # hashes in their order as unsigned numbers, which have so many binary digits
    digits = F.length(F.bin(F.col("h").bitwiseXOR(F.lit(-(2**63)))))
    group = F.col(by) if by else F.lit("")
    distinct = df.select(group.alias("group"), "h").distinct()
    found = distinct.groupBy("group", digits.alias("digits")).count().collect()
    bounds: dict[str, int] = {}
    met: dict[str, int] = {}
    for row in sorted(found, key=lambda r: r.digits):
        if met.get(row.group, 0) < wanted:
            met[row.group] = met.get(row.group, 0) + row["count"]
            bounds[row.group] = row.digits
    if not bounds:
        return df
    bound_of = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])
    return df.where(digits <= bound_of[group])
