"""Shards of nearly equal bytes, cut from one global order by prefix sums.

Rows are dealt by ranges of ``(group, id)`` and sorted. The totals of the ranges, one row a
range, give each range its offset, and a running sum inside of the range does the rest: every
row knows the bytes before it in the whole table. A row goes to the shard in which its middle
byte lies when all bytes are cut at equal targets, so shards are contiguous in the order and
no shard is farther from the target than one largest row.

The rows of a group (equal texts, in the registered query) lie side by side. A group that is
no larger than the largest row goes whole to the shard of its own middle, at no cost for
that bound; a larger one is cut like anything else, so that copies of a third of all rows
fill many shards. Nothing is sorted or summed in one task: a large group is dealt by its ids.

Defined results: a null text has no bytes, and its crc32 is that of the empty text; rows
without an id come first in their group; rows that repeat both text and id lie in one shard;
shards may be empty where there are few rows; an empty table gives an empty table; extra
columns are ignored by ``placed`` and kept by ``write``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firngrid.llm.texts import fresh
from firngrid.sources.shared import staged

#: Bytes that a row takes beside its text.
ROW_BYTES = 16


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text and of what stands beside it."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def text_group(text: Column) -> Column:
    """A number that equal texts share; null and empty texts share one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def measured(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """``doc_id, size, text_crc32, grp`` of every document."""
    of = F.coalesce(text, F.lit(""))
    return docs.select(
        F.col(row_id).alias("doc_id"), text_size(F.col(text)).alias("size"), F.crc32(of).alias("text_crc32"), text_group(F.col(text)).alias("grp")
    )


def _across(ranges: DataFrame, totals: list) -> dict[int, tuple[int, int]]:
    """Start and bytes of the groups that go on from one range to the next, by group.

    Only the first and last group of a range can, so these are two for each range at most.
    """
    wide = sorted({a.last for a, b in zip(totals, totals[1:], strict=False) if a.last == b.first})
    if not wide:
        return {}
    ends, at = {}, 0
    for t in totals:
        ends[t.rng] = at = at + t["bytes"]
    parts = ranges.where(F.col("grp").isin(wide)).groupBy("grp", "rng").agg(F.sum("size").alias("size"))
    found: dict[int, tuple[int, int]] = {}
    for p in sorted(parts.collect(), key=lambda p: p.rng):
        # a group is the last one of its first range
        start, size = found.get(p.grp, (ends[p.rng] - p["size"], 0))
        found[p.grp] = start, size + p["size"]
    return found


def placed(rows: DataFrame, n: int) -> DataFrame:
    """``rows (doc_id, size, grp, ...)`` with ``shard`` (0 to n - 1) and ``slot`` (0, 1, ... in it)."""
    spark = rows.sparkSession
    order = [F.col("grp").asc(), F.col("doc_id").asc_nulls_first()]
    dealt = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    ranges = staged(dealt.withColumn("rng", F.spark_partition_id()), "ranges")
    totals = (
        ranges.groupBy("rng")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.max("size").alias("most"), F.min("grp").alias("first"), F.max("grp").alias("last"))
        .orderBy("rng")
        .collect()  # one row for each range
    )
    if not totals:
        return rows.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    all_bytes, most = sum(t["bytes"] for t in totals), max(t.most for t in totals)
    offsets, at, count = [], 0, 0
    for t in totals:
        offsets.append((t.rng, at, count))
        at, count = at + t["bytes"], count + t["rows"]
    offset = spark.createDataFrame(offsets, "rng int, before long, count long")
    across = spark.createDataFrame(
        [(g, *v) for g, v in _across(ranges, totals).items()], "grp long, wide_start long, wide_bytes long"
    )

    in_order = Window.partitionBy("rng").orderBy(*order)
    peers, group = Window.partitionBy("rng", "grp", "doc_id"), Window.partitionBy("rng", "grp")
    through = F.sum("size").over(in_order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    middle = F.when(
        F.col("group_bytes") <= most, 2 * F.col("group_start") + F.col("group_bytes")
    ).otherwise(2 * F.col("through") - F.col("peer_bytes"))
    ranked = (
        ranges.join(F.broadcast(offset), "rng")
        .withColumns(
            {
                "through": F.col("before") + through,
                "rank": F.col("count") + F.row_number().over(in_order) - 1,
                "peer_bytes": F.sum("size").over(peers),
                "group_bytes": F.sum("size").over(group),
            }
        )
        .withColumn("group_start", F.min(F.col("through") - F.col("peer_bytes")).over(group))
        .join(F.broadcast(across), "grp", "left")
        .withColumns(
            {
                "group_start": F.coalesce("wide_start", "group_start"),
                "group_bytes": F.coalesce("wide_bytes", "group_bytes"),
            }
        )
        .withColumn("twice", middle)
    )
    # the middle as a share of all bytes, in whole numbers
    shard = F.expr(f"cast(cast(twice as decimal(19, 0)) * cast({n} as decimal(9, 0)) div cast({2 * all_bytes} as decimal(20, 0)) as int)")
    found = staged(ranked.select(*[F.col(c) for c in rows.columns], shard.alias("shard"), "rank"), "placed")
    firsts = found.groupBy("shard").agg(F.min("rank").alias("first_rank"))  # at most n rows
    return (
        found.join(F.broadcast(firsts), "shard")
        .withColumn("slot", F.col("rank") - F.col("first_rank"))
        .select(*rows.columns, "shard", "slot")
    )


def write(docs: DataFrame, n: int, path: str, files: int | None = None) -> None:
    """Write ``docs`` to ``path/shard=<k>``, as placed: all its columns, in about ``files`` files.

    A shard is a range of ``(group, id)``, so rows find theirs by the first row of each shard,
    and texts are moved once, by ranges of that order, several files to a large shard.
    """
    spark = docs.sparkSession
    first = F.min(F.struct("grp", "doc_id"))
    cuts = placed(measured(docs), n).groupBy("shard").agg(first.alias("key")).orderBy("shard").collect()  # at most n rows
    shard, grp = fresh(docs, "shard"), fresh(docs, "grp")
    keyed = docs.withColumn(grp, text_group(F.col("text")))
    found = F.lit(0)
    if cuts:
        row = spark.createDataFrame([([(c.key.grp, c.key.doc_id) for c in cuts], [c.shard for c in cuts])], "keys array<struct<grp:long,doc_id:long>>, shards array<int>")
        keyed = keyed.crossJoin(F.broadcast(row.select(F.col("keys").alias(keys := fresh(docs, "cut_keys")), F.col("shards").alias(shards := fresh(docs, "cut_shards")))))
        own = F.struct(F.col(grp).alias("grp"), F.col("doc_id").cast("long").alias("doc_id"))
        found = F.element_at(F.col(shards), F.size(F.filter(F.col(keys), lambda k: k <= own)))
    (
        keyed.withColumn(shard, found)
        .repartitionByRange(files or int(spark.conf.get("spark.sql.shuffle.partitions")), shard, grp, F.col("doc_id").asc_nulls_first())
        .select(*docs.columns, shard)
        .write.partitionBy(shard)
        .option("compression", "zstd")
        .parquet(path)
    )
