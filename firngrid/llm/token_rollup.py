"""Token totals that are kept up to date by signed changes.

A batch of changes becomes additive deltas by source, language and tokenizer version:
an insert adds a document and its tokens, a delete takes them away, a revision takes away
the old count and adds the new one. The totals are the sums of the deltas of committed
batches. A commit first writes the deltas under an attempt of its own and then one row
that names batch, attempt and time; readers take the first attempt of each committed batch.
So a batch that is sent again, or that failed half-way and was retried, or that two writers
commit at once, counts once, and a later commit of it never changes the totals. ``snapshot``
writes the totals so far with the batches that they hold; readers then add later batches only.

Defined results: null texts have 0 tokens; null sources and languages are groups of their
own; repeated rows count each time; a delete of what was never inserted goes below zero
rather than be lost; groups whose totals are both 0 are left out; an empty batch can be
committed and changes nothing; extra columns are ignored.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
_DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long, batch string, attempt string"
_COMMIT = "batch string, attempt string, at long"
_SNAPSHOT = "source string, lang string, tokenizer string, n_docs long, n_tokens long, number long"
_HELD = "batch string, number long"


def words_1(text: Column) -> Column:
    """Tokenizer version ``words-1``: runs of anything but ASCII white space."""
    found = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    return F.coalesce(F.size(found), F.lit(0)).cast("long")


def bytes_4(text: Column) -> Column:
    """Tokenizer version ``bytes-4``: four UTF-8 bytes are a token, the rest is one more."""
    return F.coalesce(F.ceil(F.octet_length(text) / 4), F.lit(0)).cast("long")


TOKENIZERS = {"words-1": words_1, "bytes-4": bytes_4}


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, source, lang, tokenizer, n``: the tokens of each document, by tokenizer."""
    each = F.array(
        *[
            F.struct(F.lit(name).alias("tokenizer"), count(F.col(text)).alias("n"))
            for name, count in TOKENIZERS.items()
        ]
    )
    return docs.select("doc_id", "source", "lang", F.inline(each))


def signed_changes(counts: DataFrame, sign: int) -> DataFrame:
    """Changes that insert (1) or delete (-1) the documents of ``counts``."""
    return counts.select(
        *KEYS, F.lit(sign).cast("long").alias("n_docs"), (sign * F.col("n")).alias("n_tokens")
    )


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes that replace the counts ``old`` by the counts ``new``."""
    return signed_changes(old, -1).unionByName(signed_changes(new, 1))


class TokenRollup:
    """The deltas, the commit log and the snapshots under a folder that all machines reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.deltas, self.commits = spark, f"{path}/deltas", f"{path}/commits"
        self.snapshots, self.held = f"{path}/snapshots", f"{path}/held"
        for folder, schema in ((self.deltas, _DELTA), (self.commits, _COMMIT), (self.snapshots, _SNAPSHOT), (self.held, _HELD)):
            spark.createDataFrame([], schema).write.mode("append").parquet(folder)

    def stage(self, batch: str, changes: DataFrame) -> str:
        """Write the deltas of a batch without committing them; returns the attempt."""
        attempt = uuid.uuid4().hex
        changes.groupBy(*KEYS).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
        ).withColumns({"batch": F.lit(batch), "attempt": F.lit(attempt)}).write.mode("append").parquet(self.deltas)
        return attempt

    def record(self, batch: str, attempt: str) -> None:
        """Commit a staged attempt."""
        row = [(batch, attempt, time.time_ns())]
        self.spark.createDataFrame(row, _COMMIT).coalesce(1).write.mode("append").parquet(self.commits)

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Apply a batch; one that is committed already changes nothing."""
        known = self.spark.read.schema(_COMMIT).parquet(self.commits)
        if known.where(F.col("batch") == batch).isEmpty():
            self.record(batch, self.stage(batch, changes))

    def _later(self) -> tuple[DataFrame, DataFrame, int]:
        """First attempts of the batches that the newest snapshot does not hold, its totals, and its number."""
        held = self.spark.read.schema(_HELD).parquet(self.held)
        number = held.agg(F.max("number")).first()[0] or 0
        log = self.spark.read.schema(_COMMIT).parquet(self.commits)
        first = log.groupBy("batch").agg(F.min_by("attempt", F.struct("at", "attempt")).alias("attempt"))
        later = first.join(held.where(F.col("number") == number), "batch", "left_anti")
        return later, self.spark.read.schema(_SNAPSHOT).parquet(self.snapshots).where(F.col("number") == number), number

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens`` over all committed batches."""
        return self._totals_of().where("n_docs <> 0 or n_tokens <> 0")

    def snapshot(self) -> None:
        """Keep the totals so far. One that fails before its last write is never read.

        One writer at a time makes snapshots; commits may go on meanwhile.
        """
        later, _, number = self._later()
        fixed = later.select("batch").collect()  # a name for each batch since the last snapshot
        if not fixed:
            return
        new = max(time.time_ns(), number + 1)
        names = self.spark.createDataFrame([(r.batch,) for r in fixed], "batch string")
        held = self.spark.read.schema(_HELD).parquet(self.held).where(F.col("number") == number).select("batch")
        self._totals_of(names).withColumn("number", F.lit(new)).write.mode("append").parquet(self.snapshots)
        names.unionByName(held).withColumn("number", F.lit(new)).coalesce(1).write.mode("append").parquet(self.held)

    def _totals_of(self, names: DataFrame | None = None) -> DataFrame:
        """The newest snapshot and the later batches, of ``names`` or all."""
        later, before, _ = self._later()
        columns = (*KEYS, "n_docs", "n_tokens")
        some = later if names is None else later.join(names, "batch", "left_semi")
        deltas = self.spark.read.schema(_DELTA).parquet(self.deltas).join(some, ["batch", "attempt"], "left_semi")
        both = deltas.select(*columns).unionByName(before.select(*columns))
        return both.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


ORACLE_SQL = r"""
with d as (
  select doc_id, source, lang, text, split_part(text, chr(10), 1) as line from documents),
c as (
  select doc_id, source, lang, 'words-1' as tokenizer,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n,
    len(regexp_extract_all(coalesce(line, ''), '[^\x20\x09-\x0D]+')) as n_line from d
  union all
  select doc_id, source, lang, 'bytes-4', cast(ceil(strlen(coalesce(text, '')) / 4.0) as bigint),
    cast(ceil(strlen(coalesce(line, '')) / 4.0) as bigint) from d),
k as (
  select source, lang, tokenizer, 1 as s, n from c
  union all
  select source, lang, tokenizer, -1, -n from c join labels using (doc_id) where toxic = 1
  union all
  select source, lang, tokenizer, 0, n_line - n from c join labels using (doc_id)
  where toxic = 0 and quality = 0)
select source, lang, tokenizer, cast(sum(s) as bigint) as n_docs, cast(sum(n) as bigint) as n_tokens
from k group by all having sum(s) <> 0 or sum(n) <> 0
"""
