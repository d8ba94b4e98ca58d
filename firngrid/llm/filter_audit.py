"""What each filter of a chain removes, in every order in which the chain can run.

Up to five filters are judged on every document once. The subsets of the filters are the
numbers below 2**5, and a document becomes a 32-bit truth table: bit S is set if it
survives all filters of subset S. Failing filter k leaves only the subsets without k, so the
word is the conjunction of one constant for each failed filter. How many documents survive
each subset is a positional popcount of the words, made with carry-save adders: three words
of one weight become one of that weight and one of twice the weight, all 32 bits at a time,
so a task keeps at most two words of each weight for a part and label. The survivors of the
32 subsets answer every question about every order.

Defined results: null texts are empty; a null source is the part of the empty string;
repeated rows count each time, and are copies only of texts with a smaller id; a row without
an id is no copy, makes no copies and has no labels; a document with several labels has
every one of them; null labels are none; an empty table gives an empty table; extra columns
are ignored; texts of any length are judged whole.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firngrid.llm.texts import arrow_schema
from firngrid.sources.shared import staged

#: Filters that a 32-bit truth table has room for.
MOST = 5
#: Bit S of entry k is set if subset S does not hold filter k.
WITHOUT = [sum(1 << s for s in range(32) if not s >> k & 1) for k in range(MOST)]
#: Groups a task counts at a time; beyond, it gives out what it has and begins anew.
GROUPS = 4096


class CarrySave:
    """Positional popcounts of 32-bit words; level k has at most two words of weight 2**k."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def add(self, words: np.ndarray) -> None:
        """Count the bits of ``words`` (uint32)."""
        k = 0
        while words.size:
            if k == len(self.levels):
                self.levels.append(np.empty(0, np.uint32))
            level, carries = np.concatenate([self.levels[k], words]), []
            while level.size > 2:
                n = level.size // 3
                a, b, c, rest = np.split(level, [n, 2 * n, 3 * n])
                half = a ^ b
                carries.append((a & b) | (half & c))
                level = np.concatenate([half ^ c, rest])
            self.levels[k] = level
            words = np.concatenate(carries) if carries else words[:0]
            k += 1

    def counts(self) -> np.ndarray:
        """How many words had each bit."""
        total = np.zeros(32, np.int64)
        for k, level in enumerate(self.levels):
            total += (level[:, None] >> np.arange(32, dtype=np.uint32) & 1).sum(0, dtype=np.int64) << k
        return total


def survival_word(fails: list[Column]) -> Column:
    """The truth table of a row that fails where ``fails`` is true, as a long."""
    word = F.lit(2**32 - 1)
    for bits, failed in zip(WITHOUT, fails, strict=False):
        word = word.bitwiseAND(F.when(failed, F.lit(bits)).otherwise(F.lit(2**32 - 1)))
    return word


_COUNTS = "part string, good boolean, toxic boolean, counts array<long>"


def subset_counts(words: DataFrame) -> DataFrame:
    """``part, good, toxic, subset, n`` of ``words (part, good, toxic, word)``: the survivors of each subset."""
    schema = arrow_schema(_COUNTS)

    def given(sums: dict) -> pa.RecordBatch:
        part, good, toxic = zip(*sums, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip((part, good, toxic, [s.counts() for s in sums.values()]), schema, strict=True)],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, CarrySave] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column("part").dictionary_encode()
            good, toxic = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("good", "toxic"))
            code = parts.indices.to_numpy() * 4 + good * 2 + toxic
            order = np.argsort(code, kind="stable")
            word = batch.column("word").to_numpy().astype(np.uint32)[order]
            starts = np.flatnonzero(np.diff(code[order], prepend=-1))
            for at, some in zip(starts, np.split(word, starts[1:]), strict=True):
                c = int(code[order[at]])
                key = (parts.dictionary[c // 4].as_py(), bool(c & 2), bool(c & 1))
                sums.setdefault(key, CarrySave()).add(some)
            if len(sums) > GROUPS:
                yield given(sums)
                sums = {}
        if sums:
            yield given(sums)

    counted = words.select("part", "good", "toxic", "word").mapInArrow(run, _COUNTS)
    each = counted.select("part", "good", "toxic", F.posexplode("counts").alias("subset", "n"))
    return each.groupBy("part", "good", "toxic", "subset").agg(F.sum("n").alias("n"))


def audit(words: DataFrame, names: str) -> DataFrame:
    """A row for each part, order of the filters ``names`` (one letter each) and step of it.

    ``words`` has ``part, good, toxic, word``, the word by ``survival_word`` with the filters
    in the order of ``names``.
    """
    count, full = len(names), 2 ** len(names) - 1
    of = lambda label: F.sum(F.when(F.col(label), F.col("n")).otherwise(0))
    subsets = subset_counts(words).groupBy("part", "subset").agg(F.sum("n").alias("all"), of("good").alias("good"), of("toxic").alias("toxic"))
    row = F.array_sort(F.collect_list(F.struct("subset", "all", "good", "toxic")))  # 32 entries
    parts = subsets.groupBy("part").agg(row.alias("s")).select("part", *[F.col(f"s.{c}").alias(c) for c in ("all", "good", "toxic")])

    def share(k: int) -> Column:
        """Removed by filter k over all orders: each subset before it stands in so many of them."""
        return sum(
            (F.get("all", F.lit(s)) - F.get("all", F.lit(s | 1 << k))) * math.factorial(s.bit_count()) * math.factorial(count - 1 - s.bit_count())
            for s in range(full + 1)
            if not s >> k & 1
        )

    orders = ["".join(p) for p in itertools.permutations(names)]
    steps = (
        parts.withColumn("shares", F.array(*[share(k) for k in range(count)]))
        .withColumn("filter_order", F.explode(F.array(*map(F.lit, orders))))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(count))))
        .withColumn("place", F.expr(f"locate(substring(filter_order, step, 1), '{names}') - 1"))
        .withColumn("bit", F.expr("shiftleft(1, place)"))
        .withColumn("before", sum((F.expr(f"locate('{c}', filter_order) < step").cast("int") * 2**k for k, c in enumerate(names))))
        .withColumn("after", F.col("before") + F.col("bit"))
    )

    def lost(label: str) -> Column:
        return F.get(label, F.col("before")) - F.get(label, F.col("after"))

    fails = F.get("all", F.lit(0)) - F.get("all", F.col("bit"))
    return steps.select(
        "part",
        "filter_order",
        "step",
        F.get("all", F.col("after")).alias("kept"),
        lost("all").alias("removed"),
        (fails - lost("all")).alias("redundant"),
        (F.get("all", F.lit(full) - F.col("bit")) - F.get("all", F.lit(full))).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("shares", F.col("place")).alias("shapley"),
    )


def text_failures(text: Column) -> dict[str, Column]:
    """Filters A to D: too few words, too few distinct words, too many capitals, odd marks."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 50,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 65,
        "C": capitals * 100 > F.length(text) * 5,
        "D": text.rlike("[#$%&*|]"),
    }


def with_words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, part, good, toxic, word`` of every document, for filters A to E.

    Filter E removes a text that a smaller id has. The first id of a text is met by text and
    id together, so that copies of one text are spread by their ids.
    """
    text = F.coalesce("text", F.lit(""))
    light = staged(
        docs.select(
            "doc_id",
            F.coalesce("source", F.lit("")).alias("part"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            *[failed.alias(name) for name, failed in text_failures(text).items()],
        ),
        "audited",
    )
    firsts = light.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    known = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    with_id = (
        light.where("doc_id is not null")
        .join(firsts, ["digest", "doc_id"], "left")
        .join(known, "doc_id", "left")
        .withColumn("E", F.col("first").isNull())
    )
    without = light.where("doc_id is null").withColumns({"good": F.lit(False), "toxic": F.lit(False), "E": F.lit(False)})
    both = with_id.drop("first").unionByName(without)
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return both.select("doc_id", "part", flag("good"), flag("toxic"), survival_word([F.col(c) for c in "ABCDE"]).alias("word"))


ORACLE_SQL = r"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
l as (
  select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic
  from labels group by doc_id),
f as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    cast(len(w) < 50 as int) as a,
    cast(100 * len(list_distinct(w)) < 65 * len(w) as int) as b,
    cast(100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) as int) as c,
    cast(regexp_matches(t, '[#$%&*|]') as int) as d,
    cast(coalesce(doc_id > min(doc_id) over (partition by t), false) as int) as e
  from d left join l using (doc_id)),
m as (select part, good, toxic, a + 2*b + 4*c + 8*d + 16*e as mask, count(*) as n from f group by all),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
o as (
  select p.x || q.x || r.x || s.x || t.x as filter_order from x p, x q, x r, x s, x t
  where len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
k as (
  select filter_order, step, 1 << (ascii(filter_order[step]) - 65) as bit,
    cast(list_sum([1 << (ascii(y) - 65) for y in string_split(filter_order[1:step - 1], '') if y <> '']) as int) as before
  from o, (select unnest(range(1, 6)) as step)),
r as (
  select part, filter_order, step, bit,
    cast(sum(n) filter (mask & (coalesce(before, 0) | bit) = 0) as bigint) as kept,
    cast(sum(n) filter (mask & coalesce(before, 0) = 0 and mask & bit <> 0) as bigint) as removed,
    cast(sum(n) filter (mask & coalesce(before, 0) <> 0 and mask & bit <> 0) as bigint) as redundant,
    cast(sum(n) filter (mask = bit) as bigint) as unique_fails,
    cast(sum(n) filter (good and mask & coalesce(before, 0) = 0 and mask & bit <> 0) as bigint) as good_lost,
    cast(sum(n) filter (toxic and mask & coalesce(before, 0) = 0 and mask & bit <> 0) as bigint) as toxic_lost
  from m, k group by all)
select part, filter_order, cast(step as int) as step, coalesce(kept, 0) as kept, coalesce(removed, 0) as removed,
  coalesce(redundant, 0) as redundant, coalesce(unique_fails, 0) as unique_fails,
  coalesce(good_lost, 0) as good_lost, coalesce(toxic_lost, 0) as toxic_lost,
  cast(sum(coalesce(removed, 0)) over (partition by part, bit) as bigint) as shapley
from r
"""
