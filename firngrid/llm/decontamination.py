"""Benchmark decontamination over a positional inverted index, in DataFrame operations only.

The stored index holds a posting ``(term, doc_id, pos)`` of every word of the corpus, so
that one index serves any number of searches. A phrase search takes, from each window of
a benchmark item, the terms that are rarest in the corpus, subtracts their offset in the item from each of
their positions, and intersects these adjusted lists: what is left are places where
the rarest terms stand as far apart as in the window. Each such place is then
compared word by word with the text. A proximity search starts from the rarest term
and asks for all other terms within a distance.

Sides that are broadcast are counted first; beyond a bound the join shuffles.

Defined results: null texts have no words; an item without words is no item, nor is one
with a null id; items that share an id count once; rows with a repeated doc_id are judged
each by its own text; a row with a null doc_id is returned without hits; empty tables give
empty results; extra columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firngrid.llm.texts import fresh
from firngrid.sources.shared import staged

#: Consecutive words of a window; a shorter item is one window.
WINDOW = 13
#: Rarest terms of a window whose posting lists are intersected.
RAREST = 2
#: Terms, ids or benchmark words that may be broadcast at most (each some tens of bytes).
BROADCAST_ROWS = 200_000
#: Contaminated: some hit, and at least one word in so many is hit.
HIT_SHARE = 20
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text: A-Z lower-cased, split at ASCII marks and spaces."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    found = F.array_remove(F.split(lowered, _BREAK), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def small(side: DataFrame, rows: int) -> DataFrame:
    """``side``, to be broadcast if ``rows``, its counted size, is within the bound."""
    return F.broadcast(side) if rows <= BROADCAST_ROWS else side


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index of every term: ``term_key, term, doc_id, pos``, positions from 0.

    Each posting is a row, so no term and no document is ever one group. Files are sorted
    by the hash of the term: the postings of a term lie together, and row groups without
    it can be skipped. Searches read the index and not the corpus.
    """
    tokens = docs.select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    keyed = tokens.select(F.xxhash64("term").alias("term_key"), "term", "doc_id", "pos")
    return staged(keyed.sortWithinPartitions("term_key"), "postings")


def term_counts(index: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """``term, n_corpus``: how often each of ``terms (term)`` stands in the corpus."""
    postings = index.select("term")
    if n_terms <= BROADCAST_ROWS:
        postings = postings.join(F.broadcast(terms), "term")
        return postings.groupBy("term").agg(F.count("*").alias("n_corpus"))
    counted = postings.groupBy("term").agg(F.count("*").alias("n_corpus"))
    return counted.join(terms, "term")


def phrases_of(items: DataFrame) -> DataFrame:
    """``phrase, item_id, item_words, size``: each item with words, under a key of its own."""
    return (
        items.where("item_id is not null")
        .select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("item_words"))
        .where(F.size("item_words") > 0)
        .dropDuplicates(["item_id", "item_words"])
        .select(
            F.xxhash64("item_id", F.array_join("item_words", " ")).alias("phrase"),
            "item_id",
            "item_words",
            F.least(F.size("item_words"), F.lit(WINDOW)).alias("size"),
        )
    )


def _rarest(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """``phrase, start, pos, term``: the rarest terms of each window that can occur at all."""
    placed = phrases.select(
        "phrase",
        "size",
        F.size("item_words").alias("n"),
        F.posexplode("item_words").alias("pos", "term"),
    ).join(counts, "term", "left")
    first = F.greatest(F.lit(0), F.col("pos") - F.col("size") + 1)
    last = F.least(F.col("pos"), F.col("n") - F.col("size"))
    in_windows = placed.select(
        "phrase",
        "pos",
        "term",
        F.coalesce("n_corpus", F.lit(0)).alias("n_corpus"),
        F.explode(F.sequence(first, last)).alias("start"),
    )
    window = Window.partitionBy("phrase", "start")
    ranked = in_windows.select(
        "*",
        F.row_number().over(window.orderBy("n_corpus", "pos")).alias("rank"),
        F.min("n_corpus").over(window).alias("least"),
    )
    return ranked.where(f"rank <= {RAREST} and least > 0").select("phrase", "start", "pos", "term")


def phrase_candidates(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """``doc_id, found``: places that the intersected posting lists leave, by document.

    ``found`` lists ``(item_id, item_words, size, shift, starts)``: window ``start`` of the
    item may stand at word ``start + shift`` of the document.
    """
    phrases = staged(phrases, "phrases")
    terms = phrases.select(F.explode("item_words").alias("term")).distinct()
    terms = staged(terms, "terms")
    n_terms = terms.count()
    counts = term_counts(index, terms, n_terms)
    rarest = staged(_rarest(phrases, counts), "rarest")
    anchors = rarest.select("phrase", "pos", "term").distinct()
    n_anchors = anchors.count()
    adjusted = (
        index.join(small(anchors.withColumnRenamed("pos", "item_pos"), n_anchors), "term")
        .groupBy("doc_id", "phrase", (F.col("pos") - F.col("item_pos")).alias("shift"))
        .agg(F.collect_set("item_pos").alias("met"))
    )
    windows = rarest.groupBy("phrase", "start").agg(F.collect_set("pos").alias("asked"))
    plans = windows.groupBy("phrase").agg(F.collect_list(F.struct("start", "asked")).alias("windows"))
    plans = plans.join(phrases, "phrase")
    left = F.filter(
        "windows", lambda w: F.size(F.array_except(w["asked"], F.col("met"))) == 0
    )
    places = (
        adjusted.join(small(plans, n_anchors), "phrase")
        .withColumn("starts", F.transform(left, lambda w: w["start"]))
        .where(F.size("starts") > 0)
    )
    return places.groupBy("doc_id").agg(
        F.collect_list(F.struct("item_id", "item_words", "size", "shift", "starts")).alias("found")
    )


def hits(docs: DataFrame, items: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """One row per document: words, hit words, items and whether it is contaminated.

    ``index`` is the stored index of ``docs``; without one it is built.
    """
    index = build_index(docs) if index is None else index
    found = staged(phrase_candidates(index, phrases_of(items)), "candidates")
    ids = found.select("doc_id")
    n_ids = found.count()
    texts = docs.select("doc_id", words(F.col("text")).alias("words"))

    def occurs(place: Column, start: Column) -> Column:
        at = start + place["shift"]
        same = F.slice(place["item_words"], start + 1, place["size"]) == F.slice(
            F.col("words"), at + 1, place["size"]
        )
        return F.when(at >= 0, same).otherwise(F.lit(False))

    exact = F.transform(
        "found",
        lambda p: F.struct(
            p["item_id"].alias("item_id"),
            p["size"].alias("size"),
            p["shift"].alias("shift"),
            F.filter(p["starts"], lambda s: occurs(p, s)).alias("starts"),
        ),
    )
    covered = F.flatten(
        F.transform(
            "exact",
            lambda p: F.flatten(
                F.transform(
                    p["starts"],
                    lambda s: F.sequence(s + p["shift"], s + p["shift"] + p["size"] - 1),
                )
            ),
        )
    )
    matched = F.transform(
        F.filter("exact", lambda p: F.size(p["starts"]) > 0), lambda p: p["item_id"]
    )
    with_places = (
        texts.join(small(ids, n_ids), "doc_id", "left_semi")
        .join(found, "doc_id")
        .withColumn("exact", exact)
        .select(
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
            F.array_sort(F.array_distinct(matched)).alias("items"),
        )
    )
    without = texts.join(small(ids, n_ids), "doc_id", "left_anti").select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<string>").alias("items"),
    )
    return with_places.unionByName(without).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def near(index: DataFrame, items: DataFrame, distance: int) -> DataFrame:
    """``doc_id, item_id``: documents with all terms of an item near its rarest one.

    Near is at most ``distance`` words before or after some occurrence of the rarest term.
    Postings meet by document, term and block of ``distance + 1`` words, so an occurrence
    is compared with those of three blocks only, however long the document is.
    """
    phrases = staged(phrases_of(items), "phrases")
    wanted = phrases.select("phrase", "item_id", F.explode("item_words").alias("term")).distinct()
    terms = staged(wanted.select("term").distinct(), "terms")
    n_terms = terms.count()
    counts = term_counts(index, terms, n_terms)
    order = Window.partitionBy("phrase").orderBy("n_corpus", "term")
    whole = Window.partitionBy("phrase")
    ranked = wanted.join(counts, "term", "left").select(
        "*",
        F.row_number().over(order).alias("rank"),
        F.count("*").over(whole).alias("n_terms"),
        F.count("n_corpus").over(whole).alias("n_known"),
    )
    ranked = staged(ranked.where("n_known = n_terms"), "wanted")
    n_ranked = ranked.count()
    seeds = index.join(small(ranked.where("rank = 1").select("term", "phrase"), n_ranked), "term").select(
        "doc_id", "phrase", F.col("pos").alias("seed")
    )
    block = F.floor(F.col("seed") / (distance + 1))
    around = seeds.join(small(ranked.select("phrase", "term", "item_id", "n_terms"), n_ranked), "phrase").select(
        "*", F.explode(F.array(block - 1, block, block + 1)).alias("block")
    )
    postings = index.join(small(terms, n_terms), "term", "left_semi").select(
        "term", "doc_id", "pos", F.floor(F.col("pos") / (distance + 1)).alias("block")
    )
    return (
        around.join(postings, ["doc_id", "term", "block"])
        .where(F.abs(F.col("pos") - F.col("seed")) <= distance)
        .groupBy("doc_id", "item_id", "phrase", "seed", "n_terms")
        .agg(F.countDistinct("term").alias("met"))
        .where("met = n_terms")
        .select("doc_id", "item_id")
        .distinct()
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, each judged by its own text."""
    key = F.xxhash64("text")
    found = hits(docs.select(key.alias("doc_id"), "text"), items)
    own = fresh(docs, "text_key")
    bad = found.where("contaminated").select(F.col("doc_id").alias(own)).distinct()
    bad = staged(bad, "contaminated")
    keyed = docs.withColumn(own, key)
    return keyed.join(small(bad, bad.count()), own, "left_anti").select(docs.columns)


ORACLE_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
i as (
  select cast(item_id as varchar) as item_id, w, least(13, len(w)) as l from (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark)
  where len(w) > 0),
iw as (select item_id, l, list_slice(w, s + 1, s + l) as k
       from (select item_id, w, l, unnest(range(0, len(w) - l + 1)) as s from i)),
dw as (select doc_id, l, s, list_slice(w, s + 1, s + l) as k
       from (select doc_id, w, l, unnest(range(0, len(w) - l + 1)) as s
             from d, (select distinct l from i) where len(w) >= l)),
h as (select doc_id, item_id, s, l from dw join (select distinct * from iw) using (l, k)),
p as (select doc_id, count(distinct pos) as n_hit
      from (select doc_id, unnest(range(s, s + l)) as pos from h) group by doc_id),
m as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
      from (select distinct doc_id, item_id from h) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join p using (doc_id) left join m using (doc_id)
"""
