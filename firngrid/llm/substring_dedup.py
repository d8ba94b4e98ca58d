"""Substring deduplication by Rabin-Karp hashes of fixed-length word windows.

Every window of WINDOW consecutive words has a polynomial hash, rolled along the text
by prefix sums. Spark counts in which documents a hash stands; a window that also
starts in a document with a smaller id is repeated, and the repeated windows of a
document merge into maximal intervals of words to remove.

Most windows occur once, and sending all of them around would move several times the
corpus. So each window first names its anchor, the run of ANCHOR words in it with the
smallest hash. Equal windows have equal anchors, and neighbouring windows mostly share
one, so counting the few anchors first shows which windows can be repeated at all;
only these windows are then counted. Nothing is lost by it: a window whose anchor stands
in one document only stands in that document only.

Defined results: null texts have no words; a text shorter than a window keeps all its
words; repeats inside one document are kept; rows that repeat an id count as one document
and each is judged by its own text; a row with a null id keeps all its words and removes
none; empty tables give empty tables; extra columns are kept by ``deduplicated`` and
ignored else. A window is known by two independent 64-bit hashes, of two bases and two
word hashes; both must be equal for it to be repeated, so that none of the 10**13 windows of
100 TB is expected to meet another by chance. Inside one document one of them is enough.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firngrid.llm.texts import fresh, map_batches, mixed, signed, word_hashes
from firngrid.sources.shared import staged

WINDOW = 50
ANCHOR = 16
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_CHECK_BASE = 0xD1342543DE82EF95
_CHECK_INVERSE = pow(_CHECK_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_BASES = {False: (_BASE, _INVERSE), True: (_CHECK_BASE, _CHECK_INVERSE)}
_POWERS: dict[bool, list[np.ndarray]] = {k: [_powers(b, 1) for b in v] for k, v in _BASES.items()}


def rolled(prefix: np.ndarray, size: int, back: np.ndarray) -> np.ndarray:
    """Hashes of all runs of ``size`` words, from the prefix sums of the weighted words."""
    return mixed((prefix[size:] - prefix[:-size]) * back[: len(prefix) - size])


def _prefix(hashes: np.ndarray, check: bool = False) -> tuple[np.ndarray, np.ndarray]:
    n = len(hashes)
    if len(_POWERS[check][0]) <= n:
        _POWERS[check] = [_powers(b, 2 * n + 1) for b in _BASES[check]]
    forth, back = _POWERS[check]
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * forth[:n], out=prefix[1:])
    return prefix, back


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def windows(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the anchor of every window of a text."""
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    prefix, back = _prefix(word_hashes(words))
    anchor = min(ANCHOR, window)
    anchors = _least_of(rolled(prefix, anchor, back), window - anchor + 1)
    return rolled(prefix, window, back), anchors


def checks(words: list[bytes], window: int) -> np.ndarray:
    """The second hash of every window of a text."""
    if len(words) < window:
        return np.zeros(0, np.uint64)
    second = np.fromiter((xxhash.xxh64_intdigest(w, 1) for w in words), np.uint64, len(words))
    prefix, back = _prefix(second, check=True)
    return rolled(prefix, window, back)


def split(text: str | None) -> list[bytes]:
    """The words of a text as they stand, between ASCII white space."""
    return (text or "").encode().split()


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """``doc_id, n_words, whole_sha256, anchors``: the distinct anchors of each text."""

    def batch(rows):
        out = {"n_words": [], "whole_sha256": [], "anchors": []}
        for text in rows["text"]:
            words = split(text)
            out["n_words"].append(len(words))
            out["whole_sha256"].append(_digest(words))
            out["anchors"].append(signed(np.unique(windows(words, window)[1])))
        return {"doc_id": rows["doc_id"], **out}

    return map_batches(
        docs.select("doc_id", "text"),
        batch,
        "doc_id long, n_words long, whole_sha256 string, anchors array<long>",
    )


def _in_several(listed: DataFrame, *key: str) -> DataFrame:
    """``key, first``: values that stand in more than one document, and the least id."""
    return (
        listed.where("doc_id is not null")
        .groupBy(*key)
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select(*key, "first")
    )


def repeated(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``(facts, repeats)``: a row for each document, and ``doc_id, hashes`` of windows to remove."""
    facts = staged(_anchors(docs, window), "anchors")
    anchors = facts.select("doc_id", F.explode("anchors").alias("anchor"))
    met = anchors.join(_in_several(anchors, "anchor"), "anchor")
    by_doc = met.groupBy("doc_id").agg(F.collect_set("anchor").alias("met"))

    def batch(rows):
        out = {"doc_id": rows["doc_id"], "hashes": [], "checks": []}
        for text, met_here in zip(rows["text"], rows["met"], strict=True):
            words = split(text)
            hashes, own = windows(words, window)
            held = np.isin(signed(own), met_here)
            found, first = np.unique(signed(hashes)[held], return_index=True)
            out["hashes"].append(found)
            out["checks"].append(signed(checks(words, window))[held][first])
        return out

    asked = map_batches(
        docs.select("doc_id", "text").join(by_doc, "doc_id"), batch, "doc_id long, hashes array<long>, checks array<long>"
    )
    asked = staged(asked, "windows")
    listed = asked.select("doc_id", F.inline(F.arrays_zip(F.col("hashes").alias("hash"), F.col("checks").alias("check"))))
    later = listed.join(_in_several(listed, "hash", "check"), ["hash", "check"]).where("doc_id > first")
    repeats = later.groupBy("doc_id").agg(F.collect_set("hash").alias("hashes"))
    return facts, staged(repeats, "repeats")


def intervals(words: list[bytes], removed: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal ``(first word, word after the last)`` intervals that the windows cover."""
    starts = np.flatnonzero(np.isin(signed(windows(words, window)[0]), removed))
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > window)
    first = starts[np.concatenate([[0], breaks + 1])]
    last = starts[np.concatenate([breaks, [len(starts) - 1]])] + window
    return list(zip(first.tolist(), last.tolist(), strict=True))


def _kept(words: list[bytes], removed: np.ndarray, window: int) -> list[bytes]:
    kept, at = [], 0
    for first, last in intervals(words, removed, window):
        kept += words[at:first]
        at = last
    return kept + words[at:]


def summary(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every document."""
    facts, repeats = repeated(docs, window)
    cut = docs.select("doc_id", "text").join(repeats, "doc_id")

    def batch(rows):
        out = {"n_words": [], "n_removed": [], "kept_sha256": []}
        for text, hashes in zip(rows["text"], rows["hashes"], strict=True):
            words = split(text)
            kept = _kept(words, np.array(hashes, np.int64), window)
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(kept))
            out["kept_sha256"].append(_digest(kept))
        return {"doc_id": rows["doc_id"], **out}

    changed = map_batches(cut, batch, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    same = facts.join(repeats.select("doc_id"), "doc_id", "left_anti").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("whole_sha256").alias("kept_sha256")
    )
    return changed.unionByName(same)


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``; where words go, ``text`` is the kept ones joined by a space."""
    _, repeats = repeated(docs, window)
    cut_id, cut = fresh(docs, "cut_id"), fresh(docs, "cut_hashes")
    own = repeats.withColumnsRenamed({"doc_id": cut_id, "hashes": cut})
    found = docs.join(own, docs["doc_id"] == own[cut_id], "left")

    @F.pandas_udf("string")
    def without(texts, hashes):
        import pandas as pd

        return pd.Series(
            t if h is None else b" ".join(_kept(split(t), np.array(h), window)).decode()
            for t, h in zip(texts, hashes, strict=True)
        )

    return found.withColumn("text", without("text", cut)).select(docs.columns)


ORACLE_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
v as (select doc_id, k, list_slice(w, k + 1, k + 50) as g
      from (select doc_id, w, unnest(range(0, len(w) - 49)) as k from d where len(w) >= 50)),
f as (select g, min(doc_id) as first from v group by g),
c as (select distinct doc_id, p from (
        select v.doc_id, unnest(range(k, k + 50)) as p
        from v join f on v.g = f.g where v.doc_id > f.first)),
t as (select doc_id, unnest(w) as word, unnest(range(0, len(w))) as p from d),
k as (select t.doc_id, string_agg(word, ' ' order by t.p) as kept, count(*) as n
      from t left join c on c.doc_id = t.doc_id and c.p = t.p where c.p is null group by t.doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, len(w) - coalesce(n, 0) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from d left join k using (doc_id)
"""
