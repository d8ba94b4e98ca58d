"""Exact Jaccard join of word n-gram sets by partitioning the universe.

Sets are put in bands by size; a set of a band only has partners in its own band and
the neighbouring ones. For each band a hash cuts the universe of n-grams into segments.
Two sets whose similarity reaches the threshold differ in at most H elements. A set asks
for a segment with one unit (an equal subset matches) or with two (a subset with one
element more or less matches too); by the pigeonhole principle units that add up to
H + 1 miss no partner.

How the units are spent is decided by cost, with lists that have been counted:

* Every set indexes the subsets of H + 1 segments and some spare ones (exact entries), those
  with the most elements. The entries that stand in one set only can match nothing; of the
  others a set passes over the longest lists, as many as there are spare segments. Both
  orders depend on what is equal in two partners, so one entry that they share is left
  (``indexed``). Most sets have nothing left after that.
* The sets that still have entries in long lists index all their segments a second time. The
  one-deletion neighbourhood of a subset is written once, however many of these hold it.
  Where short lists of subsets and of neighbourhoods give a set its H + 1 units, and reading
  them costs less than the long lists do, it asks these (``allocate``) and leaves the long
  lists; else it stays in them.

Short lists are compared pair by pair, a bounded number for each set. The sets of a long
list are compared with a hub, the one with most long lists; links make components; what
still lies in several components is compared with further hubs, and at last across
components, so that no link between components is lost. A group of a million near copies
thus costs a few million comparisons. A parity sketch of the set, whose difference never
exceeds that of the sets, drops most pairs before the exact comparison of the sets.

Defined results: null texts and texts without words have an empty set and are linked with
nothing; with fewer words than an n-gram has, the whole sequence is the one element; equal
sets are linked; rows with a repeated id keep a row each and share the links of either; a
row with a null id is linked but lends no id, and its own id stands where no linked row has
one; empty tables give empty tables; extra columns are ignored. N-grams and sets are known
by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firngrid.llm.texts import arrow_schema, fresh, keep_batches_small, map_batches, mixed, signed, word_hashes
from firngrid.operators.components import connected_components
from firngrid.sources.shared import staged

#: Rows of a few numbers that may be broadcast at most.
BROADCAST_ROWS = 200_000
#: Bands are this many times the widest ratio of sizes that can be linked, as a power.
BAND_POWER = 4
#: Lists with more sets than this are long: compared with hubs, and left where that is cheaper.
LONG = 32
#: Lists up to this length are compared pair by pair at once, longer ones with a hub first.
PAIRED = 8
#: Turns of hubs before what is left is compared by its rarest elements.
HUB_TURNS = 3
#: Pairs of one hub that a task compares at most.
HUB_BLOCK = 2048
#: Subsets whose neighbourhoods a task writes.
TASK_SUBSETS = 8_192
#: Elements that are more than one in so many occurrences are common; there are fewer of them than this.
COMMON = 65_536
_SKETCH = 512
_WORDS = _SKETCH // 64
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOOSE = np.uint64(0x5851F42D4C957F2D)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    n = min(size, len(h))
    whole = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        whole = mixed(whole * _STEP + h[k : len(h) - n + k + 1])
    return np.unique(whole)


def sketch(elements: np.ndarray) -> np.ndarray:
    """Parity bits as longs; the bits that two sketches differ in bound the sets' difference."""
    counts = np.bincount((mixed(elements + _STEP) % np.uint64(_SKETCH)).astype(np.int64), minlength=_SKETCH)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _digest(elements: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(elements.tobytes()), np.int64).tolist())


@dataclass(frozen=True)
class Bands:
    """Size bands and their segments."""

    percent: int
    tops: tuple[int, ...]

    @staticmethod
    def up_to(largest: int, percent: int) -> Bands:
        tops, low = [], 1
        while low <= max(1, largest):
            tops.append(max(low, int(low * (100 / percent) ** BAND_POWER)))
            low = tops[-1] + 1
        return Bands(percent, tuple(tops))

    def of(self, n: int) -> int:
        """The band of a set of n elements."""
        return int(np.searchsorted(self.tops, n))

    def differing(self, n: int, partner: int) -> int:
        """Most elements in which linked sets of these sizes differ."""
        return (100 - self.percent) * (n + partner) // (100 + self.percent)

    def segments(self, band: int) -> int:
        """Segments of a band: one more than any linked pair differs in, and the spare ones."""
        top = self.tops[band]
        return self.differing(top, top * 100 // self.percent) + 1 + self.spare(band)

    def spare(self, band: int) -> int:
        """Lists that a set of the band's scheme may pass over."""
        top = self.tops[band]
        return max(1, self.differing(top, top * 100 // self.percent) // 5)

    def schemes(self, n: int) -> Iterator[tuple[int, int]]:
        """``(scheme, most differing elements)`` under which a set of n elements is indexed.

        It meets larger partners, and those of its own band, in the scheme of its band;
        and smaller ones of the band below in the scheme of that band. Where no element
        may differ, only equal sets are linked, which are one class already.
        """
        band = self.of(n)
        if most := self.differing(n, n * 100 // self.percent):
            yield band, most
        if band and -(-n * self.percent // 100) <= self.tops[band - 1]:
            if most := self.differing(n, self.tops[band - 1]):
                yield band - 1, most


def bands_of(percent: int) -> Bands:
    """Bands up to sets of two thousand million elements, the most that a text can have."""
    return Bands.up_to(2**31, percent)


def _keyed(hashes: np.ndarray, scheme: int) -> np.ndarray:
    """Hashes whose last bit tells the two schemes of a set apart."""
    return (hashes << np.uint64(1)) | np.uint64(scheme & 1)


def _cut(elements: np.ndarray, scheme: int, m: int):
    """``(spread, segment, sums, key)``: elements, their segments, and a hash and salt of each segment."""
    spread = mixed(elements ^ _STEP)
    segment = ((spread >> np.uint64(20)) % np.uint64(m)).astype(np.int64)
    order = np.argsort(segment, kind="stable")
    counts = np.bincount(segment, minlength=m)
    held = np.flatnonzero(counts)
    sums = np.zeros(m, np.uint64)
    starts = np.concatenate([[0], np.cumsum(counts[held])[:-1]]).astype(np.int64)
    sums[held] = np.add.reduceat(spread[order], starts)
    key = mixed(np.arange(m, dtype=np.uint64) + np.uint64(scheme << 32) + _STEP)
    return spread, segment, sums, key


def indexed(elements: np.ndarray, scheme: int, bands: Bands, most: int) -> np.ndarray:
    """The entries of the subsets that a set indexes: of ``most + 1 + spare`` segments, the fullest.

    Partners have all but ``most`` segments alike. The order is the same for these, so each
    leaves out the same ones, from the end, and ``spare + 1`` of them stay in both.
    """
    m = bands.segments(scheme)
    _, segment, sums, key = _cut(elements, scheme, m)
    full = np.argsort(-np.bincount(segment, minlength=m), kind="stable")[: most + 1 + bands.spare(scheme)]
    return _keyed(mixed(sums[full] ^ key[full]), scheme)


def subset_entries(elements: np.ndarray, scheme: int, m: int) -> np.ndarray:
    """The entry of each segment's subset."""
    _, _, sums, key = _cut(elements, scheme, m)
    return _keyed(mixed(sums ^ key ^ _LOOSE), scheme)


def loose_entries(elements: np.ndarray, scheme: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """``(segments, entries)``: each segment's subset, and its subsets with one element less."""
    spread, segment, sums, key = _cut(elements, scheme, m)
    less = _keyed(mixed((sums[segment] - spread) ^ key[segment] ^ _LOOSE), scheme)
    return np.concatenate([np.arange(m), segment]), np.concatenate([subset_entries(elements, scheme, m), less])


def entries(elements: np.ndarray, bands: Bands) -> np.ndarray:
    """The exact entries of a set under all its schemes."""
    out = [indexed(elements, scheme, bands, most) for scheme, most in bands.schemes(len(elements))]
    return np.concatenate([np.zeros(0, np.uint64), *out])


def allocate(
    units: int, m: int, own: dict[int, int], near: dict[int, int], stay: int
) -> tuple[list[int], list[int]] | None:
    """``(segments asked with one unit, with two)``, or None where the long lists are cheaper.

    ``units`` is what must be spent on ``m`` segments. ``own`` has the lengths of the lists
    of the segments' subsets, ``near`` those of all lists of their neighbourhoods together,
    where other sets stand in them, and ``stay`` is the length of the lists of the set as it
    is. Subsets in short lists come first, then their neighbourhoods, the shortest lists first.
    """
    short = sorted((own.get(k, 0), k) for k in range(m) if own.get(k, 0) <= LONG)[:units]
    missing = units - len(short)
    extra = sorted((near.get(k, 0), k) for _, k in short)[:missing]
    cost = sum(n for n, _ in short) + sum(n for n, _ in extra)
    if len(extra) < missing or (extra and extra[-1][0] > LONG) or cost >= stay:
        return None
    twice = {k for _, k in extra}
    return sorted(k for _, k in short if k not in twice), sorted(twice)


def _class_width(n: int) -> int:
    """Width of the size class of n: sizes up to 127 stand alone, larger ones within 1.6 %."""
    return 1 << max(0, n.bit_length() - 7)


def rare_entries(n: int, common: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(entries, roles, at)`` of a set of n elements, for each size class of partners.

    ``common`` are the elements that other sets hold too, the rarest first in an order that
    all sets share; elements that no other set holds stand before them. Linked sets of sizes
    n and k have at least ``percent * (n + k) / (100 + percent)`` elements alike, so the
    rarest that both hold is among the first ``n + 1`` less that many of either. The role
    is 2 where both are of one class, else 1 for the larger class and 0 for the smaller.
    """
    alone = n - len(common)
    own = n // _class_width(n) * _class_width(n)
    least = -(-n * percent // 100)
    other = least // _class_width(least) * _class_width(least)
    out = [], [], []
    while other * percent <= 100 * n:
        needed = -(-percent * (n + max(least, other)) // (100 + percent))
        first = common[: max(0, n - needed + 1 - alone)]
        low, high = mixed(np.array([min(own, other), max(own, other)], np.uint64) + _STEP)
        out[0].append(mixed(mixed(first ^ low) ^ high))
        out[1].append(np.full(len(first), 2 if own == other else int(own > other)))
        out[2].append(alone + 1 + np.arange(len(first)))
        other += _class_width(other)
    return tuple(np.concatenate(v) for v in out)


def _facts(docs: DataFrame, size: int, bands: Bands) -> DataFrame:
    """A row of each text: size and 128-bit digest of its set, and of a set once in each task its entries."""
    keep_batches_small(docs.sparkSession)
    schema = "doc_id long, t long, n long, c1 long, c2 long, entries array<long>"
    arrow = arrow_schema(schema)

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            out = {k: [] for k in ("n", "c1", "c2", "entries")}
            for text in b.column("text").to_pylist():
                elements = shingles(text, size)
                c1, c2 = _digest(elements)
                found = None
                if len(elements) and c1 not in seen:
                    seen.add(c1)
                    found = signed(entries(elements, bands))
                for k, v in zip(out, (len(elements), c1, c2, found), strict=True):
                    out[k].append(v)
            columns = [b.column("doc_id"), b.column("t")] + [
                pa.array(v, arrow.field(k).type) for k, v in out.items()
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), "text")
    return rows.mapInArrow(run, schema)


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def _may_link(percent: int) -> Column:
    """Sizes and sketches of ``x`` and ``y`` allow a link."""
    x, y = F.col("x.n"), F.col("y.n")
    differ = sum(F.bit_count(F.col(f"x.s{k}").bitwiseXOR(F.col(f"y.s{k}"))) for k in range(_WORDS))
    return (
        (100 * F.least(x, y) >= percent * F.greatest(x, y))
        & ((100 + percent) * differ <= (100 - percent) * (x + y))
    )


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``c1, n, s0.., elements`` of the classes ``wanted (c1, c2, t, rep)``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), "text")
    w = _small(wanted.select("c1", "t", "rep"), wanted.count())
    texts = rows.join(w, (rows["t"] == w["t"]) & rows["doc_id"].eqNullSafe(w["rep"]))
    names = [f"s{k}" for k in range(_WORDS)]

    def batch(rows):
        out = {k: [] for k in ("c1", "n", *names, "elements")}
        for c1, text in zip(rows["c1"], rows["text"], strict=True):
            elements = shingles(text, size)
            for k, v in zip(out, (c1, len(elements), *sketch(elements).tolist(), elements.tobytes()), strict=True):
                out[k].append(v)
        return out

    schema = "c1 long, n long, " + "".join(f"{s} long, " for s in names) + "elements binary"
    return map_batches(texts.select("c1", "text"), batch, schema).dropDuplicates(["c1"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs (a, b)`` whose sets reach the threshold; ``b`` may stand in very many."""
    n_pairs = F.count("*").alias("n_pairs")
    blocks = pairs.groupBy("b").agg(n_pairs).select("b", F.ceil(F.col("n_pairs") / HUB_BLOCK).cast("int").alias("blocks"))
    left = sets.select(F.col("c1").alias("a"), F.col("elements").alias("x"))
    right = (
        blocks.join(sets.select(F.col("c1").alias("b"), F.col("elements").alias("y")), "b")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .drop("blocks")
    )
    keyed = pairs.join(blocks, "b").select("a", "b", F.pmod(F.hash("a"), F.col("blocks")).alias("block"))

    def compare(rows):
        out = {"a": [], "b": []}
        for a, b, x, y in zip(rows["a"], rows["b"], rows["x"], rows["y"], strict=True):
            u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            met = len(np.intersect1d(u, v, assume_unique=True))
            if 100 * met >= percent * (len(u) + len(v) - met):
                out["a"].append(a)
                out["b"].append(b)
        return out

    both = keyed.join(left, "a").join(right, ["b", "block"]).select("a", "b", "x", "y")
    return map_batches(both, compare, "a long, b long")


def _counted(rows: dict[str, list]) -> dict[str, np.ndarray]:
    """``subset, weight, c1``: how many sets of a batch hold a subset, and the least of them."""
    subsets = np.concatenate(rows["subsets"]).astype(np.int64)
    c1 = np.repeat(np.array(rows["c1"], np.int64), [len(x) for x in rows["subsets"]])
    order = np.lexsort((c1, subsets))
    found, first, weight = np.unique(subsets[order], return_index=True, return_counts=True)
    return {"subset": found, "weight": weight, "c1": c1[order][first]}


def _left_lists(hot: DataFrame, sets: DataFrame, bands: Bands) -> tuple[DataFrame, DataFrame]:
    """``(met, left)`` of the sets ``hot (c1, parity, stay)`` that stand in long lists.

    ``left (c1, parity)`` are those that leave the long lists, and ``met (entry, c1)`` the
    lists of subsets and neighbourhoods that they ask, with all of ``hot`` that are in them.
    Sets of a long list have most subsets alike, so a subset is known by its entry, and its
    neighbourhood is indexed once, with the number of sets that hold it, and not by each set.
    Sets of a batch count their subsets together, and a set has a row only for subsets in short
    lists, since no others are asked for.
    """

    def cut(rows):
        out = {k: [] for k in ("c1", "parity", "units", "m", "stay", "subsets")}
        for c1, parity, stay, data in zip(*(rows[k] for k in ("c1", "parity", "stay", "elements")), strict=True):
            elements = np.frombuffer(data, np.uint64)
            for scheme, most in bands.schemes(len(elements)):
                if scheme & 1 == parity:
                    m = bands.segments(scheme)
                    subsets = signed(subset_entries(elements, scheme, m))
                    for k, v in zip(out, (c1, parity, most + 1, m, stay, subsets), strict=True):
                        out[k].append(v)
        return out

    elements = sets.select("c1", "elements")
    schema = "c1 long, parity long, units long, m long, stay long, subsets array<long>"
    held = staged(map_batches(hot.join(elements, "c1"), cut, schema), "subsets")
    counted = map_batches(held.select("c1", "subsets"), _counted, "subset long, weight long, c1 long")
    # the last bit of an entry is the parity of its scheme
    parity = F.col("subset").bitwiseAND(F.lit(1)).cast("long").alias("parity")
    wanted = staged(counted.groupBy("subset").agg(F.sum("weight").alias("weight"), F.min("c1").alias("c1")).select("*", parity), "wanted")
    heavy = wanted.where(F.col("weight") > LONG).select("subset")
    known = np.zeros(0, np.int64)
    if heavy.count() <= BROADCAST_ROWS:
        known = np.sort(np.array([row.subset for row in heavy.collect()], np.int64))

    def lighter(rows):
        subsets = np.concatenate(rows["subsets"]).astype(np.int64)
        lengths = [len(x) for x in rows["subsets"]]
        light = np.flatnonzero(~np.isin(subsets, known))
        at = np.repeat(np.arange(len(lengths)), lengths)[light]
        segments = np.concatenate([np.arange(n) for n in lengths])[light]
        c1, parities = (np.array(rows[k], np.int64)[at] for k in ("c1", "parity"))
        return {"c1": c1, "parity": parities, "segment": segments, "subset": subsets[light]}

    each = staged(map_batches(held.select("c1", "parity", "subsets"), lighter, "c1 long, parity long, segment long, subset long"), "light")
    spelt = wanted.groupBy("c1", "parity").agg(F.collect_list("subset").alias("subset"), F.collect_list("weight").alias("weight"))

    def spell(rows):
        out = {"subset": [], "weight": [], "entries": []}
        for parity, data, subset, weight in zip(*(rows[k] for k in ("parity", "elements", "subset", "weight")), strict=True):
            elements = np.frombuffer(data, np.uint64)
            weights = dict(zip(subset, weight, strict=True))
            for scheme in (k for k, _ in bands.schemes(len(elements)) if k & 1 == parity):
                m = bands.segments(scheme)
                segments, found = loose_entries(elements, scheme, m)
                order = np.argsort(segments, kind="stable")  # the subset itself is the first of its segment
                for part in np.split(signed(found)[order], np.cumsum(np.bincount(segments, minlength=m))[:-1]):
                    if int(part[0]) in weights:
                        for k, v in zip(out, (int(part[0]), weights[int(part[0])], part), strict=True):
                            out[k].append(v)
        return out

    near = staged(map_batches(spelt.join(elements, "c1"), spell, "subset long, weight long, entries array<long>"), "neighbourhoods")
    # small files are read together, so without this few tasks would have the rows of all neighbourhoods
    spread = near.repartition(near.count() // TASK_SUBSETS + 1)
    lists = staged(spread.select("subset", "weight", F.explode("entries").alias("entry")), "near-lists")
    lengths = lists.groupBy("entry").agg(F.sum("weight").alias("length")).where("length > 1")
    own = F.sum(F.when(F.col("entry") == F.col("subset"), F.col("length")))
    # most entries of a group of near copies stand alone and cost nothing, so these are not joined
    several = lists.join(lengths, "entry").groupBy("subset").agg(F.sum("length").alias("near"), own.alias("own"))
    costs = (
        near.select("subset")
        .join(several, "subset", "left")
        .select("subset", *[F.coalesce(k, F.lit(0)).alias(k) for k in ("near", "own")])
        .where(F.col("own") <= LONG)
    )
    # subsets in long lists are not asked for and not joined, so no subset of very many sets is
    short = (
        each.join(costs, "subset")
        .groupBy("c1", "parity")
        .agg(F.collect_list(F.struct("segment", "near", "own")).alias("short"))
    )

    def choose(rows):
        out = {k: [] for k in ("c1", "parity", "once", "twice")}
        for c1, parity, units, m, stay, subsets, short in zip(
            *(rows[k] for k in ("c1", "parity", "units", "m", "stay", "subsets", "short")), strict=True
        ):
            own = dict.fromkeys(range(m), LONG + 1) | {e["segment"]: e["own"] for e in short}
            found = allocate(units, m, own, {e["segment"]: e["near"] for e in short}, stay)
            if found is not None:
                for k, v in zip(out, (c1, parity, *([subsets[s] for s in part] for part in found)), strict=True):
                    out[k].append(v)
        return out

    schema = "c1 long, parity long, once array<long>, twice array<long>"
    chosen = staged(map_batches(held.join(short, ["c1", "parity"]), choose, schema), "chosen")
    twice = chosen.select(F.explode("twice").alias("subset")).distinct().join(near, "subset").select(F.explode("entries"))
    asked = chosen.select(F.explode("once").alias("entry")).union(twice).distinct()
    met = lists.join(asked, "entry", "left_semi").select("entry", "subset").join(each.select("subset", "c1"), "subset")
    return met.select("entry", "c1").distinct(), chosen.select("c1", "parity")


def _joined(state: DataFrame | None, links: DataFrame) -> DataFrame:
    """``c1, component`` after further ``links (a, b)``; classes without links have no row."""
    if state is None:
        return staged(connected_components(links).toDF("c1", "component"), "components")
    named = links
    for side in ("a", "b"):
        own = state.select(F.col("c1").alias(side), F.col("component").alias("_to"))
        named = named.join(own, side, "left").withColumn(side, F.coalesce("_to", side)).drop("_to")
    moved = connected_components(staged(named, "links")).toDF("component", "_to")
    old = state.join(moved, "component", "left").select("c1", F.coalesce("_to", "component").alias("component"))
    new = moved.join(state.select("component").distinct(), "component", "left_anti").toDF("c1", "component")
    return staged(old.unionByName(new), "components")


def _rare_lists(c1: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``c1, entry, role, at``: where the sets ``c1`` may meet partners in their rarest elements."""

    def spread(rows):
        out = {"c1": [], "element": []}
        for name, data in zip(rows["c1"], rows["elements"], strict=True):
            held = np.frombuffer(data, np.int64).tolist()
            out["c1"] += [name] * len(held)
            out["element"] += held
        return out

    each = staged(map_batches(c1.join(sets.select("c1", "elements"), "c1"), spread, "c1 long, element long"), "elements")
    counts = staged(each.groupBy("element").agg(F.count("*").alias("held")).where("held > 1"), "held")
    # common elements are fewer than COMMON, whatever the input; of the others none is a hot key
    cut = each.count() // COMMON
    named = each.join(F.broadcast(counts.where(F.col("held") > cut)), "element").unionByName(
        each.join(counts.where(F.col("held") <= cut), "element")
    )
    ordered = named.groupBy("c1").agg(F.sort_array(F.collect_list(F.struct("held", "element")))["element"].alias("common"))

    def batch(rows):
        out = {k: [] for k in ("c1", "entry", "role", "at")}
        for name, n, common in zip(rows["c1"], rows["n"], rows["common"], strict=True):
            found, roles, at = rare_entries(n, np.array(common, np.int64).view(np.uint64), percent)
            for k, v in zip(out, ([name] * len(found), signed(found).tolist(), roles.tolist(), at.tolist()), strict=True):
                out[k] += v
        return out

    return map_batches(ordered.join(sets.select("c1", "n"), "c1"), batch, "c1 long, entry long, role long, at long")


def _rare_pairs(open_sets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of ``open_sets (c1, component, n, s0..)`` that may link across components."""
    listed = _rare_lists(open_sets.select("c1"), sets, percent).join(open_sets, "c1")
    several = listed.groupBy("entry").agg(
        *[f("component").alias(k) for f, k in ((F.min, "low"), (F.max, "high"))],
        *[f("role").alias(k) for f, k in ((F.min, "one"), (F.max, "two"))],
    )
    several = several.where("low < high and (one = 2 or one < two)")
    rows = staged(listed.join(several.select("entry"), "entry"), "rare")
    after = 1 + F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    fits = (100 + percent) * after >= percent * (F.col("x.n") + F.col("y.n"))
    apart = (F.col("x.entry") == F.col("y.entry")) & (F.col("x.component") != F.col("y.component"))
    out = None
    for one, two, order in ((2, 2, F.col("x.c1") < F.col("y.c1")), (0, 1, F.lit(True))):
        x, y = rows.where(F.col("role") == one).alias("x"), rows.where(F.col("role") == two).alias("y")
        near = x.join(y, apart & order & fits & _may_link(percent)).select(
            F.least("x.c1", "y.c1").alias("a"), F.greatest("x.c1", "y.c1").alias("b")
        )
        out = near if out is None else out.unionByName(near)
    return out


def _linked(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """``c1, component`` from all links between sets that share one of ``lists (entry, c1)``."""
    light = sets.drop("elements")
    popular = lists.groupBy("c1").agg(F.count("*").alias("popular"))
    rows = staged(lists.join(popular, "c1").join(light, "c1"), "lists")
    state, met = None, None
    for turn in range(HUB_TURNS + 1):
        component = F.col("c1")
        placed = rows.withColumn("component", component)
        if state is not None:
            placed = rows.join(state, "c1", "left").withColumn("component", F.coalesce("component", "c1"))
        spread = placed.groupBy("entry").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("length")
        )
        spread = spread.where("low < high").select("entry", "length")
        rows_open = staged(placed.join(spread, "entry"), "open")
        own = ["c1", "component", "n", *[f"s{k}" for k in range(_WORDS)]]
        if turn == HUB_TURNS:
            longer = rows_open.where("false")
            near = _rare_pairs(staged(rows_open.select(own).distinct(), "left"), sets, percent)
        else:
            paired = F.col("length") <= (LONG if turn else PAIRED)
            longer = rows_open.where(~paired)
            x, y = rows_open.where(paired).alias("x"), rows_open.where(paired).alias("y")
            apart = (F.col("x.component") != F.col("y.component")) & _may_link(percent)
            near = x.join(y, (F.col("x.entry") == F.col("y.entry")) & (F.col("x.c1") < F.col("y.c1")) & apart).select(
                F.col("x.c1").alias("a"), F.col("y.c1").alias("b")
            )
            # the hub is of the largest component at first, then of any; of its most popular sets
            order = F.struct(F.xxhash64("component", F.lit(turn)), "popular", "c1") if turn else F.struct("popular", "c1")
            hubs = longer.groupBy("entry").agg(F.max_by(F.struct(own), order).alias("y"))
            hubs = hubs.select("entry", "y.*")
            spokes = longer.alias("x").join(hubs.alias("y"), (F.col("x.entry") == F.col("y.entry")) & apart)
            near = near.union(spokes.select(F.col("x.c1").alias("a"), F.col("y.c1").alias("b")))
        near = near.distinct()
        if met is not None:
            near = near.join(met, ["a", "b"], "left_anti")
        near = staged(near, "pairs")
        if not near.isEmpty():
            links = staged(_verified(near, sets, percent), "links")
            if not links.isEmpty():
                state = _joined(state, links)
            met = near if met is None else met.unionByName(near)
        rows = longer.select(rows.columns)
        if rows.isEmpty():
            break
    return state


def components(docs: DataFrame, percent: int = 85, size: int = 4) -> DataFrame:
    """``doc_id, n_shingles, component_id``: the least id that links lead to, for every row."""
    bands = bands_of(percent)
    facts = staged(_facts(docs, size, bands), "facts")
    classes = staged(
        facts.where("n > 0")
        .groupBy("c1", "c2")
        .agg(
            F.min("doc_id").alias("rep"),
            F.min_by("t", F.struct(F.col("doc_id").isNull(), "doc_id")).alias("t"),
            F.first("n").alias("n"),
        ),
        "classes",
    )
    listed = facts.select("c1", F.explode("entries").alias("entry"))
    several = listed.groupBy("entry").agg(F.min("c1").alias("low"), F.max("c1").alias("high")).where("low < high")
    shared = staged(listed.join(several.select("entry"), "entry").distinct(), "shared")
    lengths = shared.groupBy("entry").agg(F.count("*").alias("length"))
    # What a set has in lists of several sets, the longest first; the first ones are passed over.
    band = F.size(F.filter(F.array(*[F.lit(t) for t in bands.tops]), lambda t: t < F.col("n")))
    scheme = band - (band.bitwiseAND(F.lit(1)) != F.col("parity")).cast("int")
    spare = F.array(*[F.lit(bands.spare(k)) for k in range(len(bands.tops))])
    offers = (
        shared.join(lengths, "entry")
        .groupBy("c1", F.col("entry").bitwiseAND(F.lit(1)).alias("parity"))
        .agg(F.sort_array(F.collect_list(F.struct("length", "entry")), asc=False).alias("found"))
        .join(classes.select("c1", "n"), "c1")
        .withColumn("spare", F.get(spare, scheme))
        .where(F.size("found") > F.col("spare"))
        .withColumn("kept", F.slice("found", F.col("spare") + 1, F.size("found")))
        .withColumn("hot", F.col("kept")[0]["length"] > LONG)
        .withColumn("stay", F.aggregate("kept", F.lit(0).cast("long"), lambda total, e: total + e["length"]))
    )
    offers = staged(offers, "offers")
    wanted = staged(classes.join(offers.select("c1").distinct(), "c1"), "wanted")
    sets = staged(_sets(docs, wanted, size), "sets")

    kept = offers.select("c1", "parity", F.inline("kept"))
    found = offers.select("c1", F.inline("found"))
    met, left = _left_lists(offers.where("hot").select("c1", "parity", "stay"), sets, bands)
    stay = kept.join(left, ["c1", "parity"], "left_anti")
    asked = stay.where(F.col("length") <= LONG).select("entry").distinct()
    short = found.where(F.col("length") <= LONG).select("entry", "c1").join(asked, "entry", "left_semi")
    long = stay.where(F.col("length") > LONG).select("entry", "c1")
    joined = _linked(short.union(long).union(met), sets, percent)

    named = facts.select("doc_id", "n", "c1", "c2").join(classes.select("c1", "c2", "rep"), ["c1", "c2"], "left")
    if joined is None:
        component = named.withColumn("least", F.lit(None).cast("long"))
    else:
        least = joined.join(classes.select("c1", "rep"), "c1").groupBy("component").agg(F.min("rep").alias("least"))
        component = named.join(joined.join(least, "component").select("c1", "least"), "c1", "left")
    return component.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("least", "rep", "doc_id")).alias("component_id"),
    )


def first_of_each(docs: DataFrame, percent: int = 85, size: int = 4) -> DataFrame:
    """The rows of ``docs`` whose id is the least of their component."""
    grouped = components(docs, percent, size)
    dropped = staged(
        grouped.where("doc_id <> component_id").select("doc_id").distinct(), "dropped"
    )
    return docs.join(_small(dropped, dropped.count()), "doc_id", "left_anti").select(docs.columns)


def one_of_each(docs: DataFrame, percent: int = 85, size: int = 4) -> DataFrame:
    """Exactly one row of ``docs`` of each component: a row of the least id, nulls last.

    Rows are linked by their own texts and known by a hash of id and text, so ids may repeat
    or be null. Texts without words have no near copies, and all their rows stay.
    """
    own = fresh(docs, "row_key")
    key = F.xxhash64("doc_id", F.col("doc_id").isNull(), "text")
    rows = docs.groupBy(key.alias("row_key"), "doc_id").agg(F.count("*").alias("times"))
    grouped = components(docs.select(key.alias("doc_id"), "text"), percent, size)
    placed = grouped.where("n_shingles > 0").select(F.col("doc_id").alias("row_key"), "component_id")
    members = staged(placed.distinct().join(rows, "row_key"), "members")
    first = F.min_by("row_key", F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))
    kept = staged(members.groupBy("component_id").agg(first.alias("row_key")).select("row_key"), "kept")
    dropped = staged(members.select("row_key").join(kept, "row_key", "left_anti"), "dropped")
    repeated = staged(members.where("times > 1").select("row_key").join(kept, "row_key"), "repeated")
    counts = dropped.count(), repeated.count()
    dropped, repeated = (_small(x, n).toDF(own) for x, n in zip((dropped, repeated), counts, strict=True))
    out = docs.withColumn(own, key).join(dropped, own, "left_anti")
    if counts[1]:
        once = out.join(repeated, own, "left_semi").dropDuplicates([own])
        out = out.join(repeated, own, "left_anti").unionByName(once)
    return out.select(docs.columns)


ORACLE_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct doc_id, list_slice(w, k + 1, k + 4) as g
  from (select doc_id, w, unnest(range(0, greatest(1, len(w) - 3))) as k from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as met
      from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b
      where 100 * met >= 85 * (x.n + y.n - met)),
r(node, reached) as (
  select doc_id, doc_id from documents
  union
  select r.node, e.b from r join e on e.a = r.reached)
select w.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id
from w left join n using (doc_id)
join (select node, min(reached) as component_id from r group by node) c on c.node = w.doc_id
"""
