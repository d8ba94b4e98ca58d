"""Filter audit, sharding and centroid clustering against loops, and their edge cases."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from firngrid.llm import centroids, filter_audit, queries, sharding
from firngrid.sources.shared import shared_dir
from firngrid.sources.tables import read_table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("part", "good", "toxic", "word", "digest", "first", "A", "E", "grp", "rng", "size", "shard", "slot", "rank", "cluster", "distance", "coefficients", "v")


def documents(spark, rows):
    """Rows ``(doc_id, text, source)`` with the other columns of documents and clashing ones."""
    full = [(i, t, "en", s, None) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS).withColumns({c: F.lit(k) for k, c in enumerate(CLASH)})


@pytest.fixture(scope="module")
def rows():
    """Texts of all kinds with a group of copies of a third, nulls, empties and repeated rows."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6))) for _ in range(200)]
    make = lambda n, k=200: " ".join(rng.choice(words[:k]) for _ in range(n))
    copy = make(60) + " #"
    found = [(rng.randrange(10_000), copy, rng.choice("xyz")) for _ in range(60)]
    for k in range(120):
        text = make(rng.choice((5, 49, 50, 51, 90)), rng.choice((20, 200)))
        text = text.upper() if k % 7 == 0 else text + "|" if k % 5 == 0 else text
        found.append((rng.randrange(10_000), text, rng.choice(("x", "y", "", None))))
    found += [(None, copy, "x"), (None, None, None), (3, None, "y"), (4, "", "y"), (5, "", "z"), (6, "é" * 3000 + "\U0001f600", "x"), (7, make(30_000), "z")]
    return found + [found[0], found[70], found[70]]


# -- filter audit


def test_words_of_all_masks_hold_the_subsets_that_survive(spark):
    masks = spark.range(32).select("id", filter_audit.survival_word([F.col("id").bitwiseAND(1 << k) > 0 for k in range(5)]).alias("w"))
    for r in masks.collect():
        assert r.w == sum(1 << s for s in range(32) if not s & r.id)


def test_carry_save_counts_equal_sums():
    rng = np.random.default_rng(3)
    for sizes in ((), (1,), (2, 1), (3,), (1, 1, 1, 1), (1000, 1, 77), (65_536,)):
        adder, total = filter_audit.CarrySave(), np.zeros(32, np.int64)
        for n in sizes:
            words = rng.integers(0, 2**32, n, dtype=np.uint32)
            adder.add(words)
            total += (words[:, None] >> np.arange(32, dtype=np.uint32) & 1).sum(0, dtype=np.int64)
        assert adder.counts().tolist() == total.tolist() and all(len(x) < 3 for x in adder.levels)


def _audit(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    found = []
    for i, t, s in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and first[t] < i,
        }
        mine = [(q, x) for d, q, x in labels if d == i and d is not None]
        found.append((s or "", fails, any(q == 1 for q, _ in mine), any(x == 1 for _, x in mine)))
    out = {}
    for part in {f[0] for f in found}:
        docs = [f for f in found if f[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left, gone = docs, []
            for step, name in enumerate(order, 1):
                removed = [d for d in left if d[1][name]]
                left = [d for d in left if not d[1][name]]
                out[part, order, step] = [
                    len(left), len(removed), sum(d[1][name] for d in gone),
                    sum(d[1][name] and sum(d[1].values()) == 1 for d in docs),
                    sum(d[2] for d in removed), sum(d[3] for d in removed),
                ]
                shapley[name] += len(removed)
                gone += removed
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def test_audit_equals_loops(spark, rows, monkeypatch):
    monkeypatch.setattr(filter_audit, "GROUPS", 3)  # tasks give out and begin anew
    ids = sorted({r[0] for r in rows if r[0] is not None})
    labels = [(i, i % 2, int(i % 3 == 0)) for i in ids[::2]] + [(ids[0], 1, None), (ids[1], None, 1), (None, 1, 1), (10**9, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit("x"))
    found = filter_audit.audit(filter_audit.with_words(documents(spark, rows), table), "ABCDE").collect()
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in found} == _audit(rows, labels)
    assert len(found) == 600 * len({r[2] or "" for r in rows})


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.with_words(documents(spark, []), none), "ABCDE").count() == 0
    one = filter_audit.audit(filter_audit.with_words(documents(spark, [(1, None, None)]), none), "ABCDE")
    assert one.count() == 600 and one.where("step = 5").select("kept").distinct().collect() == [(0,)]


# -- sharding


def _check_shards(found, rows, n):
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in found) == sorted((i or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(0 <= k < n and sorted(v) == list(range(len(v))) for k, v in slots.items())
    total, largest = sum(r.size for r in found), max(r.size for r in found)
    sizes = [sum(r.size for r in found if r.shard == k) for k in range(n)]
    unit = max(largest, max(sum(r.size for r in found if (r.doc_id, r.text_crc32) == key) for key in {(r.doc_id, r.text_crc32) for r in found}))
    assert all(abs(s - total / n) <= unit for s in sizes)
    for crc in {r.text_crc32 for r in found}:
        group = [r for r in found if r.text_crc32 == crc]
        if sum(r.size for r in group) <= largest:
            assert len({r.shard for r in group}) == 1


@pytest.mark.parametrize("n", [1, 4, 40, 1000])
def test_shards_are_balanced_gapless_and_keep_small_groups(spark, rows, n):
    found = sharding.placed(sharding.measured(documents(spark, rows)), n).collect()
    _check_shards(found, rows, n)


def test_one_group_of_all_rows_fills_all_shards(spark):
    rows = [(i, "same text", "x") for i in range(1000)]
    found = sharding.placed(sharding.measured(documents(spark, rows)), 8).collect()
    _check_shards(found, rows, 8)
    assert sorted(sum(r.shard == k for r in found) for k in range(8)) == [125] * 8
    by_id = [r.shard for r in sorted(found, key=lambda r: r.doc_id)]
    assert by_id == sorted(by_id)


def test_shards_of_one_large_text_and_of_repeated_rows(spark):
    rows = [(1, "x" * 100_000, "x"), *[(k, "y" * 10, "x") for k in range(2, 30)], *[(40, "z", "x")] * 25, (None, None, None), (None, "", None)]
    _check_shards(sharding.placed(sharding.measured(documents(spark, rows)), 5).collect(), rows, 5)
    assert sharding.placed(sharding.measured(documents(spark, [])), 5).count() == 0


def test_written_shards_hold_the_placed_rows(spark, rows):
    docs = documents(spark, rows)
    path = f"{shared_dir(spark)}/shards"
    sharding.write(docs, 7, path)
    read = spark.read.parquet(path)
    # the table has a column named shard of its own, so the folders are named otherwise
    key = lambda r, s: (r.doc_id or -1, s)
    assert read.columns == [*docs.columns, "_shard"]
    placed = sharding.placed(sharding.measured(docs), 7).collect()
    assert sorted(key(r, r["_shard"]) for r in read.collect()) == sorted(key(r, r.shard) for r in placed)
    sharding.write(documents(spark, []), 7, f"{path}-none")


def test_sharding_query(spark, data):
    docs = [(r.doc_id, r.text, None) for r in read_table(spark, data, "documents").collect()]
    found = queries.op12_sharding(spark, data).collect()
    _check_shards(found, docs, 40)
    assert {r.law for r in found} == {"bytes"} and {r.grown_shard for r in found} == {None}


# -- centroids


def _clusters(rows, k, rounds):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    digest = lambda i: (i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "")
    means = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), (centroids.TRANSFORM @ r[1]).tolist()))[:k]]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [min((distance(v, m), c) for c, m in enumerate(means)) for _, v in kept]
    for _ in range(rounds):
        found = assign()
        for c in range(len(means)):
            mine = [v for (_, v), (_, own) in zip(kept, found, strict=True) if own == c]
            if mine:
                means[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = assign()
    return sorted(
        (i is None, i or 0, c, d, sum(x for x, own in found if own == c), sum(x for x, _ in found), hashlib.sha256(",".join(map(str, means[c])).encode()).hexdigest())
        for (i, _), (d, c) in zip(kept, found, strict=True)
    )


def _vectors(seed, n, spread):
    rng = np.random.default_rng(seed)
    return [(int(i), np.float32(rng.normal(0, spread, 64)).tolist()) for i in rng.permutation(n)]


@pytest.mark.parametrize("k", [1, 3, 40])
def test_clusters_equal_loops(spark, k):
    rows = _vectors(1, 90, 0.3) + _vectors(2, 20, 0.02)  # repeated ids with other vectors
    rows += [(7, [0.0] * 64)] * 30 + [(500, [0.5] * 32 + [-0.5] * 32)] * 2 + [(None, [0.25] * 64), (501, None), (502, [1.0] * 63), (503, [1.0] * 65), (504, []), (505, [None] + [0.0] * 63), (506, [float("nan")] + [0.0] * 63), (507, [0.0] * 63 + [float("-inf")])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("cluster", "n", "sums", "v", "distance")})
    found = centroids.clustered(table.repartition(5), k=k).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, *r[1:]) for r in found) == _clusters(rows, k, 5)


def test_fewer_vectors_than_centroids_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(None, [0.5] * 64), (3, [0.1] * 64), (3, [0.1] * 64)]
    found = centroids.clustered(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, *r[1:]) for r in found) == _clusters(rows, 40, 5)
    assert centroids.clustered(spark.createDataFrame([], schema)).count() == 0
    assert centroids.clustered(spark.createDataFrame([(1, [1.0])], schema)).count() == 0
    with pytest.raises(Exception, match="do not fit"):
        centroids.clustered(spark.createDataFrame([(1, [1e30] * 64)], schema)).count()


def test_search_is_exact_and_leaves_centroids_out():
    rng = np.random.default_rng(4)
    assert (centroids.TRANSFORM @ centroids.TRANSFORM.T == 64 * np.eye(64, dtype=np.int64)).all()
    changes = (np.diff(centroids.TRANSFORM, axis=1) != 0).sum(1)
    assert changes.tolist() == list(range(64))
    smooth = np.cumsum(rng.integers(-9, 10, (300, 64)), 1)  # coarse differences tell most of these apart
    near = np.concatenate([smooth[:20], smooth[:20], smooth[:1] + 1])  # every centroid twice: ties
    number, distance, finished = centroids.nearest(smooth @ centroids.TRANSFORM.T, near @ centroids.TRANSFORM.T)
    every = ((smooth[:, None] - near[None]) ** 2).sum(2)
    assert number.tolist() == every.argmin(1).tolist() and distance.tolist() == every.min(1).tolist()
    assert finished < 0.4 * len(smooth) * len(near)
