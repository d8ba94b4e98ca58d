"""Nearest centroids of integer vectors by a progressive search in Walsh-Hadamard order.

The transform of a vector of 64 integers has 64 integers, and squared distances between
transforms are 64 times those between vectors, exactly. The first coefficients, in the order
of their sign changes, hold the coarse differences. So a search adds squared differences of a
few coefficients at a time: the sum so far is a lower bound, one centroid's whole distance
is an upper bound, and centroids whose lower bound is strictly greater go. What is left is
carried on to all 64 coefficients, where the least distance wins and, of equal ones, the
smaller number. No centroid that could win or tie is ever left out.

A round of clustering maps each part of the vectors against the centroids, which are a fixed
small number, and gives one row of sums for each cluster and task; Spark adds them up. Sums
are of transforms, since the transform of a sum is the sum of the transforms.

Defined results: rows whose vector is null, of another length, or with null, NaN or infinite
components are left out; repeated ids and equal vectors are rows like any others, those of one
id in the order of their transforms where centroids start; rows without an id are clustered, and
start a centroid only where too few have one; with fewer vectors than
centroids each starts one; equal distances go to the smaller number; an empty cluster keeps its
centroid; an empty table gives an empty table; extra columns are ignored. Components beyond
+-2**15 raise an error, since squared sums would no longer fit into 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firngrid.sources.shared import staged

WIDTH = 64
#: Coefficients after which centroids are left out.
STAGES = (4, 8, 16, 32, WIDTH)
#: Vectors of one step of a search.
STEP = 2048
_LARGEST = 2**15


def _transform() -> np.ndarray:
    """The Walsh-Hadamard matrix, its rows by their number of sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < WIDTH:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((np.diff(h, axis=1) != 0).sum(1), kind="stable")]


TRANSFORM = _transform()


def nearest(coefficients: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The number and the squared distance of the nearest centroid, from transforms of both.

    Also returns how many pairs of a vector and a centroid came to the last stage.
    """
    n, k = len(coefficients), len(centroids)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    row, number = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)  # in this order all along
    sums, begin, finished = np.zeros(n * k, np.int64), 0, 0
    for end in STAGES:
        step = coefficients[row, begin:end] - centroids[number, begin:end]
        sums += np.einsum("ij,ij->i", step, step)
        begin, finished = end, len(row)
        # the first pair of each row that has the row's least sum
        least = np.minimum.reduceat(sums, np.flatnonzero(np.diff(row, prepend=-1)))
        best = np.flatnonzero(sums == least[row])
        best = best[np.flatnonzero(np.diff(row[best], prepend=-1))]
        if end == WIDTH:
            return number[best], sums[best] // WIDTH, finished
        # the whole distance of the best so far bounds the least distance from above
        rest = coefficients[:, end:] - centroids[number[best], end:]
        bound = least + np.einsum("ij,ij->i", rest, rest)
        kept = sums <= bound[row]
        row, number, sums = row[kept], number[kept], sums[kept]
    raise AssertionError("the last stage has all coefficients")


def kept_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, coefficients array<int>``: the transforms of floor(256 x) of all whole vectors."""
    double = F.transform(vector, lambda x: x.cast("double"))
    odd = F.exists(double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), double.alias("v")).where((F.size(vector) == WIDTH) & ~F.coalesce(odd, F.lit(True)))
    schema = pa.schema([("vec_id", pa.int64()), ("coefficients", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.floor(256 * batch.column("v").flatten().to_numpy().reshape(-1, WIDTH))
            if v.size and np.abs(v).max() > 256 * _LARGEST:
                raise ValueError(f"components beyond +-{_LARGEST} do not fit")
            c = (v.astype(np.int64) @ TRANSFORM.T).astype(np.int32)
            offsets = np.arange(0, c.size + 1, WIDTH, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.ListArray.from_arrays(offsets, c.ravel())], schema=schema)

    return rows.mapInArrow(run, "vec_id long, coefficients array<int>")


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            part = batch.slice(at, STEP)
            yield part, part.column("coefficients").flatten().to_numpy().reshape(-1, WIDTH).astype(np.int64)


def cluster_sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and sums of coefficients of each cluster that has vectors."""
    near_to = centroids @ TRANSFORM.T
    schema = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = np.zeros((len(near_to), WIDTH), np.int64), np.zeros(len(near_to), np.int64)
        for _, c in _steps(batches):
            number, _, _ = nearest(c, near_to)
            np.add.at(sums, number, c)
            count += np.bincount(number, minlength=len(near_to))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(count[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], schema=schema
        )

    parts = vectors.select("coefficients").mapInArrow(run, "cluster int, n long, sums array<long>")
    added = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(j))).alias(f"s{j}") for j in range(WIDTH)])
    return {r.cluster: (r.n, [r[f"s{j}"] for j in range(WIDTH)]) for r in added.collect()}


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the least sha256 of ``seed:<vec_id>``, in that order."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(rank.asc_nulls_last(), "coefficients").limit(k).collect()
    found = np.array([r.coefficients for r in rows], np.int64).reshape(-1, WIDTH)
    return found @ TRANSFORM // WIDTH


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of all vectors."""
    near_to = centroids @ TRANSFORM.T
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, c in _steps(batches):
            number, distance, _ = nearest(c, near_to)
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance)], schema=schema)

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def clustered(table: DataFrame, k: int = 40, rounds: int = 5, seed: str = "2") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every whole vector."""
    spark = table.sparkSession
    vectors = staged(kept_vectors(table), "vectors")
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        for cluster, (n, sums) in cluster_sums(vectors, centroids).items():
            whole = np.array(sums, object) @ TRANSFORM  # 64 times the sums, in exact integers
            centroids[cluster] = [int(x) // WIDTH // n for x in whole]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    found = staged(assigned(vectors, centroids), "assigned") if digests else spark.createDataFrame([], "vec_id long, cluster int, distance long")
    inertia = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    rows = [(c, v, sum(inertia.values()), digests[c]) for c, v in inertia.items()]
    of_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # at most k rows
    return found.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(k: int, rounds: int, seed: str) -> str:
    """The same rows in SQL, a common table for each round."""
    parts = [
        "v as (select row_number() over () as r, vec_id, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as e from embeddings"
        " where len(embedding) = 64 and list_aggregate([x is not null and isfinite(x) for x in embedding], 'bool_and'))",
        "x as (select r, unnest(range(64)) as j, unnest(e) as x from v)",
        f"s as (select r, row_number() over (order by sha256('{seed}:' || vec_id)) - 1 as c from v where vec_id is not null qualify c < {k})",
        "c0 as (select c, j, x from s join x using (r))",
    ]
    for t in range(rounds + 1):
        parts.append(f"d{t} as (select r, c, sum((x.x - c{t}.x) * (x.x - c{t}.x)) as d from x join c{t} using (j) group by r, c)")
        parts.append(f"a{t} as (select r, c, d from d{t} qualify row_number() over (partition by r order by d, c) = 1)")
        if t < rounds:
            parts.append(f"n{t} as (select c, j, cast(floor(cast(sum(x) as double) / count(*)) as bigint) as x from a{t} join x using (r) group by c, j)")
            parts.append(f"c{t + 1} as (select c, j, coalesce(n{t}.x, c{t}.x) as x from c{t} left join n{t} using (c, j))")
    return (
        "with " + ",\n".join(f"{p.split(' as ', 1)[0]} as materialized {p.split(' as ', 1)[1]}" for p in parts) + f""",
h as (select c, sha256(string_agg(cast(x as varchar), ',' order by j)) as h from c{rounds} group by c)
select vec_id, cast(c as int) as cluster, cast(d as bigint) as distance,
  cast(sum(d) over (partition by c) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
  h as centroid_sha256
from a{rounds} join v using (r) join h using (c)
"""
    )


ORACLE_SQL = oracle_sql(40, 5, "2")
