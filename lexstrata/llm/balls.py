"""Operator 11: k-means clusters held as balls.

Vectors become integers, so every comparison is exact. A block of members of one cluster is a ball
around its centroid: a centroid can only win members if half its distance from the ball's own is
within the ball's radius, so others are no neighbours and are never compared. The members, sorted
by distance from their own centroid, fall into a stable core (nearer than half the distance to
the next neighbour), which stays, and annuli, each compared with the neighbours whose half
distance it reaches. All of that holds for any ball, so a block's own radius is used, which
is no more than that of the whole cluster.

Blocks keep their vectors in the least width that fits, beside the members' clusters and, for each
cluster, its count, sums and radius; a round writes them to the shared folder, sums the small
numbers by cluster, and moves the centroids (at most k rows reach the driver). No vector is ever
shuffled, so copies of one vector don't meet in a task.

Vectors without exactly `dims` components, or with null or non-finite ones, are left out, and so are those
with a component beyond `widest(dims)` after scaling (about 92,681 before it, for 64 components), whose distances
need not fit a long. Rows that repeat an id each count; equal starting hashes go by the vector. A null id
is never a start, as it has no hash. With fewer than k vectors there are as many clusters.
Ties go to the smaller number. Empty tables give none; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexstrata.llm.shared import dropped, only, ship, stored

SCALE = 1024
BALL = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("radius", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType()))])
ARROW_BALLS = pa.list_(pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("radius", pa.int64()), ("sums", pa.list_(pa.int64()))]))


def widest(dims: int) -> int:
    """The largest component for which four times a squared distance fits a long."""
    return math.isqrt(2**61 // dims) // 2


def integers(vectors: DataFrame, id_col: str, vector: str, dims: int) -> DataFrame:
    """id and x, the floors of the scaled components, of the vectors that are kept."""
    part = lambda c: F.lit(float(SCALE)) * c.cast("double")
    fits = lambda c: F.coalesce(F.abs(F.floor(part(c))) <= widest(dims), F.lit(False)) & ~F.isnan(part(c))
    kept = only(vectors, id_col, vector).toDF("id", "v").where((F.size("v") == dims) & F.forall("v", fits))
    return kept.select("id", F.transform("v", lambda c: F.floor(part(c)).cast("long")).alias("x"))


def starts(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest hash of `seed:id`."""
    hashed = kept.withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    return [list(r.x) for r in hashed.where("hash IS NOT NULL").orderBy("hash", "x").limit(k).select("x").collect()]


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def assigned(x: np.ndarray, home: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid and squared distance of every row, from any guess `home`."""
    cluster, distance = home.astype(np.int64), np.zeros(len(x), np.int64)
    for i in np.unique(home):
        members = np.flatnonzero(home == i)
        own = squared(x[members], centroids[i])
        order = np.argsort(own, kind="stable")
        members, own = members[order], own[order]
        ball, best, at = x[members], own.copy(), np.full(len(members), i, np.int64)
        gaps = squared(centroids, centroids[i])
        for j in np.flatnonzero(gaps <= 4 * own[-1]):
            if j == i:
                continue
            ring = int(np.searchsorted(4 * own, gaps[j]))  # before it, half the gap is further than the own centroid
            d = squared(ball[ring:], centroids[j])
            won = (d < best[ring:]) | ((d == best[ring:]) & (j < at[ring:]))
            best[ring:][won], at[ring:][won] = d[won], j
        cluster[members], distance[members] = at, best
    return cluster, distance


def packed(x: np.ndarray) -> tuple[int, bytes]:
    """Bytes a component, and the rows in that width."""
    top = int(np.abs(x).max(initial=0))
    width = 2 if top < 2**15 else 4
    return width, x.astype(f"<i{width}").tobytes()


def balls(x: np.ndarray, cluster: np.ndarray, distance: np.ndarray) -> list[dict]:
    out = []
    for c in np.unique(cluster):
        m = cluster == c
        out.append({"cluster": int(c), "n": int(m.sum()), "radius": int(distance[m].max()), "sums": x[m].sum(axis=0).tolist()})
    return out


def _block(ids: pa.Array, x: np.ndarray, cluster: np.ndarray, distance: np.ndarray) -> pa.RecordBatch:
    width, data = packed(x)
    lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    return pa.RecordBatch.from_arrays(
        [lists, pa.array([width], pa.int32()), pa.array([data], pa.binary()), pa.array([cluster.astype("<i4").tobytes()], pa.binary()), pa.array([balls(x, cluster, distance)], ARROW_BALLS)],
        names=["ids", "width", "packed", "clusters", "balls"],
    )


def _first(dims: int, centroids: np.ndarray):
    def run(batches):
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                yield _block(b.column(0), x, *assigned(x, np.zeros(len(x), np.int64), centroids))

    return run


def _unpacked(batches, dims: int):
    for b in batches:
        for k in range(b.num_rows):
            x = np.frombuffer(b.column("packed")[k].as_py(), f"<i{b.column('width')[k].as_py()}").reshape(-1, dims).astype(np.int64)
            yield b.column("ids")[k].values, x, np.frombuffer(b.column("clusters")[k].as_py(), "<i4")


def _next(dims: int, centroids: np.ndarray):
    def run(batches):
        for ids, x, home in _unpacked(batches, dims):
            yield _block(ids, x, *assigned(x, home, centroids))

    return run


def _last(dims: int, centroids: np.ndarray):
    def run(batches):
        for ids, x, home in _unpacked(batches, dims):
            cluster, distance = assigned(x, home, centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    return run


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid that has members at the floor of their mean."""
    dims = centroids.shape[1]
    each = blocks.select(F.explode("balls").alias("b")).select("b.*")
    sums = each.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(dims)])
    out = centroids.copy()
    for row in sums.collect():  # at most k rows
        out[row.cluster] = [int(row[f"s{d}"]) // row.n for d in range(dims)]
    return out


def ball_kmeans(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dims: int = 64, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256 and cluster_size of every vector that is kept.

    An inertia beyond a long is null.
    """
    spark = vectors.sparkSession
    ship(spark)
    kept = integers(vectors, id_col, vector, dims)
    id_type = kept.schema["id"].dataType
    state = T.StructType([
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("width", T.IntegerType()), T.StructField("packed", T.BinaryType()),
        T.StructField("clusters", T.BinaryType()), T.StructField("balls", T.ArrayType(BALL)),
    ])
    found = T.StructType([T.StructField("id", id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    first = starts(kept, k, seed)
    centroids = np.array(first, np.int64).reshape(len(first), dims)
    if first:
        blocks = stored(kept.mapInArrow(_first(dims, centroids), state), "round0")
        for n in range(1, rounds + 1):
            centroids = moved(blocks, centroids)
            if n < rounds:
                later = stored(blocks.mapInArrow(_next(dims, centroids), state), f"round{n}")
                dropped(blocks)
                blocks = later
        rows = stored(blocks.mapInArrow(_last(dims, centroids), found), "members")
        dropped(blocks)
    else:
        rows = spark.createDataFrame([], found)
    sums = rows.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # at most k rows
    long = lambda n: int(n) if n < 2**63 else None
    total = sum(int(r.s) for r in sums)
    named = [(r.cluster, long(r.s), long(total), hashlib.sha256(",".join(map(str, centroids[r.cluster].tolist())).encode()).hexdigest(), r.n) for r in sums]
    facts = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, cluster_size long")
    return rows.join(F.broadcast(facts), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "cluster_size")
