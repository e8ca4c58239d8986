"""Centroid clustering of whole-number vectors by bit-plane popcounts.

A vector of 64 components becomes whole numbers in two's complement, and plane b packs bit b of all 64 into one 64-bit
word. With plane weights ``2**b`` (the last one's negative), the dot product of two vectors is the weighted sum of
``popcount(x_i AND c_j)`` over all pairs of planes, an exact whole number, and so is the squared distance
``x.x + c.c - 2 x.c``. A vector has as many planes as its largest component needs; repeating its last plane changes
nothing, which brings the vectors of a batch to one width.

Each round assigns every vector in tasks, adds up components and counts by centroid there, and merges one row a centroid
and task. Only the centroids, ``k`` rows of 64 numbers, go between the driver and the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.session import ship_by_value, stage

WIDTH, SCALE = 64, 256.0
K, ROUNDS, SEED = 40, 5, 2
#: Whole numbers end here, so that the squared distance of any two vectors is a 64-bit number.
LIMIT = (1 << 27) - 1
#: Vectors compared with all centroids at a time.
STRIP = 4096

ship_by_value(__name__)


def pack(values: np.ndarray) -> np.ndarray:
    """(n, 64) whole numbers to (n, planes) words, the last plane being the sign."""
    top = int(max(values.max(initial=0), -1 - values.min(initial=0)))
    planes = np.empty((len(values), top.bit_length() + 1), dtype=np.uint64)
    for b in range(planes.shape[1]):
        bits = ((values >> b) & 1).astype(np.uint8)
        planes[:, b] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return planes


def unpack(planes: np.ndarray) -> np.ndarray:
    """The whole numbers of packed vectors."""
    values = np.zeros((len(planes), WIDTH), dtype=np.int64)
    for b, weight in enumerate(weights(planes.shape[1])):
        own = np.ascontiguousarray(planes[:, b]).astype("<u8").view(np.uint8).reshape(-1, 8)
        values += np.unpackbits(own, axis=1, bitorder="little").astype(np.int64) * weight
    return values


def weights(count: int) -> list[int]:
    return [1 << b for b in range(count - 1)] + [-(1 << (count - 1))]


def dots(ours: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Exact dot products of every vector of ``ours`` with every one of ``theirs``, by AND and popcount of planes."""
    out = np.zeros((len(ours), len(theirs)), dtype=np.int64)
    up, down = weights(ours.shape[1]), weights(theirs.shape[1])
    for i, u in enumerate(up):
        column = np.ascontiguousarray(ours[:, i])[:, None]
        for j, d in enumerate(down):
            out += np.bitwise_count(column & np.ascontiguousarray(theirs[:, j])[None, :]).astype(np.int64) * (u * d)
    return out


def norms(planes: np.ndarray) -> np.ndarray:
    """Exact squared length of each vector, by the same popcounts of its own planes."""
    out = np.zeros(len(planes), dtype=np.int64)
    up = weights(planes.shape[1])
    for i, u in enumerate(up):
        for j in range(i, len(up)):
            out += np.bitwise_count(planes[:, i] & planes[:, j]).astype(np.int64) * (u * up[j] * (1 if i == j else 2))
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each vector, ties to the smaller, and the squared distance."""
    which, far = np.empty(len(planes), dtype=np.int64), np.empty(len(planes), dtype=np.int64)
    own = norms(centroids)
    for at in range(0, len(planes), STRIP):
        strip = planes[at : at + STRIP]
        distance = norms(strip)[:, None] + own[None, :] - 2 * dots(strip, centroids)
        which[at : at + STRIP] = distance.argmin(axis=1)
        far[at : at + STRIP] = distance.min(axis=1)
    return which, far


def widen(column: pa.Array) -> np.ndarray:
    """Plane lists of a batch as one array; shorter ones repeat their last plane."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    begin = np.cumsum(sizes) - sizes
    places = np.minimum(np.arange(int(sizes.max(initial=1)))[None, :], sizes[:, None] - 1)
    return flat[begin[:, None] + places]


def plane_table(vectors: DataFrame) -> DataFrame:
    """``vec_id, planes`` of the rows of ``vectors`` with 64 components, none of them null or non-finite."""
    x = F.col("embedding").cast("array<double>")
    whole = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    kept = vectors.where((F.size(x) == WIDTH) & ~whole).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))

    def planes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            whole = np.clip(np.floor(values * SCALE), -LIMIT - 1, LIMIT).astype(np.int64)
            words = pack(whole)
            offsets = pa.array(np.arange(len(words) + 1) * words.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(words.view(np.int64).reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["vec_id", "planes"])

    return kept.mapInArrow(planes, "vec_id long, planes array<long>")


def first_centroids(table: DataFrame, k: int) -> np.ndarray:
    """Values of the ``k`` vectors whose ids hash lowest; repeated ids in the order of their planes, null ids last."""
    mark = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("vec_id").cast("string")), 256)
    rows = table.orderBy(mark.asc_nulls_last(), "planes").limit(k).select("planes").toArrow()
    return unpack(widen(rows.column("planes").combine_chunks())) if len(rows) else np.zeros((0, WIDTH), dtype=np.int64)


def moved(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floor of the mean of each one's vectors; those without vectors stay."""
    shared = table.sparkSession.sparkContext.broadcast(pack(centroids))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((len(shared.value), WIDTH), dtype=np.int64), np.zeros(len(shared.value), dtype=np.int64)
        for batch in batches:
            planes = widen(batch.column(0))
            which, _ = nearest(planes, shared.value)
            np.add.at(sums, which, unpack(planes))
            counts += np.bincount(which, minlength=len(counts))
        has = np.flatnonzero(counts)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(has) + 1) * WIDTH, pa.int32()), pa.array(sums[has].reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(counts[has]), lists], ["cluster", "n", "sums"])

    parts = table.select("planes").mapInArrow(add_up, "cluster long, n long, sums array<long>")
    # Exact at any number of vectors: sums of sums may leave 64 bits. One row for each component of a centroid.
    merged = parts.select("cluster", "n", F.posexplode("sums").alias("place", "part")).groupBy("cluster", "place")
    out = centroids.copy()
    for row in merged.agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect():
        out[row["cluster"], row["place"]] = int(row["total"]) // row["n"]
    return out


def cluster_rows(vectors: DataFrame, k: int = K, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part.

    Vectors that are null, have another length than 64, or hold null or non-finite components have no row. Each other
    row is a vector of its own, also if its vec_id is null or repeated. With fewer than ``k`` vectors each starts a
    centroid; an empty table gives no rows. Whole numbers beyond ``LIMIT`` count as the limit.
    """
    spark = vectors.sparkSession
    table = stage(plane_table(vectors), "planes-vectors")
    centroids = first_centroids(table, k)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(table, centroids)
    shared = spark.sparkContext.broadcast(pack(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, far = nearest(widen(batch.column(1)), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(which), pa.array(far)], ["vec_id", "cluster", "distance"])

    rows = stage(table.mapInArrow(assign, "vec_id long, cluster long, distance long"), "planes-assigned")
    # One row a centroid, k at most.
    sums = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    marks = [(int(c), s, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sums.items()]
    named = spark.createDataFrame(marks, "cluster long, cluster_inertia long, centroid_sha256 string")
    out = rows.join(F.broadcast(named), "cluster")
    inertia = F.lit(sum(sums.values())).cast("long").alias("inertia")
    return out.select("vec_id", F.col("cluster").cast("int").alias("cluster"), "distance", "cluster_inertia", inertia, "centroid_sha256")
