"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes.

Codes: vectors are projected on principal axes, and the rotation that brings them closest to signs is learned by turns
(sign, then orthogonal fit) on a bounded sample. The signs are the code.

Index: rows lie in shards by a hash of their id. In each shard codes are cut into substrings of eight bits, and every
substring has its own table from value to rows. If two codes differ in at most ``radius`` bits, some substring differs
in at most ``radius // substrings`` (pigeonhole), so probing all values that near, in every table, retrieves every code
within the radius. Those codes are reranked by distance of the original vectors in double precision.

The radius is learned on the sample: wide enough for ``COVER`` of true neighbours there. Where a shard holds fewer than
``k`` codes within it, it grows for that query until there are. Blocks of queries meet shards of rows, both bounded;
a shard sends back its best ``k`` for a query only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.session import ship_by_value, stage

CHUNK = 8
#: Most rows of a shard and queries of a block, on average; small tables are dealt to at least ``TASKS`` shards.
SHARD_ROWS, BLOCK_ROWS, TASKS = 100_000, 100_000, 12
#: Bounded sample for rotation and radius, and how many of its rows act as queries.
SAMPLE, PROBES = 4096, 256
TURNS = 30
COVER = 0.97

ship_by_value(__name__)


def valid_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows that take part: no null, zero, or vector with null or non-finite components, and
    none whose length is not the most common one (of equally common ones the smallest)."""
    parts = F.col(vector).cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"), parts.alias("vector"))
    kept = kept.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & F.forall("vector", fine) & F.exists("vector", lambda x: x != 0))
    length = kept.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").limit(1)
    return kept.join(F.broadcast(length), F.size("vector") == F.col("length")).select("vec_id", "vector")


def learn_rotation(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre, and the projection whose signs are the code."""
    centre = sample.mean(axis=0)
    _, _, axes = np.linalg.svd(sample - centre, full_matrices=False)
    bits = min(len(axes) // CHUNK * CHUNK or len(axes), 64)
    flat = (sample - centre) @ axes[:bits].T
    turn = np.linalg.qr(np.random.default_rng(7).normal(size=(bits, bits)))[0]
    for _ in range(TURNS):
        left, _, right = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
        turn = (left @ right).T
    return centre, axes[:bits].T @ turn


def codes_of(vectors: np.ndarray, centre: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Codes as rows of bytes; a code that is no whole number of bytes is filled up with zeros."""
    return np.packbits((vectors - centre) @ projection >= 0, axis=1)


def learn_radius(sample: np.ndarray, codes: np.ndarray, k: int) -> int:
    """Hamming distance that holds ``COVER`` of the true ``k`` neighbours of the first sample rows."""
    spread = []
    for q in range(min(PROBES, len(sample))):
        near = np.argsort(((sample - sample[q]) ** 2).sum(axis=1), kind="stable")
        near = near[near != q][:k]
        spread.append(np.bitwise_count(codes[near] ^ codes[q]).sum(axis=1))
    spread = np.concatenate(spread) if spread else np.zeros(0)
    return int(np.quantile(spread, COVER, method="higher")) if len(spread) else 0


class MultiIndex:
    """Substring tables over the codes of one shard."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.order = [np.argsort(codes[:, c], kind="stable") for c in range(codes.shape[1])]
        self.first = [np.searchsorted(codes[o, c], np.arange(257)) for c, o in enumerate(self.order)]
        values = np.arange(256, dtype=np.uint8)
        self.near = [np.flatnonzero(np.bitwise_count(values) <= t) for t in range(CHUNK + 1)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code differs from ``code`` in at most ``radius`` bits."""
        reach = min(radius // len(code), CHUNK)
        found = np.zeros(len(self.codes), dtype=bool)
        if len(self.near[reach]) == 256:
            found[:] = True
        else:
            for c, part in enumerate(code):
                for value in self.near[reach] ^ part:
                    found[self.order[c][self.first[c][value] : self.first[c][value + 1]]] = True
        rows = np.flatnonzero(found)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(axis=1) <= radius]


def search_shard(ids: np.ndarray, vectors: np.ndarray, index: MultiIndex, query_ids: np.ndarray, queries: np.ndarray, codes: np.ndarray, radius: int, k: int) -> list[tuple]:
    out, widest = [], codes.shape[1] * CHUNK
    for q, query, code in zip(query_ids, queries, codes):
        wide, rows = radius, index.within(code, radius)
        while (rows := rows[ids[rows] != q]).size < k and wide < widest:
            wide = min(widest, wide + 4)
            rows = index.within(code, wide)
        score = np.sqrt(((vectors[rows] - query) ** 2).sum(axis=1))
        best = np.lexsort((ids[rows], score))[:k]
        out += [(int(q), int(i), float(s)) for i, s in zip(ids[rows[best]], score[best])]
    return out


def nearest(rows: DataFrame, k: int = 10, every: int = 100, vector: str = "embedding", cover: float = COVER) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row whose vec_id is a multiple of ``every``.

    Candidates are all rows but those with the query's own vec_id; fewer than ``k`` candidates give as many rows. Equal
    scores go to the smaller vec_id. A vec_id that is repeated counts once, with its smallest vector. Rows that take no
    part (``valid_vectors``) are neither queries nor candidates; empty tables give no rows.
    """
    spark = rows.sparkSession
    table = stage(valid_vectors(rows, vector).groupBy("vec_id").agg(F.min("vector").alias("vector")), "neighbours")
    picked = table.select("vec_id", F.xxhash64("vec_id").alias("h")).orderBy("h", "vec_id").limit(SAMPLE)
    sample = table.join(F.broadcast(picked), "vec_id").orderBy("h", "vec_id").select("vector").toPandas()["vector"]
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.stack(list(sample)).astype(np.float64)
    centre, projection = learn_rotation(sample)
    radius = learn_radius(sample, codes_of(sample, centre, projection), k)
    size = table.count()
    shards = max(-(-size // SHARD_ROWS), min(TASKS, size))
    blocks = max(1, -(-size // every // BLOCK_ROWS))

    def every_part(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def own_part(count: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")

    members = table.withColumn("shard", own_part(shards)).withColumn("block", every_part(blocks))
    asked = table.where(F.col("vec_id") % every == 0).withColumn("block", own_part(blocks)).withColumn("shard", every_part(shards))

    def search(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        def arrays(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            values = part.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return part.column("vec_id").to_numpy(), values.reshape(part.num_rows, -1)

        found = []
        if ours.num_rows and theirs.num_rows:
            (ids, vectors), (query_ids, queries) = arrays(ours), arrays(theirs)
            index = MultiIndex(codes_of(vectors, centre, projection))
            found = search_shard(ids, vectors, index, query_ids, queries, codes_of(queries, centre, projection), radius, k)
        names, kinds = ("query_id", "vec_id", "score"), (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array([f[i] for f in found], t) for i, (n, t) in enumerate(zip(names, kinds))})

    pairs = members.groupBy("block", "shard").cogroup(asked.groupBy("block", "shard"))
    found = pairs.applyInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
