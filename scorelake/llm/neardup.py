"""MinHash near-dedup with SetSketch registers.

A document is the set of its 5-word shingles. Register j of its sketch is the truncated minimum of exponential variables
of all shingles on a scale of powers of ``BASE``: ``min(LEVELS, max(0, floor(1 - log_BASE(min x_j))))``. Sketches of
parts merge by the maximum, and two documents agree in a register about as often as their sets overlap. Bands of
``BAND`` registers put similar documents into common buckets; register comparisons give the maximum-likelihood estimate
of the overlap, which drops pairs that are far below the threshold; the rest is confirmed on full sets.

With 40 bands of 4 registers a pair at the threshold of 0.75 has no bucket in common with probability
``(1 - 0.75**4)**40``, under one in a million.

Documents with the same set are one class. In a bucket no pairs of all members are made. Every member is compared with
two leaders: the member that shares most buckets overall, as the common origin of many copies does, and the smallest;
then what is unlike the first leader is compared with a leader of its own, and what is unlike that one too is compared in
blocks of bounded size, of which only pairs that join families leave. Confirmed pairs are links, and pairs with a fair
estimate, links or not, make families. A family whose members are not all linked is compared in full: it is dealt
to blocks of bounded size, pairs of blocks meet in tasks, and only links between different components leave them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.blocks import Hasher, bitmap, in_bitmap, mix, shingles, text_blocks
from scorelake.llm.components import components
from scorelake.session import ship_by_value, stage

SHINGLE = 5
BANDS, BAND = 40, 4
REGISTERS = BANDS * BAND
BASE, RATE, LEVELS = 1.001, 20.0, 65535
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A pair is dropped unconfirmed if its estimate is this far below the threshold: six deviations of 160 registers.
ESTIMATE_MARGIN = 0.21
#: Most members and shingles, on average, of a block of a family.
BLOCK_MEMBERS, BLOCK_SHINGLES = 1024, 1 << 21
#: Columns of shared shingles that are multiplied at a time.
STRIP = 4096
SKETCH_TOKENS = 1 << 16

ship_by_value(__name__)


def register_seeds() -> np.ndarray:
    return np.random.default_rng(17).integers(0, 1 << 63, (2, REGISTERS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def registers(hashes: np.ndarray, begin: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """One row of registers for each text; ``begin`` has where each text's shingles begin, all texts having some."""
    lows = np.empty((len(begin) - 1, REGISTERS), dtype=np.uint64)
    for j in range(REGISTERS):
        own = (hashes ^ seeds[0, j]) * seeds[1, j]
        own ^= own >> np.uint64(32)
        own *= seeds[0, j]
        lows[:, j] = np.minimum.reduceat(own, begin[:-1])
    # The smallest hash has the smallest exponential variable, so only that is transformed.
    smallest = -np.log1p(-(lows.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / np.log(BASE)), 0, LEVELS).astype(np.uint16)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """64-bit bucket keys of every band."""
    wide = sketches.reshape(len(sketches), BANDS, BAND).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    key = np.broadcast_to(key, wide.shape[:2])
    for k in range(BAND):
        key = mix(key * np.uint64(31) + wide[:, :, k] + np.uint64(1))
    return key


def distinct_sets(hashes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, and where each text's begin."""
    parts = [np.unique(hashes[begin[d] : begin[d + 1]]) for d in range(len(begin) - 1)]
    return np.concatenate([*parts, np.zeros(0, dtype=np.uint64)]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def fingerprints(sets: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Hash of each whole set."""
    sums = np.zeros(len(sets) + 1, dtype=np.uint64)
    np.cumsum(mix(sets), out=sums[1:])
    own = sums[begin[1:]] - sums[begin[:-1]]
    return mix(own ^ mix(np.diff(begin).astype(np.uint64)))


def text_sets(column: pa.Array, hasher: Hasher) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows from, to, and their sets, for blocks of texts."""
    for first, end, data, offsets in text_blocks(column):
        tokens, starts = hasher.words(data, offsets)
        hashes, _, begin = shingles(tokens, starts, SHINGLE)
        yield first, end, *distinct_sets(hashes, begin)


def _lists(values: np.ndarray, width: int) -> pa.Array:
    flat = np.ascontiguousarray(values).view(np.int64).reshape(-1)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) // width + 1) * width, pa.int32()), pa.array(flat))


def sketch_table(docs: DataFrame) -> DataFrame:
    """``doc_id, n, print, sketch, keys`` of every row; a document without words has n 0 and nulls."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seeds = Hasher(), register_seeds()
        for batch in batches:
            for first, end, sets, begin in text_sets(batch.column(1), hasher):
                sizes = np.diff(begin)
                has = np.flatnonzero(sizes)
                rows = np.zeros((end - first, REGISTERS), dtype=np.uint16)
                at = np.concatenate([begin[:-1][has], begin[-1:]])
                i = 0
                while i < len(has):
                    j = max(i + 1, int(np.searchsorted(at, at[i] + SKETCH_TOKENS)) - 1)
                    rows[has[i:j]] = registers(sets[at[i] : at[j]], at[i : j + 1] - at[i], seeds)
                    i = j
                none = pa.array(sizes == 0)
                prints = pa.array(fingerprints(sets, begin).view(np.int64), mask=sizes == 0)
                packed = pa.array([rows[d].tobytes() if sizes[d] else None for d in range(len(rows))], pa.binary())
                keys = pc.if_else(none, pa.scalar(None, pa.list_(pa.int64())), _lists(band_keys(rows), BANDS))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(sizes), prints, packed, keys],
                    ["doc_id", "n", "print", "sketch", "keys"],
                )

    types = "doc_id long, n long, print long, sketch binary, keys array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(sketch, types)


def full_sets(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """``print, shingles`` of the sets whose fingerprint is in ``prints``, from a second pass over the texts.

    A bit set of fixed size keeps most other sets from leaving their task; the join after it is exact.
    """
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(prints, F.col("print")))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for _, _, sets, begin in text_sets(batch.column(0), hasher):
                own = fingerprints(sets, begin)
                wanted = np.flatnonzero(in_bitmap(bits.value, own) & (np.diff(begin) > 0))
                if len(wanted):
                    parts = [sets[begin[d] : begin[d + 1]].view(np.int64) for d in wanted]
                    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts)))
                    yield pa.RecordBatch.from_arrays([pa.array(own[wanted].view(np.int64)), lists], ["print", "shingles"])

    found = docs.select(F.col("text").cast("string")).mapInArrow(sets_of, "print long, shingles array<long>")
    return found.join(prints, "print", "left_semi").dropDuplicates(["print"])


def overlap_estimate(ours: np.ndarray, theirs: np.ndarray, n_ours: np.ndarray, n_theirs: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from how many registers are larger, smaller or equal, sizes being known.

    The likelihood is concave in the similarity; its maximum is found by bisection of its derivative.
    """
    more, less = (ours > theirs).sum(axis=1), (ours < theirs).sum(axis=1)
    same = ours.shape[1] - more - less
    u, v = n_ours / (n_ours + n_theirs), n_theirs / (n_ours + n_theirs)
    scale = (BASE - 1) / BASE

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 1e-12, 1) * scale) / np.log(BASE)

    def slope(x: np.ndarray) -> np.ndarray:
        return scale / (1 - np.clip(x, 1e-12, 1) * scale) / np.log(BASE)

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(30):
        j = (low + high) / 2
        up, down = u - v * j, v - u * j
        equal = np.maximum(1 - chance(up) - chance(down), 1e-12)
        rise = -more * v * slope(up) / chance(up) - less * u * slope(down) / chance(down) + same * (v * slope(up) + u * slope(down)) / equal
        low, high = np.where(rise > 0, j, low), np.where(rise > 0, high, j)
    return (low + high) / 2


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b`` of the pairs whose sizes allow a link and whose estimate is not far below the threshold."""
    side = lambda s: classes.select(F.col("print").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ours, theirs = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS) for c in (2, 3))
            sizes = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in (4, 5)]
            near = overlap_estimate(ours, theirs, *sizes) >= PERCENT / 100 - ESTIMATE_MARGIN
            yield batch.select([0, 1]).filter(pa.array(near))

    return sized.select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b").mapInArrow(judge, "a long, b long")


def confirmed(docs: DataFrame, close: DataFrame) -> DataFrame:
    """Pairs of ``close`` that are links, confirmed on full sets."""
    prints = stage(close.select(F.explode(F.array("a", "b")).alias("print")).distinct(), "neardup-prints")
    sets = stage(full_sets(docs, prints), "neardup-sets")
    ours, theirs = sets.select(F.col("print").alias("a"), F.col("shingles").alias("ours")), sets.select(F.col("print").alias("b"), F.col("shingles").alias("theirs"))
    common = F.size(F.array_intersect("ours", "theirs"))
    both = F.size("ours") + F.size("theirs")
    linked = close.join(theirs, "b").join(ours, "a").where(common * 100 >= (both - common) * PERCENT)
    return stage(linked.select("a", "b"), "neardup-links")


def leader_pairs(members: DataFrame, leaders: DataFrame) -> DataFrame:
    """Distinct pairs ``a`` (a leader) and ``b`` (a member) of common buckets; ``leaders`` has ``key, top, low``."""
    starred = members.select("key", "id").join(leaders, "key").select("id", F.explode(F.array("top", "low")).alias("leader"))
    return starred.where(F.col("id") != F.col("leader")).select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()


def likely_pairs(classes: DataFrame) -> DataFrame:
    """Pairs with a fair estimate, a few for each member of a bucket, that hold similar classes together."""
    rows = classes.select(F.col("print").alias("id"), F.explode("keys").alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    shared = stage(rows.join(sizes, "key"), "neardup-buckets")
    members = stage(shared.drop("size").join(shared.groupBy("id").agg(F.sum("size").alias("shared")), "id"), "neardup-members")
    top = F.max_by("id", F.struct("shared", "id")).alias("top")
    leaders = stage(members.groupBy("key").agg(top, F.min("id").alias("low")), "neardup-leaders")
    close = stage(likely(leader_pairs(members, leaders), classes), "neardup-likely")

    def unlike(rows: DataFrame, close: DataFrame, led: DataFrame) -> DataFrame:
        """``key, id, shared`` of rows in another family than their bucket's ``top`` in ``led``."""
        family = components(close)
        placed = rows.join(family.withColumnRenamed("node", "id"), "id", "left").select("key", "id", "shared", F.coalesce("component", "id").alias("family"))
        first = led.join(family.withColumnRenamed("node", "top"), "top", "left").select("key", F.coalesce("component", "top").alias("first"))
        return stage(placed.join(first, "key").where(F.col("family") != F.col("first")).select("key", "id", "shared"), "neardup-others")

    others = unlike(members, close, leaders)
    second = stage(others.groupBy("key").agg(top, F.min("id").alias("low")), "neardup-leaders")
    close = stage(close.union(likely(leader_pairs(others, second), classes)).distinct(), "neardup-likely")
    return close.union(block_pairs(unlike(others, close, second), classes))


def block_pairs(rest: DataFrame, classes: DataFrame) -> DataFrame:
    """Likely pairs ``a, b`` among the members (``key, id``) of each bucket, as many as connect them as all would.

    A bucket is dealt to blocks, and every two blocks, and each with itself, meet in a group of bounded size.
    """
    sizes = rest.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    blocks = sizes.select("key", F.ceil(F.col("size") / BLOCK_MEMBERS).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = rest.join(blocks, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", F.col("id").alias("print"))
    wide = dealt.join(classes.select("print", "n", "sketch"), "print")

    def compare(rows: pa.Table) -> pa.Table:
        ids, own = rows.column("print").to_numpy(), rows.column("own").to_numpy()
        sizes = rows.column("n").to_numpy().astype(np.float64)
        sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
        across, part, found = len(np.unique(own)) > 1, np.arange(len(ids)), []
        for at in range(len(ids)):
            # What is in one part already needs no more pairs; sizes rule out most others.
            near = np.flatnonzero((part != part[at]) & (np.arange(len(ids)) > at) & (np.minimum(sizes, sizes[at]) * 100 >= np.maximum(sizes, sizes[at]) * PERCENT))
            near = near[own[near] != own[at]] if across else near
            if len(near):
                ours = np.broadcast_to(sketches[at], (len(near), REGISTERS))
                near = near[overlap_estimate(ours, sketches[near], np.full(len(near), sizes[at]), sizes[near]) >= PERCENT / 100 - ESTIMATE_MARGIN]
            for other in near:
                if part[other] != part[at]:
                    part[part == part[other]] = part[at]
                    found.append((ids[at], ids[other]))
        pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return stage(wide.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long").distinct(), "neardup-blocks")


def family_links(docs: DataFrame, close: DataFrame, links: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b``: links between components of ``links`` within the families that ``close`` makes, as many as join them."""
    family, part = components(close), components(links)
    placed = family.select(F.col("node").alias("print"), F.col("component").alias("family")).join(part.withColumnRenamed("node", "print"), "print", "left")
    placed = stage(placed.withColumn("component", F.coalesce("component", "print")).join(classes.select("print", "n"), "print"), "neardup-families")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    torn = placed.groupBy("family").agg(F.min("component").alias("x"), F.max("component").alias("y"), blocks.alias("blocks")).where(F.col("x") != F.col("y"))
    members = stage(placed.join(torn.select("family", "blocks"), "family"), "neardup-torn")
    sets = full_sets(docs, members.select("print"))
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    dealt = members.join(sets, "print").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "component", "shingles")

    def compare(rows: pa.Table) -> pa.Table:
        lists = rows.column("shingles").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        held = lists.flatten().to_numpy(zero_copy_only=False)
        parts, block = rows.column("component").to_numpy(), rows.column("own").to_numpy()
        found = joined_parts(held, sizes, parts, block) if len(np.unique(parts)) > 1 else np.zeros((0, 2), dtype=np.int64)
        return pa.table({"a": pa.array(found[:, 0], pa.int64()), "b": pa.array(found[:, 1], pa.int64())})

    return stage(dealt.groupBy("family", "i", "j").applyInArrow(compare, "a long, b long"), "neardup-joined")


def joined_parts(held: np.ndarray, sizes: np.ndarray, parts: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Pairs of components with a link between members: one row of sets each, their shingles in ``held`` one after the
    other. If there are two blocks, only pairs across them are compared, as each block meets itself elsewhere."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    shingle, column, often = np.unique(held, return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    order = order[often[column[order]] > 1]
    column, owner = column[order], owner[order]
    column = np.cumsum(np.concatenate([[False], column[1:] != column[:-1]])) if len(column) else column
    common = np.zeros((len(sizes), len(sizes)), dtype=np.float32)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(column, column[at] + STRIP))
        strip = np.zeros((len(sizes), STRIP), dtype=np.float32)
        strip[owner[at:end], column[at:end] - column[at]] = 1
        common += strip @ strip.T
        at = end
    union = sizes[:, None] + sizes[None, :] - common
    linked = (common * 100 >= union * PERCENT) & (parts[:, None] < parts[None, :])
    if len(np.unique(block)) > 1:
        linked &= block[:, None] != block[None, :]
    left, right = np.nonzero(linked)
    return np.unique(np.stack([parts[left], parts[right]], axis=1), axis=0)


def class_components(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``print, component`` of the classes that have links."""
    close = stage(likely_pairs(classes).distinct(), "neardup-close")
    links = confirmed(docs, close)
    return components(links.union(family_links(docs, close, links, classes))).withColumnRenamed("node", "print")


def placed_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, n, print, component, component_id`` of every row: its component as a number (null without words), and the
    smallest doc_id there."""
    rows = stage(sketch_table(docs), "neardup-sketches")
    filled = rows.where(F.col("n") > 0)
    classes = stage(filled.select("print", "n", "sketch", "keys").dropDuplicates(["print"]), "neardup-classes")
    parts = class_components(docs, classes)
    # The smallest id of each set first, so that a set with any number of copies is one row in what follows.
    first = filled.groupBy("print").agg(F.min("doc_id").alias("first"))
    named = first.join(parts, "print", "left").withColumn("component", F.coalesce("component", "print"))
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    found = stage(named.select("print", "component").join(lowest, "component").select("print", "component", "component_id"), "neardup-found")
    return rows.select("doc_id", "n", "print").join(found, "print", "left")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    ``component_id`` is the smallest doc_id of the rows that links connect, ``kept`` whether it is the row's own. Rows
    with a null text or without words are linked with nothing. Repeated rows are in one component and have one doc_id,
    so each is kept. A null doc_id is never the smallest unless its component has no other; then it is its own.
    """
    component = F.coalesce("component_id", "doc_id")
    return placed_rows(docs).select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_first(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, with all their columns: one of each group of near-duplicates.

    Of rows with a doc_id those with the smallest stay, repeated ones too; rows with the same doc_id share the decision.
    Rows without a doc_id go where their group has a row with one; else one of the group stays. Rows without words are
    in no group and stay. Empty tables give no rows.
    """
    placed = placed_rows(docs)
    other = F.col("component_id") != F.col("doc_id")
    gone = placed.where(other).select(F.col("doc_id").alias("__gone")).distinct()
    named = docs.where(F.col("doc_id").isNotNull()).join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
    # Rows without doc_id know their set only by its shingles, so each text's group is looked up by its fingerprint.
    nameless = set_prints(docs.where(F.col("doc_id").isNull()))
    groups = placed.where(F.col("doc_id").isNull() & F.col("print").isNotNull()).select(F.col("print").alias("__print"), "component", "component_id").distinct()
    groups = groups.select("__print", F.col("component").alias("__component"), F.col("component_id").isNotNull().alias("__named"))
    grouped = nameless.join(groups, "__print", "left")
    loose = grouped.where(F.col("__component").isNull())
    single = grouped.where(~F.col("__named")).dropDuplicates(["__component"])
    return named.unionByName(loose.unionByName(single).select(*[F.col(f"`{c}`") for c in docs.columns]))


def set_prints(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__print``, the fingerprint of each text's set (null without words)."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull()).distinct()

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for first, end, sets, begin in text_sets(batch.column(0), hasher):
                own = pa.array(fingerprints(sets, begin).view(np.int64), mask=np.diff(begin) == 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), own], ["__text", "__print"])

    found = texts.mapInArrow(prints, "__text string, __print long")
    return docs.join(found, F.col("text").cast("string") == F.col("__text"), "left").drop("__text")
