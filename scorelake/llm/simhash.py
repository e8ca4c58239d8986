"""SimHash near-dedup by meet-in-the-middle ball hashing.

A fingerprint has one bit for each bit of a 64-bit hash: 1 where more than half of a text's 3-word shingles (repeats
included) have it. Two fingerprints are linked at ``2 * HALF_RADIUS`` differing bits or fewer.

Every distinct fingerprint emits all variants within half the radius: itself and each with one bit turned. Two
fingerprints within the radius have a variant in common, the one half way, so a shuffle on variants finds every link.
A variant is met by at most 65 fingerprints, and which ones is told by the bits in which they differ from it: one 64-bit
mask and a flag, merged by bitwise or in a plain hash aggregation, whatever the number of documents. All that meet at a
variant are within the radius of each other, so links of each to the smallest connect them as all pairs would. Links
found at several variants are made distinct, and each is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.llm.blocks import FOLD, SPACES, spans, text_blocks
from scorelake.llm.components import components
from scorelake.session import ship_by_value, stage

SHINGLE, SEED, BITS = 3, 42, 64
HALF_RADIUS = 1
#: Shingles that are hashed, and whose bits are spread out, at a time.
STRIP = 1 << 14

ship_by_value(__name__)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, and where each text's begin (one more entry than texts)."""
    starts, ends, first = spans(~SPACES[data], offsets)
    # Words with one space between them, so that a shingle is one slice.
    sizes = ends - starts
    at = np.cumsum(sizes + 1) - sizes - 1
    plain = np.full(int((sizes + 1).sum()), 32, dtype=np.uint8)
    plain[np.repeat(at - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))] = FOLD[data[~SPACES[data]]]
    counts = np.diff(first)
    runs = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(runs)])
    opens = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], runs)
    closes = opens + np.repeat(np.minimum(counts, SHINGLE), runs) - 1
    view, digest = memoryview(plain), xxhash.xxh64_intdigest
    low, high, own = at[opens], at[closes] + sizes[closes], np.empty(len(opens), dtype=np.uint64)
    for i in range(0, len(own), STRIP):
        own[i : i + STRIP] = [digest(view[a:b], SEED) for a, b in zip(low[i : i + STRIP].tolist(), high[i : i + STRIP].tolist())]
    return own, begin


def majority(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Fingerprint of each text; zero for one without shingles."""
    sums = np.zeros((len(begin) - 1, BITS), dtype=np.int64)
    for low in range(0, len(hashes), STRIP):
        high = min(low + STRIP, len(hashes))
        bits = np.unpackbits(hashes[low:high].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # Texts with shingles in this strip, and where theirs begin in it.
        inside = np.flatnonzero((begin[:-1] < high) & (begin[1:] > low) & (np.diff(begin) > 0))
        sums[inside] += np.add.reduceat(bits, np.maximum(begin[inside], low) - low, axis=0, dtype=np.int64)
    ones = sums * 2 > np.diff(begin)[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """``doc_id, print`` (the fingerprint's bits as a long) of every row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column(1)):
                prints = majority(*shingle_hashes(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(prints.view(np.int64))], ["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(sketch, "doc_id long, print long")


def bits() -> list[Column]:
    return [F.lit(1 << b if b < BITS - 1 else -(1 << b)).cast("long") for b in range(BITS)]


def ball_links(prints: DataFrame) -> DataFrame:
    """``a, b``: links that connect the fingerprints of ``prints`` (``print``, distinct) as all links do, ``a < b``."""
    turned = prints.select("print", F.explode(F.array(F.lit(0).cast("long"), *bits())).alias("turn"))
    met = turned.select(F.col("print").bitwiseXOR(F.col("turn")).alias("variant"), "turn").groupBy("variant")
    met = met.agg(F.bit_or("turn").alias("mask"), F.bool_or(F.col("turn") == 0).alias("whole"))
    several = met.where(F.bit_count("mask") + F.col("whole").cast("int") > 1)
    turns = F.concat(F.when(F.col("whole"), F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<long>")), F.filter(F.array(*bits()), lambda b: b.bitwiseAND(F.col("mask")) != 0))
    members = several.select(F.transform(turns, lambda t: t.bitwiseXOR(F.col("variant"))).alias("members"))
    pairs = members.select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where(F.col("a") != F.col("b")).distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2 * HALF_RADIUS)


def simhash_rows(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    ``component_id`` is the smallest doc_id of the rows that links connect. Rows with a null text or without words have
    fingerprint zero and are linked like any other. Repeated rows are in one component. A null doc_id is never the
    smallest unless its component has no other; then component_id is null. Empty tables give no rows.
    """
    rows = stage(fingerprint_table(docs), "simhash-prints")
    # The smallest id of each fingerprint, so that one with any number of copies is one row in what follows.
    first = stage(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "simhash-first")
    parts = components(ball_links(first.select("print"))).withColumnRenamed("node", "print")
    named = first.join(parts, "print", "left").withColumn("component", F.coalesce("component", "print"))
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    found = named.join(lowest, "component").select("print", "component_id")
    text = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return rows.join(found, "print").select("doc_id", text.alias("fingerprint"), "component_id")
