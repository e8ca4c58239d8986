"""Ranked lexical search with bag deduplication.

What a document scores for any item depends only on how often it has each word of the item vocabulary and on its length
term m. So documents are restricted to that vocabulary first; those with the same counts and the same m are one class,
found by a hash and told apart by comparing the whole bag. Each class is scored once for all items. A class that is not
among the ``TOP`` best of an item, by score and by its smallest doc_id, has no document among the item's ``TOP`` best, as
each class before it puts a document before all of its own. So only those classes are expanded to their members, the
``TOP`` smallest doc_ids of each.

Items come in blocks of bounded size, so that a block's vocabulary and postings can be sent to every task; each block is
one pass over the documents. Whole numbers are 64-bit throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm.blocks import FOLD, Hasher, spans, text_blocks
from scorelake.session import ship_by_value, stage

TOP = 20
#: Bounds of a block of items, on average.
BLOCK_ITEMS, BLOCK_TEXT = 4096, 8 << 20
#: Words verified, and scores held and added, at a time.
STRIP, CELLS = 1 << 16, 1 << 21

#: Bytes of terms: digits, letters, and all of a character beyond ASCII.
TERM_BYTES = np.zeros(256, dtype=bool)
TERM_BYTES[48:58] = TERM_BYTES[65:91] = TERM_BYTES[97:123] = TERM_BYTES[128:] = True

ship_by_value(__name__)


class Vocabulary:
    """Distinct terms by hash, with their bytes."""

    def __init__(self, terms: list[bytes]) -> None:
        data, sizes = np.frombuffer(b"".join(terms), dtype=np.uint8), np.array([len(t) for t in terms], dtype=np.int64)
        ends = np.cumsum(sizes)
        hashes = Hasher().spans(data, ends - sizes, ends)
        order = np.argsort(hashes, kind="stable")
        self.data, self.starts, self.sizes, self.hashes, self.number = data, (ends - sizes)[order], sizes[order], hashes[order], order
        #: Most terms that share a hash.
        self.same = int(np.unique(hashes, return_counts=True)[1].max(initial=0))

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Number of the term that each span of ``data`` is, -1 if none. Every byte of what the hash finds is compared."""
        out = np.full(len(starts), -1, dtype=np.int64)
        first = np.searchsorted(self.hashes, hashes)
        for step in range(self.same):
            at = np.minimum(first + step, len(self.hashes) - 1)
            maybe = np.flatnonzero((self.hashes[at] == hashes) & (self.sizes[at] == ends - starts))
            for i in range(0, len(maybe), STRIP):
                own = maybe[i : i + STRIP]
                sizes = self.sizes[at[own]]
                begin = np.cumsum(sizes) - sizes
                within = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
                equal = FOLD[data[np.repeat(starts[own], sizes) + within]] == self.data[np.repeat(self.starts[at[own]], sizes) + within]
                fine = np.logical_and.reduceat(equal, begin)
                out[own[fine]] = self.number[at[own[fine]]]
        return out


def item_terms(texts: list[str | None]) -> list[list[bytes]]:
    """Terms of each text, repeats included."""
    out: list[list[bytes]] = [[] for _ in texts]
    for first, end, data, offsets in text_blocks(pa.array(texts, pa.string())):
        starts, ends, begin = spans(TERM_BYTES[data], offsets)
        plain = FOLD[data].tobytes()
        for d in range(end - first):
            out[first + d] = [plain[a:b] for a, b in zip(starts[begin[d] : begin[d + 1]].tolist(), ends[begin[d] : begin[d + 1]].tolist())]
    return out


def bag_table(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every row: number of terms, the vocabulary's terms among them in order, their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, known = Hasher(), shared.value
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column(1)):
                starts, ends, begin = spans(TERM_BYTES[data], offsets)
                found = known.find(data, starts, ends, hasher.spans(data, starts, ends))
                owner = np.repeat(np.arange(end - first), np.diff(begin))[found >= 0]
                keys, counts = np.unique(owner * len(known.hashes) + found[found >= 0], return_counts=True)
                cuts = pa.array(np.searchsorted(keys, np.arange(end - first + 1) * len(known.hashes)), pa.int32())
                lists = [pa.ListArray.from_arrays(cuts, pa.array(v.astype(np.int32))) for v in (keys % max(1, len(known.hashes)), counts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(np.diff(begin)), *lists], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(bags, "doc_id long, n long, terms array<int>, tfs array<int>")


class Postings:
    """For each term, the items that hold it with what one unit of the term's impact is worth in them."""

    def __init__(self, items: list[list[int]], weights: np.ndarray) -> None:
        item = np.repeat(np.arange(len(items)), [len(i) for i in items])
        keys, often = np.unique(np.array([t for i in items for t in i], dtype=np.int64) * max(1, len(items)) + item, return_counts=True)
        term, self.item = np.divmod(keys, max(1, len(items)))
        self.worth = often * weights[term]
        self.begin = np.searchsorted(term, np.arange(len(weights) + 1))
        self.items = len(items)


class Best:
    """The ``TOP`` best classes of each item so far: score, smallest doc_id, whether that is null, and class."""

    def __init__(self, items: int) -> None:
        self.rows = [np.zeros((4, 0), dtype=np.int64) for _ in range(items)]

    def take(self, item: int, scores: np.ndarray, low: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        held = self.rows[item]
        own = np.flatnonzero(scores >= max(1, held[0, -1] if held.shape[1] == TOP else 1))
        if len(own) > TOP:
            own = own[scores[own] >= np.partition(scores[own], -TOP)[-TOP]]
        if len(own):
            both = np.concatenate([held, np.stack([scores[own], low[own], null[own], ids[own]])], axis=1)
            self.rows[item] = both[:, np.lexsort((both[3], both[1], both[2], -both[0]))[:TOP]]


def best_classes(classes: DataFrame, postings: Postings) -> DataFrame:
    """``item, score, low, class_id``: each task's ``TOP`` best classes of each item, scores above 0."""
    shared = classes.sparkSession.sparkContext.broadcast(postings)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        best, most = Best(known.items), max(1, CELLS // known.items)
        for batch in batches:
            ids, m = (batch.column(c).to_numpy() for c in (0, 1))
            null = np.asarray(batch.column(2).is_null()).astype(np.int64)
            low = batch.column(2).fill_null(0).to_numpy()
            sizes = np.diff(batch.column(3).offsets.to_numpy())
            terms, tfs = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in (3, 4))
            owner = np.repeat(np.arange(len(ids)), sizes)
            impact = (1_000_000_000 * tfs) // (1000 * tfs + 12 * m[owner])
            fan = known.begin[terms + 1] - known.begin[terms]
            # Where each class begins among its terms, and how many postings come before it.
            begin = np.concatenate([[0], np.cumsum(sizes)])
            before = np.concatenate([[0], np.cumsum(fan)])[begin]
            i = 0
            while i < len(ids):
                j = min(max(i + 1, int(np.searchsorted(before, before[i] + CELLS, side="right")) - 1), i + most, len(ids))
                own = slice(begin[i], begin[j])
                reach = fan[own]
                at = np.repeat(known.begin[terms[own]] - np.cumsum(reach) + reach, reach) + np.arange(int(reach.sum()))
                scores = np.zeros((known.items, j - i), dtype=np.int64)
                np.add.at(scores.reshape(-1), known.item[at] * (j - i) + np.repeat(owner[own] - i, reach), known.worth[at] * np.repeat(impact[own], reach))
                for item in np.flatnonzero(scores.max(axis=1) > 0):
                    best.take(item, scores[item], low[i:j], null[i:j], ids[i:j])
                i = j
        for item, (scores, lows, nulls, own) in enumerate(best.rows):
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), item)), pa.array(scores), pa.array(lows, mask=nulls == 1), pa.array(own)], ["item", "score", "low", "class_id"])

    return classes.select("class_id", "m", "low", "terms", "tfs").mapInArrow(score, "item long, score long, low long, class_id long")


def first_rows(df: DataFrame, by: str, order: list, name: str = "rank") -> DataFrame:
    """The ``TOP`` first rows of each group, with their place; tasks leave out most others before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col(name) <= TOP)


def search_block(docs: DataFrame, rows: list[tuple[int | None, str | None]]) -> DataFrame | None:
    """Ranked documents of a block of items; None if no term of theirs is in any document."""
    spark = docs.sparkSession
    items = item_terms([text for _, text in rows])
    number = {t: i for i, t in enumerate(sorted({t for own in items for t in own}))}
    bags = stage(bag_table(docs, Vocabulary(list(number))), "bagsearch-bags")
    count, length = bags.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not number or not count:
        return None
    df = np.zeros(len(number), dtype=np.int64)
    # One row for each term of the block.
    for term, held in bags.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = held
    weights = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)

    m = F.expr(f"75 + (25 * CAST(n AS DECIMAL(20, 0)) * {count}) div {length}").alias("m")
    bags = bags.where(F.size("terms") > 0).select("doc_id", m, "terms", "tfs").withColumn("key", F.xxhash64("m", "terms", "tfs"))
    # Grouping by the key and the whole bag: what shares a hash only stays apart.
    same = ["key", "m", "terms", "tfs"]
    classes = bags.groupBy(*same).agg(F.min("doc_id").alias("low")).withColumn("class_id", F.monotonically_increasing_id())
    classes = stage(classes, "bagsearch-classes")
    found = best_classes(classes, Postings([[number[t] for t in own] for own in items], weights))
    chosen = first_rows(found, "item", [F.desc("score"), F.asc_nulls_last("low"), "class_id"]).select("item", "score", "class_id")
    chosen = stage(chosen, "bagsearch-chosen")
    wanted = classes.join(chosen.select("class_id").distinct(), "class_id", "left_semi").select("class_id", *same)
    members = first_rows(bags.join(wanted, same).select("class_id", "doc_id"), "class_id", [F.asc_nulls_last("doc_id")])
    ranked = first_rows(chosen.join(members.drop("rank"), "class_id"), "item", [F.desc("score"), F.asc_nulls_last("doc_id")])
    named = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(rows)], "item long, item_id long")
    return ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score: the ``TOP`` best documents of every row of ``items``, scores above 0.

    Equal scores go by ascending doc_id, a null one last; every row of ``docs`` is a document and every row of ``items``
    an item of its own, also if ids are null or repeated. A text that is null or without terms matches nothing. Empty
    tables give no rows.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text"))
    count, size = asked.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-count // BLOCK_ITEMS), -(-(size or 0) // BLOCK_TEXT))
    found = []
    for b in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        found.append(search_block(docs, [tuple(r) for r in own]))
    found = [f for f in found if f is not None]
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
