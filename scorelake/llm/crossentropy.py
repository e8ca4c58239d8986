"""Cross-entropy difference: how much nearer a document is to a target corpus than to all documents.

Two interpolated bigram models, of the target documents and of all documents (the background), are matched: same order,
same smoothing, and one vocabulary and one set of bigrams for both. A document's score is the mean over its tokens of
the target model's loss less the background model's; the lower, the nearer to the target.

Counts cover all documents, and all words and bigrams count, however rare (``WORD_SHARE`` and ``PAIR_SHARE`` are 0 for
that; with larger ones, rarer words are one unknown word and rarer bigrams have no entry). A bigram without entry gets
its word's share of what its context has left, so each model sums to one.

Texts are packed into units of a few megabytes, in which words are numbers from then on. A unit counts its distinct words
and bigrams once and sends each to the bucket of its hash, as sorted 64-bit keys whose differences are packed; a bucket
adds up what all units sent and answers each unit with the sums, in the order of its keys. So nothing is sent for each
token, a frequent word is one entry a unit, and the keys themselves travel once. Units then score their texts, in double
precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.blocks import Hasher, bitmap, in_bitmap, mix, text_blocks
from scorelake.session import ship_by_value, stage

#: Least shares of all tokens of the words and bigrams that are told apart.
WORD_SHARE, PAIR_SHARE = 0.0, 0.0
#: Weight of a context's own counts, and what every word has been seen more than it was.
BIGRAM_WEIGHT, PSEUDO = 0.6, 0.5
#: Bytes of text in a unit (a longer text is one of its own), and tokens for each bucket.
UNIT_BYTES, BUCKET_TOKENS = 8 << 20, 1 << 21
WORDS, PAIRS, FOLLOWED = 0, 1, 2

ship_by_value(__name__)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as their lowest bytes, then the next ones, as far as the largest needs them; compressed."""
    values = values.astype("<u8")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(blob: bytes, size: int) -> np.ndarray:
    width = blob[0]
    planes = np.frombuffer(pa.decompress(blob[1:], size * width, codec="zstd", asbytes=True), dtype=np.uint8)
    out = np.zeros((size, 8), dtype=np.uint8)
    out[:, :width] = planes.reshape(width, size).T
    return out.view("<i8").reshape(size)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(blob: bytes, size: int) -> np.ndarray:
    return np.cumsum(unpack(blob, size).view(np.uint64), dtype=np.uint64)


def pair_keys(words: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Keys of bigrams, by the places of their words in ``words``."""
    return mix((words * np.uint64(0x9E3779B97F4A7C15))[before] + mix(words)[after])


def in_order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys in ascending order, and the keys so.

    High bits of a key with its place as the low bits are sorted directly, several times as fast as an indirect sort.
    Should keys differ in the bits left out alone, and come out of order by that, they are sorted indirectly.
    """
    low = np.uint64(max(1, len(keys).bit_length()))
    place = np.arange(len(keys), dtype=np.uint64)
    packed = np.sort((keys >> low << low) | place)
    order = (packed & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(keys)
        ordered = keys[order]
    return order, ordered


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, a place of each, and for each place the number of its key."""
    order, ordered = in_order(keys)
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    at = np.empty(len(keys), dtype=np.int64)
    at[order] = np.cumsum(new) - 1
    return ordered[new], order[new], at


def tally(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each is there."""
    ordered = np.sort(keys)
    begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), dtype=bool), ordered[1:] != ordered[:-1]]))
    return ordered[begin], np.diff(np.append(begin, len(keys)))


def marked(docs: DataFrame, target: DataFrame) -> tuple[DataFrame, Broadcast]:
    """``doc_id, text, own, key``: whether the row's doc_id is in ``target``; and a bit set of the target's ids.

    The bit set, of fixed size, tells most others from them, so that little more than the target's text is shuffled. Rows
    with a key are all rows, unmarked: those whose key is in the bit set are there a second time, marked and without key,
    and the pass that reads the text drops the first.
    """
    ids = target.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull()).distinct()
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(ids, F.xxhash64("doc_id")))

    @F.pandas_udf("boolean")
    def maybe(keys: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(bits.value, keys.to_numpy(dtype=np.int64).view(np.uint64)))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.where(F.col("doc_id").isNotNull() & maybe(F.xxhash64("doc_id"))).join(ids.withColumn("own", F.lit(True)).hint("shuffle_hash"), "doc_id", "left")
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id"))
    unmarked = rows.select("doc_id", "text", F.lit(False).alias("own"), key.alias("key"))
    return unmarked.union(found.select("doc_id", "text", F.coalesce("own", F.lit(False)).alias("own"), F.lit(None).cast("long").alias("key"))), bits


def units_of(rows: DataFrame, bits: Broadcast) -> DataFrame:
    """One row for each unit: ids, marks and numbers of words of its documents, its distinct words, and its text by them."""
    names = ["doc_id", "own", "sizes", "words", "n_words", "text", "tokens", "own_tokens"]
    kinds = [pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def units(table: pa.Table, hasher: Hasher) -> Iterator[pa.RecordBatch]:
        ids, texts, own = (table.column(c).combine_chunks() for c in range(3))
        for begin, end, data, offsets in text_blocks(texts, UNIT_BYTES):
            tokens, first = hasher.words(data, offsets)
            found, words = pd.factorize(tokens)
            order = np.argsort(words)
            place = np.empty(len(words), dtype=np.int64)
            place[order] = np.arange(len(words))
            sizes, marks = np.diff(first), own.slice(begin, end - begin)
            own_tokens = int(sizes[np.asarray(marks.to_pylist(), dtype=bool)].sum())
            row = (ids.slice(begin, end - begin).to_pylist(), marks.to_pylist(), pack(sizes), pack_keys(words[order]), len(words), pack(place[found]), len(tokens), own_tokens)
            yield record([row], names, kinds)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, parts, held = Hasher(), [], 0
        for batch in batches:
            keys = batch.column(3)
            twice = in_bitmap(bits.value, keys.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)) & keys.is_valid().to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(~twice))
            parts.append(batch)
            held += batch.nbytes
            if held >= UNIT_BYTES:
                yield from units(pa.Table.from_batches(parts), hasher)
                parts, held = [], 0
        if parts:
            yield from units(pa.Table.from_batches(parts), hasher)

    types = "doc_id array<long>, own array<boolean>, sizes binary, words binary, n_words long, text binary, tokens long, own_tokens long"
    return stage(rows.mapInArrow(gather, types).withColumn("unit", F.monotonically_increasing_id()), "crossentropy-units")


class Unit:
    """Distinct words and bigrams of a unit, in the order of their keys."""

    def __init__(self, row: dict) -> None:
        self.sizes = unpack(row["sizes"], len(row["own"]))
        self.own = np.repeat(np.asarray(row["own"], dtype=bool), self.sizes)
        self.words, self.word_at = unpack_keys(row["words"], row["n_words"]), unpack(row["text"], row["tokens"])
        #: Whether a token has one before it, and one after it, in its text.
        self.later, self.followed = np.ones(len(self.word_at), dtype=bool), np.ones(len(self.word_at), dtype=bool)
        ends = np.cumsum(self.sizes)[self.sizes > 0]
        self.later[ends - self.sizes[self.sizes > 0]] = False
        self.followed[ends - 1] = False
        self.keys = pair_keys(self.words, self.word_at[self.followed], self.word_at[self.later])

    def place_pairs(self) -> None:
        """Number of its bigram for each place, and the words of each bigram."""
        self.pairs, one, self.pair_at = distinct(self.keys)
        self.before, self.after = self.word_at[self.followed][one], self.word_at[self.later][one]

    def counts(self) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
        """Kind, keys and counts: of words in all and in target texts and where no word follows, of bigrams in both."""
        number = lambda at, chosen, size: np.bincount(at[chosen], minlength=size)
        w, last = len(self.words), ~self.followed
        yield WORDS, self.words, [np.bincount(self.word_at, minlength=w), number(self.word_at, self.own, w), number(self.word_at, last, w), number(self.word_at, last & self.own, w)]
        pairs, n = tally(self.keys)
        own_pairs, own_n = tally(self.keys[self.own[self.later]])
        own = np.zeros_like(n)
        own[np.searchsorted(pairs, own_pairs)] = own_n
        yield PAIRS, pairs, [n, own]


def parcels(unit: int, kind: int, keys: np.ndarray, counts: list[np.ndarray], buckets: int) -> Iterator[tuple]:
    """A unit's keys and counts, cut where the buckets of equal key ranges end."""
    at = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.append(np.flatnonzero(np.diff(at, prepend=np.uint64(buckets))), len(keys))
    for low, high in zip(cuts[:-1], cuts[1:]):
        yield kind, int(at[low]), unit, int(high - low), pack_keys(keys[low:high]), pack(np.concatenate([c[low:high] for c in counts]))


PARCEL = "kind int, bucket int, unit long, size int, keys binary, counts binary"
REPLY = "unit long, kind int, bucket int, size int, counts binary, kinds long, seen long, own_seen long"


def record(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def parcel_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    return record(rows, ["kind", "bucket", "unit", "size", "keys", "counts"], types)


def answered(sent: DataFrame, least: float) -> DataFrame:
    """For each parcel the sums over all units, in the order of its keys.

    One parcel of each bucket also says how many of its keys have ``least`` or more, and how often those are there.
    """

    widths = {WORDS: 4, PAIRS: 2, FOLLOWED: 2}

    def add(_: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [unpack_keys(r["keys"], r["size"]) for r in rows]
        width = widths[rows[0]["kind"]]
        counts = [unpack(r["counts"], width * r["size"]).reshape(width, r["size"]) for r in rows]
        _, _, at = distinct(np.concatenate(keys))
        sums = [np.bincount(at, np.concatenate([c[i] for c in counts])).astype(np.int64) for i in range(width)]
        often = sums[0] >= least
        about = (int(often.sum()), int(sums[0][often].sum()), int(sums[1][often].sum()))
        out, low = [], 0
        for r in rows:
            own = at[low : low + r["size"]]
            out.append((r["unit"], r["kind"], r["bucket"], r["size"], pack(np.concatenate([s[own] for s in sums])), *(about if not low else (0, 0, 0))))
            low += r["size"]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.Table.from_batches([record(out, ["unit", "kind", "bucket", "size", "counts", "kinds", "seen", "own_seen"], types)])

    return stage(sent.groupBy("kind", "bucket").applyInArrow(add, REPLY), "crossentropy-replies")


def reply(table: pa.Table, kind: int, width: int) -> np.ndarray:
    """The sums of one kind for a unit, in the order of its keys."""
    rows = sorted((r for r in table.to_pylist() if r["kind"] == kind), key=lambda r: r["bucket"])
    return np.concatenate([np.zeros((width, 0), dtype=np.int64), *(unpack(r["counts"], width * r["size"]).reshape(width, r["size"]) for r in rows)], axis=1)


def met(units: DataFrame, replies: DataFrame, work, types: str) -> DataFrame:
    """``work(unit row, replies)`` for each unit."""

    def each(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return work(left.to_pylist()[0], right)

    return units.groupBy("unit").cogroup(replies.select("unit", "kind", "bucket", "size", "counts").groupBy("unit")).applyInArrow(each, types)


def cross_entropy_rows(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss and score (their difference) of every row of ``docs``.

    Losses are means in nats. A text that is null or without words has 0 for all of them. Repeated rows count and are
    scored each; a null doc_id is in no target. Without target documents, or in an empty corpus, a model knows nothing
    and gives all words the same share.
    """
    units = units_of(*marked(docs, target))
    total, own_total = (int(v or 0) for v in units.agg(F.sum("tokens"), F.sum("own_tokens")).first())
    buckets = max(1, -(-total // BUCKET_TOKENS))
    word_least, pair_least = WORD_SHARE * total, PAIR_SHARE * total
    weight, pseudo = BIGRAM_WEIGHT, PSEUDO

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                for kind, keys, counts in Unit(row).counts():
                    yield parcel_batch(list(parcels(row["unit"], kind, keys, counts, buckets)))

    replies = answered(units.mapInArrow(send, PARCEL), word_least)
    about = replies.where(F.col("kind") == WORDS).agg(F.sum("kinds"), F.sum("seen"), F.sum("own_seen")).first()
    kinds, seen, own_seen = (int(v or 0) for v in about)

    def entries(unit: Unit, words: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        known = words[0] >= word_least
        return known[unit.before] & known[unit.after] & (pairs[0] >= pair_least)

    cut = bool(word_least or pair_least)
    if cut:
        # How often a word is followed by one that makes an entry: what units have of it is added up by word.
        def send_followed(row: dict, answers: pa.Table) -> pa.Table:
            unit = Unit(row)
            unit.place_pairs()
            there = entries(unit, reply(answers, WORDS, 4), reply(answers, PAIRS, 2))[unit.pair_at]
            at, own = unit.word_at[unit.followed], unit.own[unit.later]
            counts = [np.bincount(at[m], minlength=len(unit.words)) for m in (there, there & own)]
            return pa.Table.from_batches([parcel_batch(list(parcels(row["unit"], FOLLOWED, unit.words, counts, buckets)))])

        replies = replies.union(answered(met(units, replies, send_followed, PARCEL), 0))

    def score(row: dict, answers: pa.Table) -> pa.Table:
        unit = Unit(row)
        unit.place_pairs()
        words, pairs = reply(answers, WORDS, 4), reply(answers, PAIRS, 2)
        followed = reply(answers, FOLLOWED, 2) if cut else words[:2] - words[2:]
        known, used = words[0] >= word_least, entries(unit, words, pairs)
        losses = []
        for m, size, rest in ((1, own_total, own_total - own_seen), (0, total, total - seen)):
            share = (np.where(known, words[m], rest) + pseudo) / (size + pseudo * (kinds + 1))
            of = np.maximum(words[m], 1)
            left = np.where(known, 1 - weight * followed[m] / of, 1.0)
            chance = np.where(used, weight * pairs[m] / of[unit.before], 0.0) + left[unit.before] * share[unit.after]
            each = np.log(share)[unit.word_at]
            each[unit.later] = np.log(chance)[unit.pair_at]
            sums = np.bincount(np.repeat(np.arange(len(unit.sizes)), unit.sizes), each, len(unit.sizes))
            losses.append((0.0 - sums) / np.maximum(unit.sizes, 1))
        columns = [pa.array(row["doc_id"], pa.int64()), pa.array(unit.sizes.astype(np.int64)), *map(pa.array, losses), pa.array(losses[0] - losses[1])]
        return pa.table(columns, names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return met(units, replies, score, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")
