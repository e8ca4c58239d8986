"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter trigram binds its letters' vectors, permuted by their place, by
multiplication; a text bundles the vectors of its trigrams by addition; so does a language with all its training texts.
A text gets the language whose prototype has the largest cosine.

Trigrams run over letters and word borders, any other run of characters being one border. Counts are whole numbers
throughout, so prototypes are the same on any partitioning.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.session import ship_by_value

DIMENSIONS = 512
LETTER_ROWS = 1024
BLOCK_TEXTS = 256
BLOCK_CHARS = 1 << 20
#: A text gives its trigrams this much weight in all, in whole parts, whatever its length.
TEXT_WEIGHT = 1 << 30
#: Trigrams whose vectors are made at a time.
STRIP = 4096
#: Alphabet cubes up to this size are counted by a table, larger ones by sorting.
CUBE = 1 << 22
#: Fewer trigrams do not show that a text is in no learned language.
LEAST_TRIGRAMS = 200

ship_by_value(__name__)


#: Whether a code point is a letter, as bits.
LETTERS = np.packbits(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool))


def letter_vectors(dimensions: int) -> np.ndarray:
    signs = np.random.default_rng(11).integers(0, 2, (LETTER_ROWS, dimensions), dtype=np.int8)
    return signs * 2 - 1


class Binder:
    """Vectors of trigrams and the trigrams of texts; made once in a task, for its tables."""

    def __init__(self, dimensions: int) -> None:
        self.third = letter_vectors(dimensions)
        self.second, self.first = np.roll(self.third, 1, axis=1), np.roll(self.third, 2, axis=1)
        self.letters = np.unpackbits(LETTERS, count=sys.maxunicode + 1).astype(bool)

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """Bound vector of each trigram code."""
        return self.first[codes >> 20] * self.second[(codes >> 10) & 1023] * self.third[codes & 1023]

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letter rows (0 for a border) of the lower-cased texts, borders merged, and each symbol's text."""
        low = [f" {t.lower()} " for t in texts]
        points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        owner = np.repeat(np.arange(len(low)), [len(t) for t in low])
        row = np.where(self.letters[points], 1 + points % (LETTER_ROWS - 1), 0).astype(np.int64)
        keep = np.ones(len(row), dtype=bool)
        keep[1:] = (row[1:] != 0) | (row[:-1] != 0) | (owner[1:] != owner[:-1])
        return row[keep], owner[keep]

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the trigrams that occur, and how often each text has each."""
        row, owner = self.symbols(texts)
        if len(row) < 3:
            return np.zeros(0, dtype=np.int64), np.zeros((len(texts), 0))
        whole = (owner[2:] == owner[:-2]) & (row[1:-1] != 0)
        used = np.flatnonzero(np.bincount(row, minlength=LETTER_ROWS))
        if len(used) ** 3 <= CUBE:
            narrow = np.zeros(LETTER_ROWS, dtype=np.int64)
            narrow[used] = np.arange(len(used))
            small = narrow[row]
            cell = ((small[:-2] * len(used) + small[1:-1]) * len(used) + small[2:])[whole]
            present = np.bincount(cell, minlength=len(used) ** 3) > 0
            place = np.cumsum(present) - 1
            at, cells = place[cell], np.flatnonzero(present)
            a, rest = np.divmod(cells, len(used) ** 2)
            b, c = np.divmod(rest, len(used))
            codes = (used[a] << 20) | (used[b] << 10) | used[c]
        else:
            codes, at = np.unique(((row[:-2] << 20) | (row[1:-1] << 10) | row[2:])[whole], return_inverse=True)
        size = max(1, len(codes))
        counts = np.bincount(owner[1:-1][whole] * size + at, minlength=len(texts) * size).reshape(len(texts), size)
        return codes, counts[:, : len(codes)]


def pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Consecutive texts of bounded number and, but for single long ones, bounded length."""
    first = chars = 0
    for i, t in enumerate(texts):
        if i > first and (i - first >= BLOCK_TEXTS or chars + len(t) > BLOCK_CHARS):
            yield first, i
            first, chars = i, 0
        chars += len(t)
    if first < len(texts):
        yield first, len(texts)


def bundled(binder: Binder, weights: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Weighted sums of trigram vectors, row by row of ``weights``: a strip of trigrams at a time, so that memory doesn't
    grow with the number of different ones. Sums of whole numbers below 2**53 are exact."""
    out = np.zeros((len(weights), binder.third.shape[1]))
    for at in range(0, len(codes), STRIP):
        out += weights[:, at : at + STRIP].astype(np.float64) @ binder.vectors(codes[at : at + STRIP]).astype(np.float64)
    return out


def whole_shares(counts: np.ndarray) -> np.ndarray:
    """``TEXT_WEIGHT`` of each row split by its counts: running totals are rounded down, so what rounding leaves goes on
    to the next trigram and all of it is given."""
    running = np.cumsum(counts, axis=1)
    return np.diff(running * TEXT_WEIGHT // np.maximum(1, running[:, -1:]), axis=1, prepend=0)


def fit_prototypes(rows: DataFrame, text: str, label: str, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Sum of the trigram vectors of all rows of each label, each text with the same weight.

    Every task returns one vector per label, so the driver gets labels x dimensions sums.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        binder, sums = Binder(dimensions), {}
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            names = batch.column(1).to_pylist()
            for first, end in pieces(texts):
                codes, counts = binder.counts(texts[first:end])
                if not len(codes):
                    continue
                weighted = whole_shares(counts)
                own = np.array(names[first:end], dtype=object)
                kinds = sorted(set(own))
                by_kind = np.stack([weighted[own == k].sum(axis=0) for k in kinds]).astype(np.float64)
                vectors = bundled(binder, by_kind, codes)
                for k, v in zip(kinds, vectors):
                    sums[k] = sums.get(k, 0) + v.astype(np.int64)
        for k, v in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * dimensions), pa.array(range(dimensions), pa.int32()), pa.array(v)],
                ["label", "place", "value"],
            )

    found = (
        rows.where(F.col(label).isNotNull() & F.col(text).isNotNull())
        .select(F.col(text).alias("text"), F.col(label).cast("string").alias("label"))
        .mapInArrow(partial, "label string, place int, value long")
        .groupBy("label", "place")
        .agg(F.sum("value").alias("value"))
        .toPandas()
    )
    out = {}
    for name, part in found.groupby("label"):
        vector = np.zeros(dimensions)
        vector[part["place"].to_numpy()] = part["value"].to_numpy()
        out[str(name)] = vector
    return out


def labeller(prototypes: dict[str, np.ndarray], dimensions: int = DIMENSIONS) -> Callable[[], Callable]:
    """Maker, once for each task, of a function from texts to language names, scores and numbers of trigrams.

    ``und`` with score 0 for a text that is null or has no letter, or if no language was learned; else the name with
    the largest cosine (the first of equal ones) and that cosine, 0 if it is below.
    """
    names = sorted(n for n, v in prototypes.items() if np.any(v))
    table = np.stack([prototypes[n] / np.linalg.norm(prototypes[n]) for n in names]) if names else None

    def make() -> Callable[[list], tuple[list[str], np.ndarray, np.ndarray]]:
        binder = Binder(dimensions)

        def label(column: list) -> tuple[list[str], np.ndarray, np.ndarray]:
            texts = [t or "" for t in column]
            found, scores, seen = np.full(len(texts), -1), np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
            for first, end in pieces(texts) if table is not None else ():
                codes, counts = binder.counts(texts[first:end])
                if not len(codes):
                    continue
                vectors = bundled(binder, counts, codes)
                cosine = (vectors @ table.T) / np.maximum(np.linalg.norm(vectors, axis=1), 1e-300)[:, None]
                seen[first:end] = counts.sum(axis=1)
                best, has = cosine.argmax(axis=1), seen[first:end] > 0
                found[first:end] = np.where(has, best, -1)
                scores[first:end] = np.where(has, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0)
            return [names[k] if k >= 0 else "und" for k in found], scores, seen

        return label

    return make


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(True))


def language_rows(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; learned on rows that are not held out.

    Rows are kept one to one, repeated ids too. Empty table: no rows. A null doc_id is held out. Other columns are not
    read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), 5, 0).alias("held_out"), "text", "lang")
    make = labeller(fit_prototypes(docs.where(~F.col("held_out")), "text", "lang", dimensions), dimensions)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = make()
        for batch in batches:
            names, scores, _ = label(batch.column(2).to_pylist())
            columns = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    types = "doc_id long, held_out boolean, lang_pred string, score double"
    return docs.select("doc_id", "held_out", "text").mapInArrow(predict, types)


def keep_languages(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """Rows, with all their columns, whose text reads as some learned language.

    Rejected are texts that are null or without letters, and those whose best cosine stays under what two unrelated
    random vectors reach (three standard deviations, 3 / sqrt(dimensions)): their letter sequences belong to no learned
    language. A text of under LEAST_TRIGRAMS trigrams is too short for that judgement and stays. Without any label
    nothing can be learned, and only texts without letters go.
    """
    prototypes = fit_prototypes(docs.where(~held_out(F.col("doc_id"), 5, 0)), "text", "lang", dimensions)
    if not any(np.any(v) for v in prototypes.values()):
        return docs.where(F.col("text").rlike(r"\p{L}"))
    make, at = labeller(prototypes, dimensions), docs.columns.index("text")
    floor = 3 / dimensions**0.5

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = make()
        for batch in batches:
            names, scores, seen = label(batch.column(at).to_pylist())
            known = (scores >= floor) | (seen < LEAST_TRIGRAMS)
            yield batch.filter(pa.array([n != "und" and bool(k) for n, k in zip(names, known)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
