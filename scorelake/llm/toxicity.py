"""Toxicity from subword-bag embeddings under a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (3 to 6 bytes, word borders included), hashed into rows of one embedding
table; a misspelling shares most of them with the word it distorts. A window of words averages their embeddings, and a
linear softmax over two classes reads the average. Windows begin at every word. A text is as toxic as its most toxic
window, so a long text doesn't dilute a few words. In training, each text passes its error to that window only, after some rounds over whole texts.

As averaging is linear, each n-gram can be scored before the average: a fitted model ships as one number a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.blocks import FOLD, SPACES, text_blocks
from scorelake.llm.langid import held_out
from scorelake.session import ship_by_value

ROWS_BITS = 18
EMBEDDING = 16
SIZES = (3, 4, 5, 6)
WINDOW = 16
#: Bound of the training sample: so many texts of each class, by a hash of their ids, of at most so many characters.
SAMPLE, SAMPLE_CHARS = 1200, 60_000
WARM_ROUNDS, ROUNDS, RATE, MOMENTUM, SHRINK = 30, 100, 0.4, 0.9, 1e-5
HIDE = 0.3
#: An n-gram must be in so many sample texts to have a row.
LEAST_TEXTS = 4
THRESHOLD = 0.7
#: Large texts are scored in runs of so many bytes, cut between words.
RUN_BYTES = 1 << 19

ship_by_value(__name__)

BORDER = SPACES.copy()
BORDER[[*b".,;:?()\"'[]{}<>|/"]] = True
CODES = np.random.default_rng(23).integers(0, 1 << 32, 256, dtype=np.uint32)[FOLD] | np.uint32(1)
TURN = np.uint32(0x01000193)


class Grams:
    """N-grams of a run of text: table row and word of each, and which text each word is in."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        # A border before and after each text keeps n-grams within it.
        texts = len(offsets) - 1
        padded = np.full(len(data) + texts + 1, 32, dtype=np.uint8)
        padded[np.arange(len(data)) + 1 + np.repeat(np.arange(texts), np.diff(offsets))] = data
        border = BORDER[padded]
        padded[border] = 32
        begin = np.flatnonzero(~border[1:] & border[:-1]) + 1
        self.words = len(begin)
        self.owner = np.searchsorted(offsets + np.arange(texts + 1), begin - 1, side="right") - 1
        word = np.cumsum(np.concatenate([[False], ~border[1:] & border[:-1]])) - 1
        codes, seen = CODES[padded], np.concatenate([[0], np.cumsum(border)])
        self.parts = []
        value = codes
        for n in range(2, max(SIZES) + 1):
            value = value[: len(codes) - n + 1] * TURN + codes[n - 1 :]
            if n in SIZES and len(value):
                at = np.flatnonzero(seen[n - 1 : len(codes)] == seen[1 : len(codes) - n + 2])
                hashed = (value[at] ^ (value[at] >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                self.parts.append((hashed >> np.uint32(32 - ROWS_BITS), word[at + 1]))

        # The same word has the same sum: it names the word.
        self.names = sum((np.bincount(word, row * (1 + 0.37 * k), self.words) for k, (row, word) in enumerate(self.parts)), np.zeros(self.words))

    def word_means(self, scores: np.ndarray) -> np.ndarray:
        """Mean score of each word's n-grams."""
        total, count = np.zeros(self.words), np.zeros(self.words)
        for row, word in self.parts:
            total += np.bincount(word, scores[row], self.words)
            count += np.bincount(word, minlength=self.words)
        return total / np.maximum(count, 1)


class Windows:
    """Windows of ``WINDOW`` words of one text, one from each word on; a text with fewer words has one, of all its words.

    ``begin`` and ``text`` have each window's first word and its text. In its average each word weighs 1 / WINDOW, and
    nothing where the window has had the word already: a word said over and over says no more than said once, and a
    short text is averaged as if padded.
    """

    def __init__(self, owner: np.ndarray, names: np.ndarray, texts: int) -> None:
        first = np.searchsorted(owner, np.arange(texts + 1))
        place = np.arange(len(owner))
        last = np.maximum(first[1:] - WINDOW, first[:-1])
        self.begin = np.flatnonzero(place <= last[owner])
        self.text = owner[self.begin]
        order = np.lexsort((place, names, owner))
        before = np.full(len(owner), -1)
        again = np.flatnonzero((names[order[1:]] == names[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]]))
        before[order[again + 1]] = order[again]
        # The windows, as running numbers, that count a word: those that reach it and begin after it was said before.
        low = np.maximum(np.maximum(place - WINDOW, before) + 1, first[owner])
        high = np.minimum(place, last[owner]) + 1
        rank = np.concatenate([[0], np.cumsum(place <= last[owner])])
        self.low, self.high = rank[np.minimum(low, high)], rank[high]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Weighted sum of word values in each window."""
        steps = np.bincount(self.low, values, len(self.begin) + 1) - np.bincount(self.high, values, len(self.begin) + 1)
        return np.cumsum(steps)[:-1] / WINDOW

    def spread(self, values: np.ndarray) -> np.ndarray:
        """What each word gets from the windows that count it, by its weight."""
        total = np.concatenate([[0], np.cumsum(values)])
        return (total[self.high] - total[self.low]) / WINDOW


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class Bags:
    """Training texts as windows of words, each distinct word kept once as its bag of n-grams.

    Texts are read in runs, so memory follows the distinct words, not the text.
    """

    def __init__(self, texts: list[str]) -> None:
        raw = [t.encode("utf-8", "replace") for t in texts]
        names, owners, rows, bags = [], [], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        held, known, count, first = np.zeros(1 << ROWS_BITS, dtype=np.int64), np.zeros(0), 0, 0
        while first < len(raw):
            end, size = first, 0
            while end < len(raw) and (end == first or size + len(raw[end]) <= RUN_BYTES):
                size, end = size + len(raw[end]), end + 1
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw[first:end]])]).astype(np.int64)
            grams = Grams(np.frombuffer(b"".join(raw[first:end]), dtype=np.uint8), offsets)
            names.append(grams.names)
            owners.append(grams.owner + first)
            seen = [np.unique(r.astype(np.int64) * (end - first) + grams.owner[w]) for r, w in grams.parts]
            held += np.bincount(np.unique(np.concatenate(seen or [known.astype(np.int64)])) // (end - first), minlength=len(held))
            distinct, at = np.unique(grams.names, return_index=True)
            new = ~np.isin(distinct, known)
            place = np.full(grams.words, -1, dtype=np.int64)
            place[at[new]] = count + np.arange(new.sum())
            for row, word in grams.parts:
                mine = place[word] >= 0
                rows.append(row[mine].astype(np.int64))
                bags.append(place[word[mine]])
            known, count, first = np.concatenate([known, distinct[new]]), count + int(new.sum()), end
        order = np.argsort(known)
        names = np.concatenate(names or [known])
        self.kind = order[np.searchsorted(known[order], names)] if count else np.zeros(0, dtype=np.int64)
        self.owner = np.concatenate(owners or [order])
        self.rows, self.bag = np.concatenate(rows), np.concatenate(bags)
        self.sizes = np.bincount(self.bag, minlength=count)
        self.windows = Windows(self.owner, names, len(texts))
        # N-grams in too few texts have no row; they keep their share of a bag, with nothing in it.
        kept = held[self.rows] >= LEAST_TEXTS
        self.used, self.rows = np.unique(self.rows[kept], return_inverse=True)
        self.bag = self.bag[kept]


def fit(texts: list[str], toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Score of every n-gram row, and the bias: embedding table and two-class softmax, trained together.

    Full batches; both classes weigh the same. One step size holds for a whole tensor, so that common n-grams move most
    and rare ones can't be learned by heart.
    """
    bags = Bags(texts)
    random = np.random.default_rng(3)
    table = random.uniform(-1, 1, (len(bags.used), EMBEDDING)) / EMBEDDING
    weights, bias = random.uniform(-1, 1, (2, EMBEDDING)) / EMBEDDING, np.zeros(2)
    share = 1 / np.maximum(bags.sizes, 1)
    owner = bags.windows.text
    in_text = np.bincount(owner, minlength=len(texts))
    filled = in_text > 0
    heads = np.flatnonzero(np.diff(np.concatenate([[-1], owner])))
    # Neighbouring windows share most words, so they are hidden by runs.
    run = (np.arange(len(owner)) - heads[np.cumsum(np.isin(np.arange(len(owner)), heads)) - 1]) // WINDOW if len(owner) else owner
    run = np.cumsum(np.concatenate([[False], (run[1:] != run[:-1]) | (owner[1:] != owner[:-1])])) if len(owner) else run
    cost = np.where(toxic == 1, 0.5 / max(1, (toxic == 1).sum()), 0.5 / max(1, (toxic == 0).sum()))
    past = [(np.zeros_like(v), [0.0]) for v in (table, weights, bias)]
    logit = np.zeros(len(texts))
    for turn in range(WARM_ROUNDS + ROUNDS):
        way = weights[1] - weights[0]
        by_word = np.bincount(bags.bag, (table @ way)[bags.rows], len(share)) * share
        sums = bags.windows.sums(by_word[bags.kind])
        logit = np.zeros(len(texts))
        if turn < WARM_ROUNDS:
            part = 1 / in_text[owner]
            logit = np.bincount(owner, sums * part, len(texts))
        else:
            # Some windows are hidden in turn, so that each toxic word has to tell for itself now and then.
            hidden = random.random(int(run[-1]) + 1 if len(run) else 0) < HIDE
            visible = np.where(hidden[run] & (turn < WARM_ROUNDS + ROUNDS - 1), -np.inf, sums)
            logit[filled] = np.maximum.reduceat(visible, heads) if len(heads) else 0
            logit[np.isinf(logit)] = 0
            top = visible == logit[owner]
            part = top / np.maximum(np.bincount(owner, top, len(texts))[owner], 1)
        error = cost * (sigmoid(logit + bias[1] - bias[0]) - toxic)
        pull = bags.windows.spread(error[owner] * part)
        by_kind = np.bincount(bags.kind, pull, len(share)) * share
        by_row = np.bincount(bags.rows, by_kind[bags.bag], len(table))
        slope = by_row @ table
        steps = [np.outer(by_row, way) + SHRINK * table / max(1, len(table)), np.stack([-slope, slope]) + SHRINK * weights, np.array([-error.sum(), error.sum()])]
        for value, step, (mean, size) in zip((table, weights, bias), steps, past):
            mean *= MOMENTUM
            mean += (1 - MOMENTUM) * step
            size[0] = max(size[0] * MOMENTUM, float(np.sqrt((step**2).max(initial=0))))
            value -= RATE * mean / max(size[0], 1e-12)
    # The threshold comes to lie midway between clean texts' highest and toxic texts' lowest scores.
    margin = logit + bias[1] - bias[0]
    middle = (np.quantile(margin[toxic == 0], 0.999) + np.quantile(margin[toxic == 1], 0.01)) / 2
    scores = np.zeros(1 << ROWS_BITS, dtype=np.float32)
    scores[bags.used] = table @ (weights[1] - weights[0])
    return scores, float(bias[1] - bias[0] + np.log(THRESHOLD / (1 - THRESHOLD)) - middle)


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``label_id, text, toxic`` of at most ``SAMPLE`` labelled texts of each class, not held out; a text with both
    labels counts as toxic."""
    ids = F.col("doc_id").cast("long")
    known = labels.where(F.col("toxic").isin(0, 1) & ids.isNotNull()).groupBy(ids.alias("label_id")).agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out(F.col("label_id"), 3, 1))
    texts = docs.where(F.length("text") <= SAMPLE_CHARS).select(ids.alias("label_id"), F.col("text").cast("string").alias("text"))
    ranked = known.join(texts.select("label_id").distinct(), "label_id", "left_semi")
    chosen = [ranked.where(F.col("toxic") == k).orderBy(F.xxhash64("label_id"), "label_id").limit(SAMPLE) for k in (0, 1)]
    rows = texts.join(F.broadcast(chosen[0].union(chosen[1])), "label_id")
    return rows.groupBy("label_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def fitted(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Scores and bias, learned from the bounded sample in one task; the driver gets a megabyte."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: r[0])
        toxic = np.array([r[2] for r in rows], dtype=np.float64)
        if len(set(toxic)) == 2:
            scores, bias = fit([r[1] for r in rows], toxic)
        else:
            scores, bias = np.zeros(1 << ROWS_BITS, dtype=np.float32), 9.0 * (2 * float(toxic[0]) - 1) if len(toxic) else 0.0
        yield pa.RecordBatch.from_arrays([pa.array([scores.tobytes()], pa.binary()), pa.array([bias])], ["scores", "bias"])

    row = training_sample(docs, labels).select("label_id", "text", "toxic").repartition(1).mapInArrow(train, "scores binary, bias double").first()
    if row is None:
        return np.zeros(1 << ROWS_BITS, dtype=np.float32), 0.0
    return np.frombuffer(bytes(row.scores), dtype=np.float32), row.bias


def runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Parts of a block's bytes; a long text is cut between words into parts of its own."""
    if len(data) <= 2 * RUN_BYTES or len(offsets) > 2:
        yield data, offsets
        return
    at = 0
    while at < len(data):
        end = min(len(data), at + RUN_BYTES)
        gaps = np.flatnonzero(SPACES[data[end:]][: 1 << 16]) if end < len(data) else []
        end = end + int(gaps[0]) if len(gaps) else (len(data) if end == len(data) or len(data) - end < (1 << 16) else end + (1 << 16))
        yield data[at:end], np.array([0, end - at])
        at = end


def highest(parts: Iterator[tuple[np.ndarray, np.ndarray]], texts: int, table: np.ndarray) -> np.ndarray:
    """Sum of each text's most toxic window, 0 without words. Parts of a long text overlap by all but one word of a window."""
    top, held = np.full(texts, -np.inf), [np.zeros(0), np.zeros(0), np.zeros(0, dtype=np.int64)]
    seen = 0
    for part, cuts in parts:
        grams = Grams(part, cuts)
        seen += grams.words
        values, names, owner = (np.concatenate(p) for p in zip(held, (grams.word_means(table), grams.names, grams.owner)))
        held = [values, names, owner]
        # One text alone may go on in another part; windows need all their words.
        if texts > 1 or len(values) >= WINDOW:
            windows = Windows(owner, names, texts)
            np.maximum.at(top, windows.text, windows.sums(values))
            held = [v[max(0, len(v) - WINDOW + 1) :] for v in held]
    if texts == 1 and 0 < seen < WINDOW:
        windows = Windows(held[2], held[1], 1)
        top[0] = windows.sums(held[0]).max()
    return np.where(np.isinf(top), 0, top)


def score_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``, repeated rows too.

    Learned from labelled rows that are not held out; ids, labels, lang and source are not inputs. A text that is null
    or has no word gets what the bias alone says. With labels of one class only, or none, every score is that class's
    share (0.5 without labels). A null doc_id is held out.
    """
    weights, bias = fitted(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for first, end, data, offsets in text_blocks(batch.column(2), RUN_BYTES):
                out[first:end] = highest(runs(data, offsets), end - first, table)
            scores = sigmoid(out + bias)
            columns = [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), 3, 1).alias("held_out"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
