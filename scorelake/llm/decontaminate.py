"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders; runs of ``WINDOW`` template tokens of documents are hash-joined with
those of benchmark items. Windows that lie at the same distance belong to one alignment. Where an alignment covers
enough, the values behind its placeholders must map one to one from item to document: then the document holds the item,
as it is or re-parameterised. Many windows with unchanged values are a leak without that test.

A window of few literal tokens is matched by its values instead of its placeholders: it tells of exact copies only. Items
shorter than a window are one window of their own size, looked for in all documents from ``LEAST_LITERALS`` tokens on;
shorter ones are common phrases, so they match whole documents only.

A token is a run of letters, digits and non-ASCII bytes. A token with a digit is a number. A unit is a token of
``UNITS`` after a number. A name is a token within a sentence with a capital letter before a small one, so text in
capitals has none. All else counts lower-cased (ASCII and Latin-1 letters).

Only windows that can be in the benchmark leave a document's task, by a bit set of fixed size; the join after it is
exact, so that set may fill up with any size of benchmark without harm to the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.blocks import Hasher, bitmap, in_bitmap, mix, shingles, spans, text_blocks
from scorelake.session import ship_by_value, stage

WINDOW = 8
#: A window with fewer literal tokens says too little as a template.
LEAST_LITERALS = 4
#: An alignment is a leak from this many windows (13 tokens in a row), or from this share of the item's windows.
LEAST_WINDOWS, LEAST_SHARE = 6, 0.5
#: So many windows with unchanged values (23 tokens in a row) are a leak whatever the values elsewhere do.
LEAST_VERBATIM = 2 * WINDOW
UNITS = (
    "mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "l", "s", "ms", "min", "h", "hr", "hrs", "kb", "mb", "gb", "tb", "hz", "khz", "mhz", "ghz", "w", "kw", "mw", "v", "a", "j", "kj", "pa", "kpa", "bar", "c", "f", "k", "inch",
    "inches", "ft", "feet", "foot", "yd", "yards", "mile", "miles", "oz", "lb", "lbs", "pound", "pounds", "ton", "tons", "meter", "meters", "metre", "metres", "liter", "liters", "litre", "litres", "gram", "grams", "second", "seconds",
    "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "percent", "usd", "eur", "gbp", "dollar", "dollars", "euro", "euros", "cent", "cents", "degree", "degrees", "mph", "kmh",
)
NUMBER, NAME, UNIT = (np.uint64(k) for k in (0x6E756D, 0x6E616D65, 0x756E6974))

ship_by_value(__name__)

_BYTES = np.arange(256)
DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
UPPER = (_BYTES >= 65) & (_BYTES <= 90)
TOKEN = DIGIT | UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
LOWER = (_BYTES >= 97) & (_BYTES <= 122)
STOP = np.isin(_BYTES, [*b".!?:;\"()[]"])


def fold_latin(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with the capital letters of Latin-1 lower-cased."""
    capital = np.zeros(len(data), dtype=bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    return np.where(capital, data + np.uint8(32), data)


class Templates:
    """Windows of texts; made once in a task, for its tables."""

    def __init__(self) -> None:
        self.hasher = Hasher()
        data = np.frombuffer(" ".join(UNITS).encode(), dtype=np.uint8)
        self.units = np.sort(self.hasher.words(data, np.array([0, len(data)]))[0])

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Literal hashes, template hashes, whether literal, and where each text's tokens begin."""
        data = fold_latin(data)
        starts, ends, first = spans(TOKEN[data], offsets)
        plain = self.hasher.spans(data, starts, ends)
        if not len(plain):
            return plain, plain, np.zeros(0, dtype=bool), first
        digits = np.concatenate([[0], np.cumsum(DIGIT[data])])
        stops = np.concatenate([[0], np.cumsum(STOP[data])])
        number = digits[ends] > digits[starts]
        opening = np.ones(len(starts), dtype=bool)
        opening[1:] = stops[starts[1:]] > stops[ends[:-1]]
        opening[first[:-1][first[:-1] < len(starts)]] = True
        second = data[np.minimum(starts + 1, len(data) - 1)]
        name = UPPER[data[starts]] & LOWER[second] & (ends > starts + 1) & ~opening & ~number
        unit = np.zeros(len(starts), dtype=bool)
        at = np.minimum(np.searchsorted(self.units, plain), len(self.units) - 1)
        unit[1:] = number[:-1] & ~opening[1:] & (self.units[at] == plain)[1:]
        template = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, plain)))
        return plain, template, ~(number | unit | name), first

    def windows(self, data: np.ndarray, offsets: np.ndarray, sizes: list[int], whole: bool) -> Iterator[tuple[np.ndarray, ...]]:
        """For each size: text, position and hash of every window, its size, whether it is matched as a template, and its
        values. Sizes under ``WINDOW`` are those of short items; with ``whole``, they are cut from texts of that size only."""
        plain, template, literal, first = self.tokens(data, offsets)
        seen, tokens = np.concatenate([[0], np.cumsum(literal)]), np.diff(first)
        for size in (WINDOW, *sizes):
            fits = tokens == size if size < WINDOW and (whole or size < LEAST_LITERALS) else tokens >= size
            if not fits.any():
                continue
            hashes, at, begin = shingles(mix(template), first, size)
            exact = shingles(mix(plain), first, size)[0]
            owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
            own = fits[owner]
            owner, at, hashes, exact = owner[own], at[own], hashes[own], exact[own]
            strong = seen[at + size] - seen[at] >= min(LEAST_LITERALS, size)
            hashes = np.where(strong, hashes, exact)
            yield owner, at, hashes if size == WINDOW else mix(hashes + np.uint64(size)), size, strong, plain, literal, first


def window_rows(table: DataFrame, key: str, sizes: list[int], bits: np.ndarray | None) -> DataFrame:
    """``key, print, pos, window, strong, slots, size``: windows (those that ``bits`` lets through), whether they match as
    templates, and the values behind their placeholders in order (none for the others); ``print`` names the text."""
    shared = None if bits is None else table.sparkSession.sparkContext.broadcast(bits)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        for batch in batches:
            for begin, _, data, offsets in text_blocks(batch.column(2)):
                for owner, at, hashes, size, strong, plain, literal, first in templates.windows(data, offsets, sizes, shared is None):
                    if shared is not None:
                        hit = in_bitmap(shared.value, hashes)
                        owner, at, hashes, strong = owner[hit], at[hit], hashes[hit], strong[hit]
                    if not len(owner):
                        continue
                    slots = [plain[p : p + size][~literal[p : p + size] & s].view(np.int64) for p, s in zip(at, strong)]
                    ends = np.concatenate([[0], np.cumsum([len(v) for v in slots])])
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(slots)))
                    rows = pa.array(owner + begin)
                    columns = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(at - first[owner]), pa.array(hashes.view(np.int64)), pa.array(strong), lists, pa.array(np.full(len(at), size))]
                    yield pa.RecordBatch.from_arrays(columns, [key, "print", "pos", "window", "strong", "slots", "size"])

    types = f"{key} long, print long, pos long, window long, strong boolean, slots array<long>, size long"
    text = F.col("text").cast("string")
    return table.select(F.col(key).cast("long").alias(key), F.xxhash64(text).alias("print"), text.alias("text")).mapInArrow(cut, types)


def alignments(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, print, item_id, shift, windows, total, changed``: leaks, by how far the item is moved in the document.

    A group here is one item at one place of one text, so it has no more rows than the item has windows (times the
    repeated rows of a text); other rows of the same doc_id, or without one, don't mix into it.
    """
    items = stage(window_rows(benchmark, "item_id", list(range(1, WINDOW)), None), "decontaminate-items")
    sizes = sorted(r["size"] for r in items.where(F.col("size") < WINDOW).select("size").distinct().collect())
    bits = bitmap(items, F.col("window"))
    counts = items.groupBy("item_id", "print").agg(F.countDistinct("pos").alias("total"), F.countDistinct(F.when(F.col("strong"), F.col("pos"))).alias("strong_total"))
    counts = counts.select(F.col("item_id").alias("of"), F.col("print").alias("item_print"), "total", "strong_total")
    ours = items.select("item_id", F.col("print").alias("item_print"), F.col("pos").alias("item_pos"), "window", F.col("strong").alias("item_strong"), F.col("slots").alias("asked"))
    hits = window_rows(docs, "doc_id", sizes, bits).join(ours, "window")
    pairs = F.flatten(F.collect_set(F.arrays_zip("asked", "slots")))
    found = hits.groupBy("doc_id", "print", "item_id", "item_print", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.countDistinct("item_pos").alias("windows"),
        F.countDistinct(F.when(F.col("item_strong"), F.col("item_pos"))).alias("strong_windows"),
        F.countDistinct(F.when(F.col("asked") == F.col("slots"), F.col("item_pos"))).alias("verbatim"),
        F.array_distinct(pairs).alias("pairs"),
    )
    found = found.join(counts, found["item_id"].eqNullSafe(counts["of"]) & (found["item_print"] == counts["item_print"]))
    half = lambda part, total: F.col(part) >= F.col(total) * LEAST_SHARE
    enough = (F.col("windows") >= LEAST_WINDOWS) | half("windows", "total") | ((F.col("strong_total") > 0) & half("strong_windows", "strong_total"))
    size = F.size("pairs")
    one_to_one = (F.size(F.array_distinct(F.col("pairs.asked"))) == size) & (F.size(F.array_distinct(F.col("pairs.slots"))) == size)
    changed = F.exists("pairs", lambda p: p["asked"] != p["slots"])
    return found.where((enough & one_to_one) | (F.col("verbatim") >= LEAST_VERBATIM)).select("doc_id", "print", "item_id", "shift", "windows", "total", changed.alias("changed"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each doc_id with a leak: ``item_id`` (most windows, then smallest), ``windows``, ``items``, ``changed``
    (whether that item is re-parameterised)."""
    best = F.max(F.struct("windows", (-F.col("item_id")).alias("down"), "changed")).alias("best")
    found = alignments(docs, benchmark).groupBy("doc_id").agg(best, F.countDistinct("item_id").alias("items"))
    return found.select("doc_id", (-F.col("best.down")).alias("item_id"), F.col("best.windows").alias("windows"), "items", F.col("best.changed").alias("changed"))


def leak_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, item_id, windows, items, changed of every row of ``docs``, repeated rows too.

    Items of fewer than ``LEAST_LITERALS`` tokens match only a document of the same length; texts and items without tokens
    match nothing. Rows with the same doc_id share what any of them has; rows with a null doc_id too. Empty tables give
    no rows, or no leaks. Columns other than doc_id, item_id and text are not read.
    """
    found = leaks(docs, benchmark).withColumnRenamed("doc_id", "leak_id")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(found, F.col("doc_id").eqNullSafe(F.col("leak_id")), "left")
    return out.select("doc_id", F.col("leak_id").isNotNull() | F.col("items").isNotNull(), "item_id", F.coalesce("windows", F.lit(0)).alias("windows"), F.coalesce("items", F.lit(0)).alias("items"), F.coalesce("changed", F.lit(False)).alias("changed")).toDF("doc_id", "contaminated", "item_id", "windows", "items", "changed")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose own text holds no benchmark item.

    A row goes by its doc_id and its text, so others with the same doc_id, or also without one, stay if they are clean;
    repeated rows go together. Null and empty texts stay. Empty tables give no rows, or all of them.
    """
    found = alignments(docs, benchmark).select(F.col("doc_id").alias("__leak"), F.col("print").alias("__print")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__leak")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__print"))
    return docs.join(found, same, "left_anti")
