"""Line dedup by distinct-site spread, in DataFrame functions.

For every line a HyperLogLog sketch of the sites it stands on is merged by aggregation. Lines whose estimate is near the
threshold get an exact distinct count. A line on at least ``SITES`` sites is boilerplate, and so, with ``long_copies``, is
one of at least ``LONG_WORDS`` words in two documents, be it of one site: it stays where it stands first (smallest
doc_id, then position) and goes everywhere else.

Texts are split once; what is counted and joined after that are narrow rows of line hashes. A line may stand in any
share of the documents: sketches and first places are pre-aggregated, and the join that marks its rows is by hash with
salted copies of the boilerplate table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.session import stage

#: Distinct sites that make a line boilerplate.
SITES = 2
#: A line of so many words is a passage.
LONG_WORDS = 50
#: Shorter lines (trimmed characters) are ordinary short sentences or list items.
LEAST_CHARS = 20
#: log2 of sketch buckets, and the relative error, four deviations, within which the exact count decides.
SKETCH_BITS = 10
MARGIN = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)
SALTS = 32


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """Hash of a trimmed line, null for lines that are too short to be judged."""
    plain = F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(F.length(plain) >= LEAST_CHARS, F.xxhash64(plain))


def is_long(line: Column) -> Column:
    """Whether the line has ``LONG_WORDS`` words; only lines of enough characters are split for that."""
    words = F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when(F.length(line) >= 2 * LONG_WORDS - 1, F.size(words) >= LONG_WORDS).otherwise(False)


def line_table(docs: DataFrame) -> DataFrame:
    """``doc_id, print, site, pos, line, long``: the lines that can be judged; ``print`` names the text. Documents without
    source share one site."""
    keys = F.transform(lines_of(F.col("text")), lambda x: F.struct(line_key(x).alias("line"), is_long(x).alias("long")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("print"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("site"), F.posexplode(keys).alias("pos", "at"))
    return rows.select("doc_id", "print", "site", "pos", "at.line", "at.long").where(F.col("line").isNotNull())


def boilerplate(lines: DataFrame, sites: int = SITES, long_copies: bool = False) -> DataFrame:
    """``line, sites, first`` of the lines on at least ``sites`` sites, and of long ones in two documents if ``long_copies``;
    ``first`` is the place that keeps the line."""
    found = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS)).alias("estimate"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "pos")).alias("first"),
        (F.bool_or("long") & (F.min("doc_id") < F.max("doc_id"))).alias("passage"),
    )
    passage = F.coalesce("passage", F.lit(False)) & F.lit(long_copies)
    spread = stage(found.withColumn("passage", passage).where((F.col("estimate") >= sites * (1 - MARGIN)) | F.col("passage")), "lines-spread")
    near = spread.where((F.col("estimate") <= sites * (1 + MARGIN)) & ~F.col("passage")).select("line")
    # Distinct pairs first, so that the join meets each (line, site) once.
    exact = lines.select("line", "site").distinct().join(near, "line", "left_semi").groupBy("line").agg(F.count("*").alias("exact"))
    counted = spread.join(exact, "line", "left").select("line", F.coalesce("exact", "estimate").alias("sites"), "first", "passage")
    return counted.where((F.col("sites") >= sites) | F.col("passage")).drop("passage")


def dropped_lines(docs: DataFrame, sites: int = SITES, long_copies: bool = False) -> DataFrame:
    """``doc_id, print, drops`` (places of the lines to remove from that text; the first place of a line is not among them)."""
    lines = stage(line_table(docs), "lines")
    common = boilerplate(lines, sites, long_copies).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = lines.select("doc_id", "print", "pos", "line", F.pmod(F.xxhash64("doc_id", "pos"), F.lit(SALTS)).cast("int").alias("salt"))
    hits = salted.where(F.col("doc_id").isNotNull()).join(common, ["line", "salt"])
    own = F.coalesce((F.col("first.doc_id") == F.col("doc_id")) & (F.col("first.pos") == F.col("pos")), F.lit(False))
    return hits.where(~own).groupBy("doc_id", "print").agg(F.collect_set("pos").alias("drops"))


def without_lines(text: Column, drops: Column) -> Column:
    """The text without the lines at the places in ``drops``; linear in the number of lines."""

    def rest(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drops)
        return F.array_join(F.transform(stay, lambda p: F.get(lines, p)), "\n")

    # Bound by a lambda, so that the text is split once and not once for each line.
    return F.when(drops.isNull() | text.isNull(), text).otherwise(F.get(F.transform(F.array(lines_of(text)), rest), 0))


def cleaned(docs: DataFrame, sites: int = SITES, long_copies: bool = False) -> DataFrame:
    """Rows of ``docs`` with all their columns; boilerplate lines are gone from ``text``, ``n_chars`` follows it.

    Texts without such lines, null and empty ones stay as they are; no row is dropped, repeated rows neither. Rows with
    the same doc_id are one document. Rows without doc_id count for the spread of lines but are not changed.
    """
    columns = docs.columns
    drops = dropped_lines(docs, sites, long_copies).select(F.col("doc_id").alias("__doc"), F.col("print").alias("__print"), F.col("drops").alias("__drops"))
    joined = docs.join(drops, (F.col("doc_id").cast("long") == F.col("__doc")) & (F.xxhash64("text") == F.col("__print")), "left")
    joined = joined.withColumn("text", without_lines(F.col("text"), F.col("__drops")))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        joined = joined.withColumn("n_chars", F.when(F.col("__drops").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return joined.select(*[F.col(f"`{c}`") for c in columns])


def line_rows(docs: DataFrame, sites: int = SITES, long_copies: bool = False) -> DataFrame:
    """doc_id, cleaned text, n_lines before and n_removed of every row."""
    kept = docs.select("doc_id", "source", "text", F.col("text").alias("__before"))
    count = lambda c: F.coalesce(F.size(lines_of(F.col(c))), F.lit(0))
    out = cleaned(kept, sites, long_copies)
    before = F.when(F.col("__before").isNull(), 0).otherwise(count("__before"))
    # A text of which every line went is empty; it would count as one empty line.
    after = F.when(F.col("text").isNull(), 0).when((F.col("text") == "") & (F.col("__before") != ""), 0).otherwise(count("text"))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "text", before.cast("long").alias("n_lines"), (before - after).cast("long").alias("n_removed"))
