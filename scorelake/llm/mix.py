"""Mixing sources to target weights: Efraimidis-Spirakis sampling with word budgets, in DataFrame functions only.

Sources share all words by their weights. A source whose target is above its size is read in complete epochs first; the
rest of its target is drawn without replacement: every document has the key ``-ln(u) / quality`` with ``u`` hashed from
its id and text, and the documents with the smallest keys are taken until their sizes, summed in this order, come to the
budget.

No source is sorted whole. Keys fall into ranges; sums by source and range say which range holds the budget's end, and
only that range is put in order. A source may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3
#: Key ranges of a source. The one that is sorted holds about this part of the source's documents.
RANGES = 4096
#: Copies of the table of sources in joins, so that one source's documents are spread over as many tasks.
SALTS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat_ws(":", doc_id.cast("string"), text))


def sample_key(digest: Column, weight: Column) -> Column:
    """Exponential variable with rate ``weight`` from a hexadecimal digest; reruns give the same."""
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + F.lit(0.5)) / F.lit(2.0**48)
    return -F.log(u) / weight


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_EPOCHS) -> DataFrame:
    """``source, source_size`` (one row a source) with ``target``.

    Sources by code point, null last, weigh ``weights``, repeating. All sizes are shared by weight; a target stops at
    ``most`` times its source's size, and the excess is shared again by weight. Sorted by ``cap / weight``, the capped
    sources come first, so one pass of running sums finds the level of the others. One row a source is all it reads.
    """
    by_name, by_room = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("room", F.col("source").asc_nulls_last())
    before, after = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    order = (F.row_number().over(by_name) - 1) % len(weights)
    return (
        sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (order + 1).cast("int")))
        .withColumn("room", most * F.col("source_size") / F.col("weight"))
        .withColumn("level", (F.sum("source_size").over(Window.partitionBy()) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after))
        .withColumn("target", F.least(most * F.col("source_size"), F.max(F.when(F.col("room") > F.col("level"), F.col("level"))).over(Window.partitionBy()) * F.col("weight")))
        .withColumn("target", F.coalesce("target", most * F.col("source_size")).cast("double"))
        .select("source", "source_size", "target")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, quality, tie`` with ``source_size, target, copies, taken``.

    ``copies`` is how often the mix takes the document: complete epochs, and once more if it is drawn. The draw ends
    with the document that brings the sum nearest to the budget. Documents without words are drawn only with the rest.
    Rows with the same id and text have the same key, and stand in any order. A null or non-positive quality counts as 1.
    """
    quality = F.when(F.col("quality") > 0, F.col("quality").cast("double")).otherwise(1.0)
    keyed = docs.withColumn("key", sample_key(F.col("tie"), quality))
    keyed = keyed.withColumn("range", F.floor(F.lit(RANGES) * -F.expm1(-F.col("key"))).cast("int"))
    keyed = stage(keyed.withColumn("salt", F.pmod(F.xxhash64("tie"), F.lit(SALTS)).cast("int")), "mix")
    ranges = keyed.groupBy("source", "range").agg(F.sum("size").alias("words"))
    sources = stage(
        source_targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")),
        "mix-sources",
    )
    sums = Window.partitionBy("source").orderBy("range")
    cut = (
        ranges.withColumn("until", F.sum("words").over(sums))
        .join(sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
        .groupBy("source")
        .agg(
            F.min(F.when(F.col("until") > F.col("budget"), F.struct("range", (F.col("until") - F.col("words")).alias("before")))).alias("cut"),
            *[F.first(c).alias(c) for c in ("source_size", "target", "epochs", "budget")],
        )
        .select(F.col("source").alias("name"), "source_size", "target", "epochs", "budget", F.coalesce("cut.range", F.lit(RANGES + 1)).alias("last"), "cut.before")
        .withColumn("name_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    known = keyed.join(cut, F.col("source").eqNullSafe(F.col("name")) & (F.col("salt") == F.col("name_salt"))).drop("name", "name_salt", "salt")
    inside = Window.partitionBy("source").orderBy("key", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, 0)
    edge = (
        known.where(F.col("range") == F.col("last"))
        .withColumn("until", F.col("before") + F.sum("size").over(inside))
        .withColumn("drawn", F.col("until") - F.col("size") / 2 <= F.col("budget"))
        .drop("until")
    )
    rest = known.where(F.col("range") != F.col("last")).withColumn("drawn", F.col("range") < F.col("last"))
    copies = (F.col("epochs") + F.col("drawn").cast("long")).cast("long")
    return (
        rest.unionByName(edge)
        .withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("key", "range", "epochs", "budget", "last", "before", "drawn")
    )


def quality_weight(labels: DataFrame) -> DataFrame:
    """One row a document: 1 for quality 1, 0.5 for quality 0; unlabelled documents have no row and count as 1."""
    labelled = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    best = F.max(F.col("quality").cast("double"))
    return labelled.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg((0.5 + 0.5 * F.least(best, F.lit(1.0))).alias("quality"))


def mix_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every row of ``docs``, repeated rows too.

    Size is the number of words (null text: 0). Empty table: no rows. A null doc_id has no label and keeps its row.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("tie"))
    weights = quality_weight(labels)
    return mixed(sized.join(weights, F.col("doc_id") == F.col("label_id"), "left").drop("label_id")).drop("tie", "quality")


def take_mix(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs`` that have words and are taken, once for each time (``epoch`` from 0)."""
    columns = [f"`{c}`" for c in docs.columns]
    row = docs.select(F.struct(*columns).alias("__row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("tie"))
    weights = quality_weight(labels)
    plan = mixed(row.drop("__row").join(weights, F.col("doc_id") == F.col("label_id"), "left").drop("label_id"))
    chosen = plan.where((F.col("copies") > 0) & (F.col("size") > 0)).groupBy("doc_id", "source", "tie").agg(F.max("copies").alias("copies"))
    on = [F.col(f"d.{c}").eqNullSafe(F.col(f"c.{c}")) for c in ("doc_id", "source", "tie")]
    joined = row.alias("d").join(chosen.alias("c"), on[0] & on[1] & on[2])
    return joined.select("__row.*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("epoch"))
