"""Minority oversampling to parity by interpolating towards near minority rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from scorelake.operators.knn import HOT_ROWS, CellIndex, _vector, build_index, nearest
from scorelake.operators.ranks import not_after, rows_at_ranks
from scorelake.operators.split import hash60
from scorelake.session import stage


def _spread_join(many: DataFrame, few: DataFrame, on: str, row: str) -> DataFrame:
    """Inner join; a key that more than ``HOT_ROWS`` rows of ``many`` share is dealt to several tasks by ``row``."""
    shared = many.groupBy(on).count().filter(F.col("count") > HOT_ROWS)
    # At most one row for ``HOT_ROWS`` of ``many``.
    hot = F.broadcast(shared.select(on, F.ceil(F.col("count") / HOT_ROWS).cast("int").alias("_salts")))
    salt = F.coalesce(F.expr(f"pmod(xxhash64({row}), _salts)"), F.lit(0)).cast("int")
    dealt = many.join(hot, on, "left").withColumn("_salt", salt).drop("_salts")
    copies = few.join(hot, on, "left").withColumn("_salt", F.explode(F.expr("sequence(0, coalesce(_salts, 1) - 1)")))
    return dealt.join(copies.drop("_salts"), [on, "_salt"]).drop("_salt")


def _ranked(found: DataFrame) -> DataFrame:
    return found.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("rank", "donor"))).alias("near"))


def near_rows(minority: DataFrame, cols: Sequence[str], index: CellIndex, k: int) -> DataFrame:
    """Row ``rid`` and its k nearest other rows (``near``: rank and donor), nearest first, ties to the lower key.

    Equal rows have the same k + 1 nearest rows, themselves among them, so each different row asks once.
    """
    asked = minority.select("rid", _vector(cols).alias("q")).filter("rid is not null")
    again = stage(asked.groupBy("rid").count().filter("count > 1").select("rid"), "again")
    single = asked.join(again, "rid", "left_anti")
    unlike = stage(single.select("q").distinct().withColumn("qid", F.monotonically_increasing_id()), "unlike")
    found = nearest(unlike.select(F.col("qid").alias("rid"), "q"), index, k + 1, any_donor=True, keyed=False)
    answers = _ranked(found).withColumnRenamed("rid", "qid").join(unlike, "qid").select("q", "near")
    own = F.filter("near", lambda e: ~e["donor"].eqNullSafe(F.col("rid")))
    near = _spread_join(single, stage(answers, "answers"), "q", "rid").select("rid", F.slice(own, 1, k).alias("near"))
    if not again.isEmpty():
        # Rows under one key share the nearest rows of all of them, none under that key.
        near = near.unionByName(_ranked(nearest(asked.join(again, "rid"), index, k, any_donor=True)))
    return near.filter(F.size("near") > 0)


def smote(
    df: DataFrame, cols: Sequence[str], row_id: str, label: str = "label", k: int = 5, seed: int = 42
) -> DataFrame:
    """All rows plus synthetic minority rows; adds ``copy`` (0 for real rows, 1.. for synthetic).

    Copies are spread evenly over the minority; neighbour and step come from a hash of the
    seed, the row and the copy number, so the result is repeatable. ``cols`` must be complete.
    """
    cols = list(cols)
    n = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    minor = min(n, key=lambda l: (n[l], -l))
    new = max(n.values()) - n[minor]
    real = df.select(row_id, label, *[F.col(c).cast("double").alias(c) for c in cols]).withColumn("copy", F.lit(0))
    k = min(k, n[minor] - 1)
    if new == 0 or k < 1:
        return real
    minority = stage(
        df.filter(F.col(label) == F.lit(minor)).select(F.col(row_id).cast("bigint").alias("rid"), *cols), "minority"
    )
    index = build_index(minority, cols, "rid")
    ranked = near_rows(minority, cols, index, k)

    each, extra = divmod(new, n[minor])
    keyed = minority.withColumn("_h", hash60(seed, "rid"))
    one_more = F.lit(0)
    if extra:
        bound = rows_at_ranks(keyed, "_h", "rid", {None: [extra]})[(None, extra)]
        one_more = not_after("_h", "rid", bound).cast("int")
    grown = stage(keyed.select("rid", *cols, (F.lit(each) + one_more).alias("_n")).filter("_n > 0").join(ranked, "rid"), "near")
    pick = F.get("near", (hash60(seed + 1, "rid", "copy") % F.size("near")).cast("int"))
    placed = grown.withColumn("copy", F.explode(F.expr("sequence(1, _n)"))).select(
        "rid", "copy", *cols, pick.getField("donor").alias("donor"),
        (hash60(seed + 2, "rid", "copy") / F.lit(float(2**60))).alias("u"),
    )
    other = minority.select(F.col("rid").alias("donor"), *[F.col(c).alias(f"_d_{c}") for c in cols])
    # Rows that very many equal have the same few near rows.
    made = _spread_join(placed, other, "donor", "rid, copy").select(
        F.col("rid").alias(row_id),
        F.lit(minor).cast(df.schema[label].dataType).alias(label),
        *[(F.col(c) + F.col("u") * (F.col(f"_d_{c}") - F.col(c))).alias(c) for c in cols],
        "copy",
    )
    return real.unionByName(made)
