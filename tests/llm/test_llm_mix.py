import brute
import oracle
import pytest
from pyspark.sql import functions as F

from scorelake.llm import mix, queries


def fill(sizes):
    """Targets by sharing again and again, as the rule is written."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped, target = set(), {}
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        target = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / sum(weight[x] for x in free) for s in order}
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_agrees_with_sql(spark, sf):
    assert oracle.diff(queries.op1_mix(spark, sf), oracle.connect(sf), queries.SQL["op1_mix"]) is None


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 2000, None: 5, "d": 1}, {"a": 0, "b": 0}, {"x": 7}, {chr(97 + i): (i * 37) % 101 for i in range(20)}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mix.source_targets(rows).collect()}
    assert got == pytest.approx(fill(sizes))


def test_awkward(awkward, labels):
    rows = mix.mix_documents(awkward, labels).collect()
    assert len(rows) == awkward.count()
    want = {(r.doc_id, r.text): len(brute.word_list(r.text)) for r in awkward.collect()}
    assert sorted(r.size for r in rows) == sorted(want[(r.doc_id, r.text)] for r in awkward.collect())
    assert all(0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in rows)
    again = mix.mix_documents(awkward.repartition(7), labels).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_near_target(spark, docs, no_labels):
    out = mix.mix_documents(docs, no_labels)
    by = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).collect()
    assert by and all(abs(r.taken - r.target) <= r.most for r in by)


def test_take(awkward, labels):
    plan = {(r.doc_id, r.source, r.size): r.copies for r in mix.mix_documents(awkward, labels).collect()}
    taken = mix.take_mix(awkward, labels)
    assert taken.columns == [*awkward.columns, "epoch"]
    assert all(len(brute.word_list(r.text)) > 0 for r in taken.collect())
    assert taken.where("doc_id = 4").count() == plan[(4, "b", 1)]


def test_empty(empty, no_labels):
    assert mix.mix_documents(empty, no_labels).count() == 0
    assert mix.take_mix(empty, no_labels).count() == 0
