import random

import brute
import numpy as np
import pytest

from scorelake.llm import neardup
from scorelake.llm.components import components


def check(frame):
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(frame).collect()}
    assert got == brute.near_duplicates(rows)


def test_whole_table(docs):
    check(docs)


def test_copies_of_an_origin(spark, monkeypatch):
    """Copies near their origin and far from each other, in a family that is dealt to several blocks."""
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 16)
    rng = random.Random(4)
    origin = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(500, " ".join(origin))]
    for i in range(60):
        copy = list(origin)
        for _ in range(rng.randrange(4, 26)):
            copy[rng.randrange(400)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, f"alone {i} " * 30 + str(i)) for i in range(5)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))


def test_threshold_is_exact(spark):
    """Sets of 40 shingles: 6 new ones give 34/46 = 0.739, 5 give 35/45 = 0.778."""
    base = [f"a{i}" for i in range(44)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:39] + [f"b{i}" for i in range(5)])), (3, " ".join(base[:38] + [f"c{i}" for i in range(6)])), (4, " ".join(base[:30]))]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_awkward(awkward, empty):
    rows = neardup.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by = {r.doc_id: r for r in rows}
    assert all(by[i].n_shingles == 0 and by[i].component_id == i and by[i].kept for i in (1, 2, 3))
    assert by[4].n_shingles == 1 and by[6].component_id == 5 and not by[6].kept and by[7].component_id == 5
    assert {(r.component_id, r.kept) for r in rows if r.doc_id == 5} == {(5, True)}
    kept = neardup.keep_first(awkward)
    assert kept.columns == awkward.columns and 6 not in {r.doc_id for r in kept.collect()}
    assert neardup.near_duplicates(empty).count() == 0


def test_estimate():
    rng = np.random.default_rng(1)
    common, own = rng.integers(0, 2**63, 3000, dtype=np.uint64), rng.integers(0, 2**63, (2, 500), dtype=np.uint64)
    sets = [np.concatenate([common, o]) for o in own]
    sketch = neardup.registers(np.concatenate(sets), np.array([0, 3500, 7000]), neardup.register_seeds())
    merged = np.maximum(sketch[0], sketch[1])
    whole = np.unique(np.concatenate(sets))
    assert (merged == neardup.registers(whole, np.array([0, len(whole)]), neardup.register_seeds())[0]).all()
    got = neardup.overlap_estimate(sketch[:1], sketch[1:], np.array([3500.0]), np.array([3500.0]))[0]
    assert got == pytest.approx(0.75, abs=0.12)


def test_sketches_do_not_depend_on_partitioning(docs):
    tables = [{(r.doc_id, r.n, r["print"], bytes(r.sketch or b"")) for r in neardup.sketch_table(d).collect()} for d in (docs.coalesce(1), docs.repartition(7))]
    assert tables[0] == tables[1]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_every_family_of_a_bucket_has_a_leader(spark, monkeypatch):
    """Six unlike families of two in one bucket, dealt to several blocks: each pair is found."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 3)
    rng = random.Random(2)
    rows = []
    for family in range(6):
        words = [f"f{family}w{rng.randrange(10**6)}" for _ in range(200)]
        rows += [(2 * family, " ".join(words)), (2 * family + 1, " ".join(words + ["and one more"]))]
    table = neardup.stage(neardup.sketch_table(spark.createDataFrame(rows, "doc_id long, text string")), "test")
    classes = table.withColumn("keys", F.array(F.lit(7).cast("long")))
    ids = {r["print"]: r.doc_id for r in table.collect()}
    got = {r.node: r.component for r in components(neardup.likely_pairs(classes)).collect()}
    assert len(got) == 12 and all(ids[a] // 2 == ids[b] // 2 for a, b in got.items()) and len(set(got.values())) == 6


def test_one_of_each_group_stays_without_ids(spark):
    one, two, three = ("the quick brown fox jumps over a lazy dog " + w * 12 for w in ("near the river ", "by the old mill ", "on some far hill "))
    rows = [(1, one), (None, one), (None, one.upper()), (None, two), (None, two), (None, two + "x"), (None, None), (None, " "), (None, " "), (4, three), (4, three), (5, three), (None, "tiny")]
    frame = spark.createDataFrame([(*r, {"k": 1}) for r in rows], "doc_id long, text string, component map<string,int>").repartition(3)
    got = [(r.doc_id, (r.text or "").strip()[:60]) for r in neardup.keep_first(frame).collect()]
    assert sorted(i for i, _ in got if i) == [1, 4, 4]
    texts = sorted(t for i, t in got if i is None)
    assert texts == sorted(["", "", "", "tiny", two[:60]])
