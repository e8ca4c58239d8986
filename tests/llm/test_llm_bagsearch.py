import math
import random
import re
from collections import Counter

import numpy as np
import oracle

from scorelake.llm import bagsearch, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def plain(docs, items, top=20):
    """docs, items: lists of (id, text) -> sorted (item_id, rank, doc_id, score)."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    count, length = sum(1 for _, b in bags if b), sum(b.total() for _, b in bags)
    held = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        ranked = []
        for doc, bag in bags:
            m = 75 + (25 * bag.total() * count) // length if length else 0
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * held[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m)) for t in terms(text) if bag[t])
            if score > 0:
                ranked.append((-score, doc is None, doc or 0, doc))
        out += [(item, k, r[3], -r[0]) for k, r in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out, key=repr)


def got(docs, items):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in bagsearch.search(docs, items).collect()), key=repr)


def check(spark, docs, items):
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")
    assert got(*frames) == plain(docs, items)


def test_whole_table(spark, docs, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert got(docs, items) == plain([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.select("item_id", "text").collect()])


def test_classes_with_many_members_and_ties(spark):
    """Copies, permutations and texts that differ outside the vocabulary only are one class, and ties go by doc_id."""
    rng = random.Random(5)
    ids = rng.sample(range(10_000), 300)
    texts = ["red fox", "fox red", "red fox unseen", "other fox red", "fox", "red red fox", "blue", "red fox blue", "none of them"]
    docs = [(i, rng.choice(texts)) for i in ids]
    check(spark, docs, [(1, "red fox"), (2, "fox fox"), (3, "blue red"), (4, "missing"), (5, ""), (6, None), (7, "Red, FOX! été 42")])


def test_blocks_and_strips(spark, monkeypatch):
    for name, value in (("BLOCK_ITEMS", 3), ("STRIP", 4), ("CELLS", 16)):
        monkeypatch.setattr(bagsearch, name, value)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(30)] + ["É", "é", "日本"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 25)))) for i in range(150)]
    check(spark, docs, [(i, " ".join(rng.choices(words, k=rng.randrange(0, 6)))) for i in range(11)])


def test_same_hash_is_told_apart():
    known = bagsearch.Vocabulary([b"one", b"two", b"six"])
    known.hashes[:] = 7
    known.same = 3
    data = np.frombuffer(b"TWO six ten one", dtype=np.uint8)
    starts = np.array([0, 4, 8, 12])
    assert known.find(data, starts, starts + 3, np.full(4, 7, dtype=np.uint64)).tolist() == [1, 2, -1, 0]


def test_awkward(spark, awkward, empty):
    items = spark.createDataFrame([(1, "quick Word"), (1, "quick Word"), (None, "fox word7"), (2, None), (3, "日本語 çà xxxx"), (4, "12345 seven")], "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    assert got(awkward, items.selectExpr("*", "1 AS n", "2 AS rank", "3 AS score")) == plain(docs, [tuple(r) for r in items.collect()])
    assert got(empty, items) == [] and got(awkward, items.limit(0)) == []


def test_whole_table_in_sql(spark, sf):
    assert oracle.diff(queries.op12_search(spark, sf), oracle.connect(sf), queries.SQL["op12_search"]) is None
