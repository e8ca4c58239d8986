import random
from collections import Counter

import brute
import xxhash

from scorelake.llm import simhash


def fingerprint(text):
    w = brute.word_list(text)
    own = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in own) > len(own))


def linked(prints):
    """{doc_id: fingerprint} -> {doc_id: smallest doc_id reachable}, by comparing all pairs."""
    ids, root = sorted(prints), {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def check(frame):
    prints = {r.doc_id: fingerprint(r.text) for r in frame.collect()}
    parts = linked(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_rows(frame).collect()}
    assert got == {i: (f"{prints[i]:016x}", parts[i]) for i in prints}


def test_whole_table(docs):
    check(docs)


def test_links_are_those_of_all_pairs(spark):
    """Random balls: chains of one and two turned bits, and neighbours at three, the sign bit among them."""
    rng = random.Random(3)
    prints = {0, 1 << 63, (1 << 63) | 1, 7, (1 << 64) - 1}
    for _ in range(40):
        at = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            prints.add(at)
            for _ in range(rng.randrange(1, 4)):
                at ^= 1 << rng.randrange(64)
    hub = rng.getrandbits(64)
    prints |= {hub} | {hub ^ (1 << b) for b in range(64)}
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    got = simhash.ball_links(spark.createDataFrame([(v,) for v in signed.values()], "print long")).collect()
    assert len(got) == len({(r.a, r.b) for r in got}) and all(r.a < r.b for r in got)
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 2 for r in got)
    found = Counter(linked(dict(zip(sorted(signed.values()), [v & (1 << 64) - 1 for v in sorted(signed.values())]))).values())
    from scorelake.llm.components import components

    parts = Counter(r.component for r in components(spark.createDataFrame(got, "a long, b long")).collect())
    assert parts == Counter({k: n for k, n in found.items() if n > 1})


def test_long_texts_in_strips(spark, monkeypatch):
    monkeypatch.setattr(simhash, "STRIP", 5)
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(rng.choice([0, 1, 2, 3, 4, 9, 40])))) for i in range(60)]
    check(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2))


def test_awkward(awkward, empty):
    rows = simhash.simhash_rows(awkward).collect()
    assert len(rows) == awkward.count()
    texts = [(r.doc_id, r.text) for r in awkward.collect()]
    assert Counter((r.doc_id, r.fingerprint) for r in rows) == Counter((i, f"{fingerprint(t):016x}") for i, t in texts)
    by = {r.doc_id: r for r in rows}
    assert by[1].component_id == by[2].component_id == by[3].component_id == 1 and by[1].fingerprint == "0" * 16
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    assert simhash.simhash_rows(empty).count() == 0


def test_only_null_ids(spark):
    rows = simhash.simhash_rows(spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id long, text string")).collect()
    assert [r.component_id for r in rows] == [None, None] and len({r.fingerprint for r in rows}) == 1
