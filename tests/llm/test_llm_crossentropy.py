import math
from collections import Counter

import brute
import numpy as np
import pytest

from scorelake.llm import crossentropy as ce


def plain(rows, target):
    """rows: (doc_id, text) -> {doc_id: (tokens, target loss, background loss)} with dictionaries."""
    texts = [(i, brute.word_list(t)) for i, t in rows]
    words, own_words, pairs, own_pairs = Counter(), Counter(), Counter(), Counter()
    for i, w in texts:
        words.update(w)
        own_words.update(w if i in target else [])
    total = sum(words.values())
    known = {w for w, n in words.items() if n >= ce.WORD_SHARE * total}
    both = lambda w: [(a, b) for a, b in zip(w, w[1:]) if a in known and b in known]
    for i, w in texts:
        pairs.update(both(w))
        own_pairs.update(both(w) if i in target else [])
    table = {p for p, n in pairs.items() if n >= ce.PAIR_SHARE * total}

    def loss(w, words, pairs):
        size = sum(words.values())
        seen = {x: words[x] for x in known}
        rest = size - sum(seen.values())
        share = lambda x: (seen.get(x, rest) + ce.PSEUDO) / (size + ce.PSEUDO * (len(known) + 1))
        own = lambda p: ce.BIGRAM_WEIGHT * pairs[p] / max(1, seen[p[0]])
        left = Counter()
        for p in table:
            left[p[0]] += own(p)
        out = 0.0
        for k, x in enumerate(w):
            chance = share(x)
            if k:
                chance *= 1 - left[w[k - 1]]
                if (w[k - 1], x) in table:
                    chance += own((w[k - 1], x))
            out -= math.log(chance)
        return out / max(1, len(w))

    return {i: (len(w), loss(w, own_words, own_pairs), loss(w, words, pairs)) for i, w in texts}


@pytest.mark.parametrize("shares", [(1e-6, 5e-7), (2e-4, 1e-4)])
def test_whole_table(spark, docs, monkeypatch, shares):
    monkeypatch.setattr(ce, "WORD_SHARE", shares[0])
    monkeypatch.setattr(ce, "PAIR_SHARE", shares[1])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    target = {i for i, _ in rows if i % 3 == 0}
    got = {r.doc_id: r for r in ce.cross_entropy_rows(docs, spark.createDataFrame([(i,) for i in target], "doc_id long")).collect()}
    for i, (n, near, far) in plain(rows, target).items():
        r = got[i]
        assert (r.n_tokens, r.target_loss, r.background_loss) == (n, pytest.approx(near, rel=1e-9), pytest.approx(far, rel=1e-9))
        assert r.score == pytest.approx(r.target_loss - r.background_loss)


@pytest.mark.parametrize("texts", [
    [f"single{i} alone{i} once{i}" for i in range(30)],
    ["red green blue red"] * 30,
    ["red green blue red", "red green", "", None, "  ", "red"] * 4 + [f"red single{i}" for i in range(9)],
])
def test_singles_only_frequent_only_and_mixed(spark, monkeypatch, texts):
    monkeypatch.setattr(ce, "BUCKET_TOKENS", 16)
    rows = list(enumerate(texts))
    docs, target = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), {i for i, _ in rows if i % 2}
    got = {r.doc_id: r for r in ce.cross_entropy_rows(docs, spark.createDataFrame([(i,) for i in target], "doc_id long")).collect()}
    for i, (n, near, far) in plain(rows, target).items():
        assert (got[i].n_tokens, got[i].target_loss, got[i].background_loss) == (n, pytest.approx(near, rel=1e-9), pytest.approx(far, rel=1e-9))


def test_packing_round_trip():
    import numpy as np

    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2))
    for some in (keys, keys[:1], keys[:0], np.array([0, 2**64 - 1], dtype=np.uint64)):
        assert (ce.unpack_keys(ce.pack_keys(some), len(some)) == some).all()


def test_target_scores_lower(spark):
    rows = [(i, ("red green blue " if i % 2 else "one two three ") * 20) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.score for r in ce.cross_entropy_rows(docs, docs.where("doc_id < 20 AND doc_id % 2 = 1")).collect()}
    assert max(s for i, s in out.items() if i % 2) < min(s for i, s in out.items() if not i % 2)


def test_awkward(awkward, empty, labels):
    rows = ce.cross_entropy_rows(awkward, labels.where("quality = 1")).collect()
    assert len(rows) == awkward.count()
    assert all((r.n_tokens, r.score) == (0, 0) for r in rows if r.doc_id in (1, 2, 3))
    assert all(math.isfinite(r.score) for r in rows)
    assert all(math.isfinite(r.score) for r in ce.cross_entropy_rows(awkward, labels.where("quality = 7")).collect())
    assert ce.cross_entropy_rows(empty, labels).count() == 0


@pytest.mark.parametrize("sizes", [(8 << 20, 1 << 21), (1, 1 << 17)])
def test_rare_words_count_at_every_size(spark, monkeypatch, sizes):
    """A word that is less than a millionth of all tokens still tells its documents from others."""
    monkeypatch.setattr(ce, "UNIT_BYTES", sizes[0])
    monkeypatch.setattr(ce, "BUCKET_TOKENS", sizes[1])
    filler = " ".join(f"w{i % 50}" for i in range(60_000))
    rows = [(i, filler) for i in range(40)] + [(100, "rare seldom"), (101, "rare seldom"), (102, "scarce unusual"), (102, "scarce unusual")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    target = {0, 1, 2, 100}
    out = ce.cross_entropy_rows(docs, spark.createDataFrame([(i,) for i in target], "doc_id long")).collect()
    assert len(out) == len(rows)
    got, want = {r.doc_id: r for r in out}, plain([(i if k < 43 else 103, t) for k, (i, t) in enumerate(rows)], target)
    for i in (0, 100, 101, 102):
        assert (got[i].target_loss, got[i].background_loss) == (pytest.approx(want[i][1], rel=1e-9), pytest.approx(want[i][2], rel=1e-9))
    assert got[100].score < got[102].score


@pytest.mark.parametrize("keys", [[], [7], [3, 3, 1, 3], [(9 << 40) + 2, (9 << 40) + 1, 9 << 40, 1], [2**64 - 1, 0, 2**64 - 2, 2**63]])
def test_in_order(keys):
    """Also keys that differ in their low bits alone, which the packed sort leaves out."""
    keys = np.array(keys, dtype=np.uint64)
    order, ordered = ce.in_order(keys)
    assert (ordered == np.sort(keys)).all() and (keys[order] == ordered).all() and sorted(order) == list(range(len(keys)))
