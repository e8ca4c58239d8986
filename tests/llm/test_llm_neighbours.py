import numpy as np
import pytest

from scorelake.llm import neighbours

KIND = "vec_id long, embedding array<float>, label int, score double, shard int"


def exact(rows, k=10, every=100):
    ids = np.array([i for i, _ in rows])
    data = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        far = np.sqrt(((data - data[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, far)) if i != q][:k]
        out[int(ids[q])] = [(int(ids[i]), far[i]) for i in order]
    return out


def found(frame, **more):
    out = {}
    for r in sorted(neighbours.nearest(frame, **more).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, 3) for i, v in rows], KIND)


def test_recall(spark, sf):
    frame = spark.read.parquet(f"{sf}/embeddings.parquet")
    want, got = exact([(r.vec_id, r.embedding) for r in frame.collect()]), found(frame)
    assert got.keys() == want.keys()
    hits = [len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / len(want[q]) for q in want]
    assert np.mean(hits) >= 0.9
    for q, pairs in got.items():
        scores = dict(want[q])
        assert all(s == pytest.approx(scores[v], rel=1e-12) for v, s in pairs if v in scores)


def test_every_code_within_the_radius_is_retrieved():
    codes = np.random.default_rng(2).integers(0, 256, (500, 8), dtype=np.uint8)
    index = neighbours.MultiIndex(codes)
    for radius in (0, 3, 9, 17, 26, 40, 64):
        for q in range(5):
            far = np.bitwise_count(codes ^ codes[q]).sum(axis=1)
            assert (index.within(codes[q], radius) == np.flatnonzero(far <= radius)).all()


def test_ties_and_few(spark):
    rows = [(i, [1.0, 0.0, 0.0]) for i in (0, 3, 1, 2)] + [(5, [0.0, 1.0, 0.0]), (100, [0.5, 0.5, 0.0])]
    assert found(table(spark, rows)) == {q: [(v, pytest.approx(s)) for v, s in p] for q, p in exact(rows).items()}
    assert len(found(table(spark, rows), k=3)[0]) == 3


def test_awkward(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(0, None), (200, [0.0, 0.0]), (300, [1.0, None]), (400, [nan, 1.0]), (500, [inf, 1.0]), (600, []), (700, [1.0, 2.0, 3.0])]
    good = [(100, [1.0, 2.0]), (100, [1.0, 2.0]), (1, [1.0, 2.5]), (2, [4.0, 2.0]), (None, [1.0, 2.0])]
    assert found(table(spark, bad + good)) == {100: [(1, 0.5), (2, 3.0)]}
    assert found(table(spark, bad)) == {} and found(table(spark, [])) == {}
    assert found(table(spark, [(100, [1.0, 2.0])])) == {}
