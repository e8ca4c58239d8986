import hashlib
import math

import numpy as np
import oracle

from scorelake.llm import planes, queries


def plain(rows, k=planes.K, rounds=planes.ROUNDS):
    """rows: list of (vec_id, embedding) -> sorted result rows, by loops over whole numbers."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    mark = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest())
    centroids = [list(v) for _, v in sorted(kept, key=mark)[:k]]
    apart = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    assign = lambda: [min((apart(v, c), n) for n, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        near = assign()
        for n in range(len(centroids)):
            own = [v for (_, v), (_, m) in zip(kept, near) if m == n]
            if own:
                centroids[n] = [sum(c) // len(own) for c in zip(*own)]
    near = assign()
    sums = {n: sum(d for d, m in near if m == n) for _, n in near}
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    out = [(i, n, d, sums[n], sum(sums.values()), digest(centroids[n])) for (i, _), (d, n) in zip(kept, near)]
    return sorted(out, key=repr)


def got(frame, **kw):
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r[n] for n in names) for r in planes.cluster_rows(frame, **kw).collect()), key=repr)


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_popcounts_are_dot_products():
    rng = np.random.default_rng(2)
    for top in (1, 2, 300, planes.LIMIT):
        ours, theirs = rng.integers(-top - 1, top, (50, 64), endpoint=True), rng.integers(-5, 9, (7, 64))
        assert (planes.unpack(planes.pack(ours)) == ours).all()
        assert (planes.dots(planes.pack(ours), planes.pack(theirs)) == ours @ theirs.T).all()
        assert (planes.norms(planes.pack(ours)) == (ours * ours).sum(axis=1)).all()
    zero = np.zeros((3, 64), dtype=np.int64)
    assert planes.pack(zero).shape == (3, 1) and (planes.unpack(planes.pack(zero)) == 0).all()


def test_rows_of_unlike_widths_and_repeats(spark):
    rng = np.random.default_rng(6)
    base = [list(map(float, rng.normal(0, 10.0 ** (i % 5 - 2), 64))) for i in range(120)]
    rows = list(enumerate(base)) + [(200 + i, base[3]) for i in range(60)] + [(5, base[5]), (None, base[7])]
    rows += [(900, None), (901, base[0][:63]), (902, [None, *base[0][1:]]), (903, [float("nan"), *base[0][1:]]), (904, [float("-inf"), *base[0][1:]]), (905, []), (906, base[0] + [1.0])]
    frame = frame_of(spark, rows).repartition(7)
    assert got(frame, k=9, rounds=3) == plain(rows, 9, 3)
    assert got(frame.coalesce(1), k=9, rounds=3) == plain(rows, 9, 3)


def test_few_empty_and_vast(spark):
    few = [(3, [0.5] * 64), (1, [-0.001] * 64), (2, [0.5] * 64)]
    assert got(frame_of(spark, few)) == plain(few)
    assert got(frame_of(spark, [])) == []
    vast = got(frame_of(spark, [(1, [1e300] * 64), (2, [-1e300] * 64)]), k=1, rounds=0)
    assert vast[0][2] in (0, 64 * (2 * planes.LIMIT + 1) ** 2) and vast[1][2] <= (1 << 63) - 1


def test_extra_columns(spark):
    frame = frame_of(spark, [(i, [i / 7] * 64) for i in range(50)])
    wide = frame.selectExpr("*", "1 AS planes", "2 AS cluster", "'x' AS n", "3 AS sums")
    assert got(wide) == got(frame) == plain([tuple(r) for r in frame.collect()])


def test_whole_table_in_sql(spark, sf):
    assert oracle.diff(queries.op11_clusters(spark, sf), oracle.connect(sf), queries.SQL["op11_clusters"]) is None
