import hashlib
import time
from itertools import accumulate

import brute
import pytest
from pyspark.sql import functions as F

from scorelake.llm import pii

TEXTS = [
    None, "", "a@b.c_d@e.f x@y@z.com a..b@c-d.e.f.", "@b.com a@ a@b a@b. a@b.c-", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2.3 ..1.1.1.1.. 0000255.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 41111111111111112 4111111111111112 4012888888881881", "12345678901234567890 4111 1111 1111 1111 9", "+1 (527) 555-9774, +1234567890 +12 +1234567890123456 +1 2.3-4(5)6 7890--",
    "++1 555 123 4567+33 1 23 45 67 89 ", "éà 😀 jo@x.org 😀 10.0.0.1", "5" * 3000 + ".1.1.1", "a" * 50_000 + "@" + "b" * 50_000, "+" + "1-" * 5000, "1 " * 20_000, "x@y.z " * 300,
]


def base_only(row):
    return row.n_email, row.n_ip, row.n_card, row.n_phone, row.base_sha256


def expected(text):
    spans = brute.personal_spans(text)
    joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
    return (*[sum(s[2] == k for s in spans) for k in pii.KINDS], hashlib.sha256(joined.encode()).hexdigest())


def test_base_spans(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, spans string, base int")
    rows = {r.doc_id: r for r in pii.personal_rows(docs).collect()}
    assert {i: base_only(r) for i, r in rows.items()} == {i: expected(t) for i, t in enumerate(TEXTS)}
    for i, text in enumerate(TEXTS):
        base = {f"{k}:{a}:{b}" for a, _, k, b in brute.personal_spans(text)}
        assert base <= set(rows[i].spans.split(",")) | {""}


def test_whole_table(docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.personal_rows(docs).collect()
    assert {r.doc_id: base_only(r) for r in rows} == {i: expected(t) for i, t in texts.items()}


def test_added_spans(spark):
    """Many disguised addresses after telling words are learned; the same shape after other words is not needed."""
    rows = [(i, f"please mail user{i} [at] host{i % 7} [dot] com today") for i in range(60)]
    rows += [(100 + i, f"mail me at user{i}@host{i % 5}.com") for i in range(60)]
    out = {r.doc_id: r for r in pii.personal_rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    added = [r for i, r in out.items() if i < 100 and r.n_added == 1]
    assert len(added) > 50 and added[0].spans.startswith("email:12:") and all(r.n_email == 0 for r in added)
    assert all(r.n_email == 1 and r.n_added == 0 for i, r in out.items() if i >= 100)


def test_running(spark):
    rows = [([3, 1, 4, 1, 5, 9, 2, 6, 5],), ([],), ([7],), (None,), ([2, 2],)]
    frame = spark.createDataFrame(rows, "v array<int>")
    got = frame.select(pii.running(F.col("v"), lambda x, y: x + y).alias("total"), pii.running(F.col("v"), F.greatest).alias("most"), "v").collect()
    for r in got:
        assert r.total == (None if r.v is None else list(accumulate(r.v))) and r.most == (None if r.v is None else list(accumulate(r.v, max)))


def test_overlaps(spark):
    """A candidate that meets a base span of its kind on either side isn't free, one that only touches it is."""
    kind = "array<struct<start:int,place:int,kind:string,end:int%s>>"
    base = [(5, 0, "email", 9), (20, 0, "email", 30), (7, 1, "ip", 12)]
    spans = [(s, p, k, e, [1], ["a"]) for s, p, k, e in [(0, 0, "email", 5), (0, 0, "email", 6), (9, 0, "email", 20), (8, 0, "email", 10), (5, 0, "email", 9), (25, 0, "email", 26), (15, 0, "email", 40), (0, 1, "ip", 7), (3, 1, "ip", 20), (12, 1, "ip", 13), (7, 2, "card", 12)]]
    frame = spark.createDataFrame([(base, spans), ([], spans), (base, [])], f"base {kind % ''}, found {kind % ',votes:array<int>,names:array<string>'}")
    for r in frame.select("base", "found", pii.with_free(F.col("base"), F.col("found")).alias("out")).collect():
        plain = {tuple(map(str, c)): not any(b.kind == c.kind and b.start < c.end and b.end > c.start for b in r.base) for c in r.found}
        assert {tuple(map(str, c.span)): c.free for c in r.out} == plain


def test_many_matches(spark):
    """Work grows in proportion to the matches of one text, not as their square."""
    text = " ".join(f"u{i}@h{i % 7}.com" if i % 3 else f"mail u{i} [at] h.org" for i in range(40_000))
    begin = time.monotonic()
    row = pii.personal_rows(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert base_only(row) == expected(text) and time.monotonic() - begin < 120


def test_posteriors(spark):
    rows = [("card", [1, 1, 1, 1], 50), ("card", [1, 1, 0, 1], 40), ("card", [-1, -1, 0, -1], 60), ("card", [-1, 1, 0, -1], 5), ("ip", [-1, 0, -1, 1], 1)]
    got = {(r.kind, tuple(r.votes)): r.posterior for r in pii.estimate(spark.createDataFrame(rows, "kind string, votes array<int>, count long")).collect()}
    assert len(got) == 5 and got["card", (1, 1, 1, 1)] > 0.95 and got["card", (-1, -1, 0, -1)] < 0.05


def test_awkward(awkward, empty):
    assert pii.personal_rows(awkward).count() == awkward.count()
    assert pii.personal_rows(empty).count() == 0


def test_no_python(docs):
    plan = pii.personal_rows(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert pytest.approx(pii.ACCEPT) == 0.9
