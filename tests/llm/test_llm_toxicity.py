import random

import numpy as np
import pytest

from scorelake.llm import toxicity


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    plain = [f"{a}{b}{c}" for a in ("ther", "in", "on", "re") for b in ("an", "ti", "or", "he") for c in ("ed", "ing", "ly", "st", "")]
    insults = ["idiot", "moron", "scum", "pathetic"]
    docs, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randrange(10, 200))]
        bad = i % 3 == 0
        if bad:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(insults))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    more = [(1000, "ther aned " * 30 + "idiott " + "inored " * 500), (1001, "patheticc reti"), (1002, ""), (1003, None), (1004, "therhe " * 3000), (None, "moron"), (1005, "moron"), (1005, "moron")]
    frame = spark.createDataFrame([(i, t, "z", 9.0) for i, t in docs + more], "doc_id long, text string, lang string, score double")
    out = toxicity.score_rows(frame, spark.createDataFrame(labels + [(1, None, None), (0, 1, 1)], "doc_id long, quality int, toxic int")).collect()
    return out, {i: t for i, _, t in labels}


def test_held_out(scored):
    rows, labels = scored
    own = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(own) > 100 and np.mean([r.predicted == labels[r.doc_id] for r in own]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_misspellings_long_and_empty_texts(scored):
    rows, _ = scored
    assert len(rows) == 608
    by = {r.doc_id: r for r in rows}
    assert by[1000].score > 0.5 and by[1001].score > 0.5
    assert by[1002].score == by[1003].score < 0.5 and by[1004].predicted == 0 and by[None].held_out


def test_runs_cut_between_words():
    text = b"some words here " * 200_000
    parts = list(toxicity.runs(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)])))
    assert len(parts) > 1 and b"".join(bytes(p) for p, _ in parts) == text
    assert all(p[0] == 32 for p, _ in parts[1:])


def test_one_class_and_empty(spark, awkward, empty, no_labels):
    assert {r.score for r in toxicity.score_rows(awkward, no_labels).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert all(r.score < 0.01 for r in toxicity.score_rows(awkward, one).collect())
    assert toxicity.score_rows(empty, no_labels).count() == 0


def test_awkward(awkward, labels):
    rows = toxicity.score_rows(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)


def plain_top(values, names):
    """Largest window sum by a loop over all windows of one text."""
    best = []
    for i in range(max(1, len(values) - toxicity.WINDOW + 1)):
        own = {}
        for v, n in zip(values[i : i + toxicity.WINDOW], names[i : i + toxicity.WINDOW]):
            own.setdefault(n, v)
        best.append(sum(own.values()) / toxicity.WINDOW)
    return max(best)


def test_windows_begin_at_every_word():
    """Words on both sides of a multiple of the window's size are in one window, and a word put before changes nothing."""
    rng = np.random.default_rng(2)
    sizes = [1, 3, 16, 17, 40, 200]
    owner, names = np.repeat(np.arange(len(sizes)), sizes), rng.integers(0, 30, sum(sizes)).astype(float)
    values = rng.normal(size=40)[names.astype(int)]
    windows = toxicity.Windows(owner, names, len(sizes))
    top = np.full(len(sizes), -np.inf)
    np.maximum.at(top, windows.text, windows.sums(values))
    assert top == pytest.approx([plain_top(values[owner == k], names[owner == k]) for k in range(len(sizes))])
    given = rng.normal(size=len(windows.begin))
    assert (windows.spread(given) * values).sum() == pytest.approx((windows.sums(values) * given).sum())

    table = np.zeros(1 << toxicity.ROWS_BITS, dtype=np.float32)
    for rows, _ in toxicity.Grams(np.frombuffer(b"scum idiot", dtype=np.uint8), np.array([0, 10])).parts:
        table[rows] = 1
    text = lambda t: toxicity.highest([(np.frombuffer(t, dtype=np.uint8), np.array([0, len(t)]))], 1, table)[0]
    tops = [text(b"zz " * n + b"scum qq idiot " + b"zz " * 30) for n in range(32)]
    assert min(tops) == pytest.approx(max(tops)) and min(tops) > 1.5 / toxicity.WINDOW


def test_runs_of_a_long_text_overlap(monkeypatch):
    text = np.frombuffer(b" ".join(b"%x" % (i * i % 9973) for i in range(3000)), dtype=np.uint8)
    table = np.random.default_rng(1).normal(size=1 << toxicity.ROWS_BITS).astype(np.float32)
    whole = toxicity.highest([(text, np.array([0, len(text)]))], 1, table)
    monkeypatch.setattr(toxicity, "RUN_BYTES", 40)
    parts = list(toxicity.runs(text, np.array([0, len(text)])))
    assert len(parts) > 100 and toxicity.highest(parts, 1, table) == pytest.approx(whole)
