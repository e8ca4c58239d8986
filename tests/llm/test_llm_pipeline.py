import re

import brute
import corpus_pipeline
from test_llm_lines import cleaned

from scorelake.llm import decontaminate, langid, lines, mix


def test_against_plain_version(spark, docs, sf):
    """The stages between the first and the last by plain code; language labels and mix counts by their operators,
    which are tested for themselves."""
    size = decontaminate.WINDOW
    words = lambda t: re.findall(r"\w+", t.lower())
    rows = [(r.doc_id, r.text, r.source) for r in langid.keep_languages(docs).collect()]
    texts = cleaned(rows, lines.SITES)
    groups = brute.near_duplicates(sorted(texts.items()))
    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    clean = lambda t: sum(tuple(words(t)[i : i + size]) in windows for i in range(len(words(t)) - size + 1)) < 6
    left = [(i, texts[i], s) for i, _, s in rows if groups[i][2] and clean(texts[i])]
    frame = spark.createDataFrame(left, "doc_id long, text string, source string")
    copies = {r.doc_id: r.copies for r in mix.mix_documents(frame, spark.read.parquet(f"{sf}/labels.parquet")).collect() if r.size}
    want = sorted((i, t, e) for i, t, _ in left for e in range(copies.get(i, 0)))
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == [*docs.columns, "epoch"]
    assert sorted((r.doc_id, r.text, r.epoch) for r in got.collect()) == want and want


def test_stages_keep_columns(spark, awkward, sf):
    rows = awkward
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, rows, sf)
        assert out.columns[: len(awkward.columns)] == awkward.columns, name
        rows = out
    assert rows.count() > 0


def test_empty(spark, empty, sf):
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, empty, sf).count() == 0, name
