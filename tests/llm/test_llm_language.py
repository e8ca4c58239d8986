import numpy as np
from pyspark.sql import functions as F

from scorelake.llm import langid


def test_held_out_accuracy(docs):
    rows = langid.language_rows(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").where("held_out AND n_chars > 200")
    n, right = rows.count(), rows.where("lang = lang_pred").count()
    assert n > 10 and right >= 0.95 * n


def test_awkward(awkward):
    rows = langid.language_rows(awkward).collect()
    assert len(rows) == awkward.count()
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3, -3))
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "fr", "und") for r in rows)
    assert by[None].held_out


def test_same_on_any_partitioning(docs):
    one = langid.fit_prototypes(docs.coalesce(1), "text", "lang")
    many = langid.fit_prototypes(docs.repartition(5), "text", "lang")
    assert one.keys() == many.keys() and all((one[k] == many[k]).all() for k in one)


def test_counts_agree_on_both_paths(monkeypatch):
    texts = ["The cat, the hat!", "", "Ünïcode ß 日本語 x", "a"]
    table = {}
    for cube in (1 << 22, 0):
        monkeypatch.setattr(langid, "CUBE", cube)
        codes, counts = langid.Binder(64).counts(texts)
        table[cube] = {(i, int(c)): int(n) for i, row in enumerate(counts) for c, n in zip(codes, row) if n}
    assert table[0] == table[1 << 22] and table[0]


def test_keep(spark, docs, awkward, empty):
    kept = langid.keep_languages(awkward)
    assert kept.columns == awkward.columns
    gone = {r.doc_id for r in awkward.collect()} - {r.doc_id for r in kept.collect()}
    assert gone == {1, 2, 3, -3}
    assert langid.keep_languages(docs).count() == docs.where(F.col("text").rlike(r"\p{L}")).count()
    assert langid.keep_languages(empty).count() == 0 and langid.language_rows(empty).count() == 0
    unlabelled = awkward.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.language_rows(unlabelled).collect()} == {"und"}
    assert langid.keep_languages(unlabelled).count() == kept.count()


def test_foreign_script_is_rejected(spark):
    good = [(i, "the cat sat on the mat and the dog ran to the hut " * 8, "en", "s", 1) for i in range(20)]
    odd = [(100, "".join(chr(0x0E01 + (i * 7919) % 46) for i in range(900)), "en", "s", 1)]
    rows = spark.createDataFrame(good + [(100, odd[0][1], None, "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert 100 not in {r.doc_id for r in langid.keep_languages(rows).collect()}


def test_long_texts_count_as_short_ones(spark, monkeypatch):
    """A text of more trigrams than it has weight for each, as all of its language may be."""
    monkeypatch.setattr(langid, "LEAST_TRIGRAMS", 3)
    words = {"en": "the cat sat on the mat and then ran ", "xx": "zuqo vexi wyju kobri plano gwerti "}
    rows = [(i, w * 40_000, k) for i, (k, w) in enumerate([(k, w) for k, w in words.items()] * 4)]
    rows += [(100 + i, w * 3, None) for i, w in enumerate(words.values())]
    docs = spark.createDataFrame([(i, t, k, "s", 1) for i, t, k in rows], "doc_id long, text string, lang string, source string, n_chars long")
    by = {r.doc_id: r.lang_pred for r in langid.language_rows(docs).collect()}
    assert (by[100], by[101]) == ("en", "xx")
    assert {r.doc_id for r in langid.keep_languages(docs).collect()} == {i for i, _, _ in rows}


def test_a_text_gives_all_its_weight():
    counts = np.array([[0, 1, 0, 2, 10**6, 3], [5, 0, 0, 0, 0, 2], [0, 0, 0, 0, 0, 0], [1, 1, 1, 3 * 10**9, 0, 1]], dtype=np.int64)
    got = langid.whole_shares(counts)
    assert got.sum(axis=1).tolist() == [langid.TEXT_WEIGHT, langid.TEXT_WEIGHT, 0, langid.TEXT_WEIGHT]
    exact = counts * langid.TEXT_WEIGHT / np.maximum(1, counts.sum(axis=1))[:, None]
    assert np.abs(got - exact).max() <= 1 and (got[counts == 0] == 0).all()


def test_large_alphabets_in_strips(spark, monkeypatch):
    """Sums over strips are those of the whole, and a text of many different trigrams needs little memory."""
    binder = langid.Binder(64)
    text = "".join(map(chr, np.random.default_rng(3).integers(0x4E00, 0x9F00, 200_000)))
    codes, counts = binder.counts([text, "plain words in a row"])
    assert len(codes) > 50_000
    whole = counts.astype(float) @ binder.vectors(codes).astype(float)
    assert (langid.bundled(binder, counts, codes) == whole).all()
    monkeypatch.setattr(langid, "STRIP", 7)
    assert (langid.bundled(binder, counts[:, :1000], codes[:1000]) == counts[:, :1000].astype(float) @ binder.vectors(codes[:1000]).astype(float)).all()
