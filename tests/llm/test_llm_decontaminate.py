import re

from scorelake.llm import decontaminate

ITEM = "A train leaves the old station at 45 km per hour and Alice waits 12 minutes before Bob boards the next carriage to town"
BENCH = "item_id long, text string"


def flags(spark, texts, bench=((1, ITEM),)):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in decontaminate.leak_rows(docs, spark.createDataFrame(list(bench), BENCH)).collect()}


def test_verbatim_and_changed(spark):
    other = ITEM.replace("45", "80").replace("12", "30").replace("Alice", "Carla").replace("Bob", "Dan")
    twisted = ITEM.replace("45", "12")
    words = ITEM.split()
    got = flags(
        spark,
        [
            "before that. " + ITEM + " and after", other, ITEM.upper(), ITEM.replace(" ", " \n ").replace("waits", "waits,"), " ".join(words[:13]), " ".join(words[:9]),
            "nothing to see here but plain words in a plain row of text", twisted, None, "", ITEM + ". " + ITEM,
        ],
    )
    assert [got[i].contaminated for i in range(6)] == [True, True, False, True, True, False]
    assert got[1].changed and not got[0].changed and got[1].item_id == 1 and got[0].windows > 10
    assert not any(got[i].contaminated for i in (6, 7, 8, 9)) and got[10].contaminated


def test_capitals_match_without_names(spark):
    plain = "the old train leaves the small station at dawn and rolls on to the far town by the sea"
    got = flags(spark, [plain.upper(), plain.title(), "Été " + plain], [(3, plain)])
    assert got[0].contaminated and got[2].contaminated


def test_slots_must_map_one_to_one(spark):
    item = "first take 5 stones from the box and then put 5 stones back into the box and count 7 in all"
    good, bad = item.replace("5", "9"), item.replace("5 stones from", "9 stones from")
    got = flags(spark, [good, bad, item], [(3, item)])
    assert [got[i].contaminated for i in range(3)] == [True, False, True] and got[0].changed


def test_whole_table(spark, docs, sf):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    size, windows = decontaminate.WINDOW, set()
    words = lambda t: re.findall(r"\w+", t.lower())
    for r in bench.collect():
        w = words(r.text)
        windows |= {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    want = {r.doc_id for r in docs.collect() if sum(tuple(words(r.text)[i : i + size]) in windows for i in range(len(words(r.text)) - size + 1)) >= 6}
    got = {r.doc_id for r in decontaminate.leak_rows(docs, bench).where("contaminated").collect()}
    assert want and got == want
    kept = decontaminate.without_leaks(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - want


def test_awkward(spark, awkward, empty):
    bench = spark.createDataFrame([(1, None), (2, ""), (None, ITEM), (3, "Word"), (4, ITEM)], BENCH)
    rows = decontaminate.leak_rows(awkward, bench).collect()
    assert len(rows) == awkward.count()
    none = spark.createDataFrame([], BENCH)
    assert decontaminate.without_leaks(awkward, none).count() == awkward.count()
    assert decontaminate.leak_rows(empty, bench).count() == 0


def test_unchanged_windows_are_evidence_of_their_own(spark):
    """A long item copied word for word but for one occurrence of a repeated value; and rows that share an id, or none."""
    middle = "while the mayor of that small river town opened one more bridge and thanked the engineers who had planned it for many long years before"
    item = f"in 1990 the old mill was closed {middle} and nobody in 1990 spoke of the mill again"
    bad = item.replace("in 1990 spoke", "in 1991 spoke")
    got = flags(spark, [bad], [(3, item)])
    assert got[0].contaminated and got[0].changed
    short = "first take 5 stones from the box and then put 5 stones back into the box and count 7 in all"
    twisted = short.replace("5 stones from", "9 stones from")
    docs = spark.createDataFrame([(1, short), (1, twisted), (None, short), (None, twisted), (2, twisted)], "doc_id long, text string")
    rows = decontaminate.leak_rows(docs, spark.createDataFrame([(3, short)], BENCH)).collect()
    assert sorted((r.doc_id or 0, r.contaminated) for r in rows) == [(0, True), (0, True), (1, True), (1, True), (2, False)]


def test_items_of_few_literals(spark):
    """Exact copies of sums, dates and names; other values are not the item."""
    sums = "12 plus 7 is 19 and 4 plus 8 is 12 and 3 plus 3 is 6"
    dates = "1914 1918 1939 1945 1961 1989 1990 1991 2001 2008 2014 2020"
    names = "so Anna Berta Carla Dora Emil Frida Gustav Hanna Ida Jonas Karla Linus"
    bench = [(1, sums), (2, dates), (3, names)]
    text = lambda x: f"some words go before the copy {x} and others follow it here"
    got = flags(spark, [text(dates), text(names), text(sums), text(" ".join(str(3000 + i) for i in range(12)))], bench)
    assert [got[i].item_id for i in range(4)] == [2, 3, 1, None]
    # Windows of few literals don't raise what a re-parameterised copy has to reach.
    mixed = "please count all of these apples 1 2 3 4 5 6 7 8 9 10 11 12 13 14"
    other = mixed.replace("1 2 3", "21 22 23")
    assert flags(spark, [other], [(4, mixed)])[0].contaminated


def test_short_items_in_longer_texts(spark):
    bench = [(1, "who wrote this odd poem"), (2, "why not")]
    got = flags(spark, ["they asked me who wrote this odd poem last night at home", "who wrote this odd poem", "so why not go there and see for yourself", "why not", "who wrote that odd poem"], bench)
    assert [got[i].item_id for i in range(5)] == [1, 1, None, 2, None]


def test_clean_rows_stay_whatever_their_id(spark):
    """One leaking row takes neither other rows without an id with it, nor others of the same id."""
    clean = "a plain row of words that has nothing at all to do with trains or stations of any kind"
    docs = spark.createDataFrame([(None, ITEM), (None, clean), (1, ITEM), (1, clean), (1, clean), (None, None), (2, "")], "doc_id long, text string")
    kept = decontaminate.without_leaks(docs, spark.createDataFrame([(1, ITEM)], BENCH)).collect()
    assert sorted(((r.doc_id or 0), r.text or "") for r in kept) == sorted([(0, clean), (1, clean), (1, clean), (0, ""), (2, "")])
