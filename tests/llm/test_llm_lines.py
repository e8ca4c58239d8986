from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from scorelake.llm import lines

BLANK = " \t\n\x0b\x0c\r"


def cleaned(rows, sites):
    """rows: (doc_id, text, source) with distinct ids -> {doc_id: text}."""
    where, first = defaultdict(set), {}
    judged = lambda x: x.strip(BLANK) if len(x.strip(BLANK)) >= lines.LEAST_CHARS else None
    for i, text, source in sorted(rows):
        for pos, line in enumerate((text or "").split("\n")):
            if judged(line):
                where[judged(line)].add(source or "")
                first.setdefault(judged(line), (i, pos))
    out = {}
    for i, text, _ in rows:
        parts = (text or "").split("\n")
        stays = [x for p, x in enumerate(parts) if not judged(x) or len(where[judged(x)]) < sites or first[judged(x)] == (i, p)]
        out[i] = text if text is None or len(stays) == len(parts) else "\n".join(stays)
    return out


@pytest.mark.parametrize("sites", [2, 3, 8])
def test_whole_table(docs, sites):
    want = cleaned([(r.doc_id, r.text, r.source) for r in docs.collect()], sites)
    got = {r.doc_id: r.text for r in lines.cleaned(docs, sites).collect()}
    assert got == want and (sites == 8 or got != {r.doc_id: r.text for r in docs.collect()})


def test_near_threshold_is_exact(spark):
    rows = [(i * 1000 + s, f"line number {i} stands here", f"s{s}") for i in range(6) for s in range(27 + i)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    gone = {r.doc_id // 1000 for r in lines.cleaned(docs, 30).where("text = ''").collect()}
    assert gone == {3, 4, 5}


def test_awkward(awkward, empty):
    out = lines.cleaned(awkward, 2)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    by = defaultdict(list)
    for r in out.collect():
        by[r.doc_id].append(r)
    base = next(r.text for r in awkward.collect() if r.doc_id == 5)
    # The smallest id that has the line keeps it, in each of its rows; a row without id is not changed.
    assert [r.text for r in by[5]] == [base, base]
    assert by[11][0].text == "one\n\n\ntwo" and by[11][0].n_chars == 9 and by[12][0].text == ""
    assert {r.text for r in by[None]} == {base, None} and by[1][0].text is None and by[2][0].text == ""
    assert lines.cleaned(empty).count() == 0 and lines.line_rows(empty).count() == 0


def test_counts(awkward):
    by = {r.doc_id: r for r in lines.line_rows(awkward, 2).collect() if r.doc_id is not None}
    assert (by[12].n_lines, by[12].n_removed) == (2, 2) and (by[11].n_lines, by[11].n_removed) == (5, 1)
    assert (by[1].n_lines, by[1].n_removed) == (0, 0)


def test_other_columns_stay(awkward):
    same = lines.cleaned(awkward, 10**6)
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "text", "source")]
    assert same.orderBy(*order).collect() == awkward.orderBy(*order).collect()


def test_passages_within_one_site(spark):
    passage, short = " ".join(f"word{i}" for i in range(50)), "a line of some words that is not a passage"
    rows = [(i, f"start {i}\n{passage}\n{short}", "one") for i in range(4)] + [(9, f"{short} again", "one"), (10, f"{short} again", "two")]
    rows += [(20, f"{passage} twice\n{passage} twice", "one"), (None, f"{passage}\nx", "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in lines.cleaned(docs, long_copies=True).collect()}
    assert got[0] == rows[0][1] and all(got[i] == f"start {i}\n{short}" for i in (1, 2, 3))
    assert (got[9], got[10]) == (f"{short} again", "") and got[20] == f"{passage} twice\n{passage} twice" and got[None] == f"{passage}\nx"


def test_many_common_lines_in_one_text(spark):
    """Linear in the number of lines: 60,000 of them on two sites."""
    text = "\n".join(f"one common line of text with number {i}" for i in range(60_000))
    docs = spark.createDataFrame([(1, text, "a"), (2, text, "b"), (2, "another row of the same document", "b")], "doc_id long, text string, source string")
    got = sorted(((r.doc_id, r.n_lines, r.n_removed) for r in lines.line_rows(docs).collect()))
    assert got == [(1, 60_000, 0), (2, 1, 0), (2, 60_000, 60_000)]
