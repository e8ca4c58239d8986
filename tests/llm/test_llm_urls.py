import oracle

from scorelake.llm import queries, urls


def judge(spark, *given):
    pages = spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(given)], "page_id long, url string, html string, host string")
    return [tuple(r)[1:] for r in sorted(urls.judge(pages, urls.rule_table(spark)).collect(), key=lambda r: r.page_id)]


def test_agrees_with_sql(spark, sf):
    assert oracle.diff(queries.op8_url_filter(spark, sf), oracle.connect(sf), queries.SQL["op8_url_filter"]) is None


def test_places(spark):
    got = judge(
        spark, None, "", "example.com/en/", "http://EXAMPLE.com/en/x?q#f", "https://www.example.com/en/", "http://a.www.example.com/en/1", "http://notexample.com/en/", "ftp://x.NET/es/1",
        "http://x.net/ES/1", "http://net/fr/", "http://x.com", "http://x.com?a=/en/", "http://a.com/http://b.net/es/", "http://cheap-pills.org/a", "http://cheap-pillsy.org/a", "http://x\ny.com/\n/en",
        "http://b.org/" + "a" * 100_000,
    )
    assert got[:16] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("example.com", "/en/x", "example.com/en/", "block"), ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("a.www.example.com", "/en/1", "www.example.com/en/", "allow"), ("notexample.com", "/en/", "com/", "allow"), ("x.net", "/es/1", "net/es/", "block"), ("x.net", "/ES/1", None, "allow"),
        ("net", "/fr/", "net/fr/", "block"), ("x.com", "", None, "allow"), ("x.com", "", None, "allow"), ("a.com", "/http://b.net/es/", "com/", "allow"), ("cheap-pills.org", "/a", None, "block"),
        ("cheap-pillsy.org", "/a", None, "allow"), ("x\ny.com", "/\n/en", "com/", "allow"),
    ]
    assert len(got[16][1]) == 100_001


def test_repeated_and_empty(spark):
    assert judge(spark, "http://x.net/es/", "http://x.net/es/") == [("x.net", "/es/", "net/es/", "block")] * 2
    assert judge(spark) == []
