import duckdb
import pytest

from keelson.llm import url_filter as U


def judged(spark, urls, **kw):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)],
                               "page_id long, url string, host string")
    return [r.asDict() for r in U.judge_urls(df, **kw).orderBy("page_id").collect()]


@pytest.mark.parametrize("url, host, path", [
    ("http://A.Example.COM/en/1?q=/x#f", "a.example.com", "/en/1"),
    ("http://x.net", "x.net", ""),
    ("x://h?a/b", "h", ""),
    ("no scheme", "", ""),
    (None, "", ""),
    ("", "", ""),
    ("http://a//b://c", "a", "//b://c"),
    ("http://a.b/line\nbreak?x", "a.b", "/line\nbreak"),
])
def test_host_and_path(spark, url, host, path):
    row = judged(spark, [url])[0]
    assert (row["host"], row["path"]) == (host, path)


def test_rules_longest_wins_and_subdomains(spark):
    rows = judged(spark, ["http://a.net/x", "http://a.example.net/en/5", "http://example.net/fr/",
                          "http://sub.example.com/de/1", "http://example.com/fr", "http://n.org/fr/",
                          "http://anet/x", "http://x.net", "http://badexample.com/de/1"])
    assert [r["rule"] for r in rows] == [
        "net/", "example.net/en/", "net/", "example.com/de/", None, "org/fr/", None, None, None]
    assert [r["verdict"] for r in rows[:6]] == ["block", "allow", "block", "block", "allow", "allow"]


def test_vocabulary_boundaries_and_counts(spark):
    rows = judged(spark, [
        "http://casino.com/", "http://casinos.com/", "http://my-casino-x.com/",
        "http://free.com/free/FREE", "http://free.com/pills", "http://freepills.com/",
        "http://x.com/ads_track", "http://adulthood.com/", None])
    assert [r["verdict"] for r in rows] == [
        "block", "allow", "block", "allow", "block", "allow", "block", "allow", "allow"]
    assert rows[3]["soft_hits"] == 1 and rows[4]["soft_hits"] == 2
    assert rows[0]["strict_hits"] == 1


def test_other_rules_and_vocabulary(spark):
    v = U.Vocabulary(strict=("zap",), soft={"a-b": 0.4, "c": 0.4, "d": 0.4}, min_soft=2, min_weight=1)
    rows = judged(spark, ["x://h/a-b/c", "x://h/a-b/c/d", "x://h/zap"], rules=(), vocabulary=v)
    assert [r["verdict"] for r in rows] == ["allow", "block", "block"]


def test_empty_table_keeps_columns(spark):
    df = spark.createDataFrame([], "page_id long, url string, verdict string")
    out = U.judge_urls(df)
    assert out.count() == 0 and out.columns[:2] == ["page_id", "url"]
    assert len(set(out.columns)) == len(out.columns)


def test_of_equal_rules_the_first_wins(spark):
    rules = (("allow", "a.net", "/"), ("block", "a.net", "/"), ("block", "net", "/en/"))
    rows = judged(spark, ["http://a.net/x", "http://a.net/en/"], rules=rules)
    assert [r["verdict"] for r in rows] == ["allow", "block"]
    con = duckdb.connect()
    con.sql("create view pages as select * from (values (0, 'http://a.net/x')) t(page_id, url)")
    assert con.sql(U.oracle(rules)).fetchall()[0][4] == "allow"


def test_vocabulary_from_a_table(spark):
    terms = spark.createDataFrame([("Zap", None), ("zap", 0.5), ("a-b", 0.4), ("c", 0.4), ("c", 0.9),
                                   ("", 1.0), (None, 1.0)], "term string, weight double")
    v = U.Vocabulary.from_table(terms)
    assert v.strict == ("zap",) and v.soft == {"a-b": 0.4, "c": 0.9}
    rows = judged(spark, ["x://h/a-b/c", "x://h/c/c", "x://h/ZAP"], rules=(), vocabulary=v)
    assert [r["verdict"] for r in rows] == ["block", "allow", "block"]
    with pytest.raises(ValueError, match="hyphens"):
        U.Vocabulary.from_table(spark.createDataFrame([("a b", 1.0)], terms.schema))
    with pytest.raises(ValueError, match="more than 2"):
        U.Vocabulary.from_table(terms, max_terms=2)
    none = U.Vocabulary.from_table(terms.limit(0))
    assert judged(spark, ["http://porn.com/"], rules=(), vocabulary=none)[0]["verdict"] == "allow"


def test_default_terms_are_well_formed():
    assert all(U.TERM.fullmatch(t) for t in (*U.STRICT, *U.SOFT))
    assert not set(U.STRICT) & set(U.SOFT) and len(set(U.STRICT)) == len(U.STRICT)


def test_repeated_rows_clashing_columns_and_a_long_url(spark):
    long = "http://h.com/" + "a/" * 300_000 + "casino"
    rows = [(1, "http://poker.com/bets", "mine", 7), (1, "http://poker.com/bets", "mine", 7),
            (2, long, None, None), (3, None, "x", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string, soft_hits int")
    out = U.judge_urls(df)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict", "strict_hits",
                           "soft_hits", "soft_weight"]
    got = sorted((r["page_id"], r["rule"], r["verdict"], r["soft_hits"]) for r in out.collect())
    assert got == [(1, None, "block", 2), (1, None, "block", 2), (2, None, "block", 0),
                   (3, None, "allow", 0)]
