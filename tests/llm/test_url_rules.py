"""URL rules: parts, longest rule, aliases by links, redirects and given edges."""

from textspark.llm.queries import URL_RULES
from textspark.llm.url_rules import judge_urls


def judge(spark, rows, rules=URL_RULES, edges=None):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string")
    if edges is not None:
        edges = spark.createDataFrame(edges, "url string, target string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(df, rules, edges=edges).collect()}


def test_rules(spark):
    urls = ["https://WWW.Example.COM/en/1?q#f", "http://example.com/en/x", "http://a.example.com/en/", "http://example.com/de/",
            "http://notexample.com/en/", "http://x.net/es/1", "http://x.net/fr/", "http://net/es/2", "http://x.net/de", "http://com",
            "no scheme", None, "ftp://h.org?x=/en/", "a://b://com/en", "http://É.com/É"]
    got = judge(spark, [(i, u, None, None) for i, u in enumerate(urls)])
    assert got == {
        0: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        1: ("example.com", "/en/x", "example.com/en/", "block"), 2: ("a.example.com", "/en/", "example.com/en/", "block"),
        3: ("example.com", "/de/", "com/", "allow"), 4: ("notexample.com", "/en/", "com/", "allow"),
        5: ("x.net", "/es/1", "net/es/", "block"), 6: ("x.net", "/fr/", "net/fr/", "block"), 7: ("net", "/es/2", "net/es/", "block"),
        8: ("x.net", "/de", None, "allow"), 9: ("com", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("", "", None, "allow"),
        12: ("h.org", "", None, "allow"), 13: ("b:", "//com/en", None, "allow"), 14: ("É.com", "/É", "com/", "allow")}


def canonical(href):
    return f"<HTML><head><LINK href='{href}' REL=\"Canonical\"></head>"


def test_decisions_reach_aliases(spark):
    rows = [
        (1, "http://a.org/1", canonical("http://x.net/es/1"), None),            # blocked target
        (2, "http://b.org/2#top", '<meta http-equiv="refresh" content="0; url=http://a.org/1">', None),  # chain to it
        (3, "http://c.org/3", canonical("//example.com/en/3"), None),           # blocked, same scheme
        (4, "http://d.org/4", canonical("http://c.org/3?utm_source=z"), None),  # same address as 3
        (5, "http://e.org/5", canonical("http://example.com/de/"), None),       # allowed target
        (6, "http://f.org/dir/6", canonical("7"), None), (7, "http://f.org/dir/7", canonical("http://y.net/fr/"), None),
        (8, "http://g.org/8", None, None), (9, "http://g.org/9", canonical(""), None),
        (10, "http://x.net/es/1", None, None), (11, "http://g.org/9", canonical("mailto:a@b"), None),
        # an allow in the group goes before its blocks, but not before a page's own rule
        (12, "http://h.org/12", canonical("http://z.net/es/"), None), (13, "http://h.org/13", canonical("http://h.org/12"), None),
        (14, "http://ok.com/", canonical("http://h.org/13"), None), (15, "http://z.net/es/", None, None)]
    got = {k: v[3] for k, v in judge(spark, rows).items()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "block", 7: "block", 8: "allow",
                   9: "allow", 10: "block", 11: "allow", 12: "allow", 13: "allow", 14: "allow", 15: "block"}


def test_given_edges_ties_repeats_and_empty(spark):
    rows = [(1, "http://a.org/", None, "x"), (1, "http://a.org/", None, "x"), (None, "http://b.org/", None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string")
    edges = spark.createDataFrame([("http://a.org/", "http://c.net/es/"), ("http://a.org/", None)], "url string, target string")
    got = sorted((str(r.page_id), r.verdict) for r in judge_urls(df, URL_RULES, edges=edges).collect())
    assert got == [("1", "block"), ("1", "block"), ("None", "allow")]
    assert judge_urls(df.limit(0), URL_RULES).count() == 0
    assert judge_urls(df, []).where("verdict = 'allow'").count() == 3
    tie = judge(spark, [(1, "http://a.b/", None, None)], [("block", "a.b/"), ("allow", "a.b/")])
    assert tie[1][3] == "allow"


def test_oracle(spark, sf_dir):
    from textspark.llm.queries import ORACLE, QUERIES
    from textspark.plans.oracle_check import compare, duck_connection
    name = "op2_url_rules"
    r = compare(spark, sf_dir, name, QUERIES[name], ORACLE[name], duck_connection(sf_dir))
    assert r["ok"], r
