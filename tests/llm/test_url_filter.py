import random

from docquarry.llm.common import SQL
from docquarry.llm.url_filter import RULES, address_of, fitting_rules, host_of, judge, op11_url_filter, page_links, path_of
from oracle import connect, differences

PAGES = "page_id long, url string, html string"


def frame(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def test_same_as_sql(spark, folder):
    assert differences(spark, connect(folder), "op11", op11_url_filter, SQL["op11_url_filter"], folder) == []


def test_places(spark):
    rows = [(0, "HTTP://WWW.Ä.Org:80/A/b?x=/#f", ""), (1, "s://h", ""), (2, "s://h?q", ""), (3, "a b", ""), (4, None, ""),
            (5, "://", ""), (6, "x://h#a/b?c", ""), (7, "x://u@h/p://q#", "")]
    from pyspark.sql import functions as F

    url = F.col("url")
    got = {r[0]: tuple(r)[1:] for r in frame(spark, rows).select("page_id", host_of(url), path_of(url), address_of(url)).collect()}
    assert got == {
        0: ("www.Ä.org:80", "/A/b", "www.Ä.org:80/A/b?x=/"), 1: ("h", "", "h"), 2: ("h", "", "h?q"), 3: ("", "", None),
        4: ("", "", None), 5: ("", "", ""), 6: ("h", "", "h"), 7: ("u@h", "/p://q", "u@h/p://q"),
    }


def test_links_of_pages(spark):
    html = {
        "http://a.net/x/y?z": """<!-- <link rel=canonical href="http://no.net/"> --><LINK REL='canonical' HREF='//b.net/q?a=1&amp;b=2#f'>
            <script>var t = '<link rel="canonical" href="http://no.net/2">';</script><link rel="stylesheet" href="http://no.net/3">
            <link data-href="/no" href=r.html rel="alternate canonical">""",
        "http://a.net": '<meta content="3; URL=\'/moved\'" http-equiv="Refresh"><meta http-equiv="content-type" content="url=x">',
        "http://a.net/p": '<link rel="canonical" href="?q"><link rel="canonical" href="mailto:x@y"><link rel="canonical" href="#top">',
        "http://c.net/": '<link rel="canonical" href="rel">',
        "no address": '<link rel="canonical" href="http://b.net/">',
    }
    rows = [(i, u, h) for i, (u, h) in enumerate(html.items())] + [(9, None, None), (10, "http://d.net/", None)]
    got = {tuple(r) for r in page_links(frame(spark, rows)).collect()}
    assert got == {
        ("http://a.net/x/y?z", "http://b.net/q?a=1&b=2#f"), ("http://a.net/x/y?z", "http://a.net/x/r.html"),
        ("http://a.net", "http://a.net/moved"), ("http://a.net/p", "http://a.net/p?q"), ("http://c.net/", "http://c.net/rel"),
    }


def canonical(target):
    return f'<html><head><link rel="canonical" href="{target}"></head></html>'


def test_blocks_reach_aliases_but_not_what_is_allowed(spark):
    pages = [
        (1, "http://a.net/1", canonical("http://b.net/2")),
        (2, "https://b.net/2#part", '<meta http-equiv="refresh" content="0;url=http://x.example.org/es/3">'),
        (3, "http://x.example.org/fr/3", canonical("http://a.net/1")),
        (4, "http://c.net/4", canonical("http://d.net/5")),
        (5, "http://d.net/5", None),
        (6, "http://x.com/fr/6", canonical("http://y.com/de/6")),
        (7, "http://y.com/de/6?other", ""),
        (8, "http://e.net/8", canonical("http://y.com/de/nobody")),
        (8, "http://e.net/8", canonical("http://y.com/de/nobody")),
        (None, None, canonical("http://y.com/de/6")),
    ]
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    df = frame(spark, pages)
    got = sorted([(r["page_id"], r["_rule"], r["_verdict"]) for r in judge(df, rules, page_links(df)).collect()], key=repr)
    assert got == sorted([
        (1, None, "block"), (2, None, "block"), (3, "org/", "allow"), (4, None, "allow"), (5, None, "allow"),
        (6, "com/fr/", "allow"), (7, "com/de/", "block"), (8, None, "block"), (8, None, "block"), (None, None, "allow"),
    ], key=repr)


def test_random_links_same_as_sql(spark, tmp_path):
    rng = random.Random(11)
    hosts = ["a.net", "b.example.org", "example.org", "c.com", "xorg", "D.Example.Net"]
    paths = ["/", "/es/1", "/en/1", "/en/2", "/fr/1", "/de/1", "", "/es"]
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?a', '#f'])}" for _ in range(300)]
    ways = [lambda u: canonical(u), lambda u: f"<META http-equiv=refresh content='5; url={u}'>", lambda u: canonical("/es/1"), lambda u: canonical("x/y")]
    rows = [(i, u, rng.choice(ways)(rng.choice(urls)) if rng.random() < 0.15 else "<p>") for i, u in enumerate(urls)]
    rows += [(900, None, None), (None, "nothing", canonical(urls[0])), (901, urls[0], None), (901, urls[0], None)]
    frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/raw")
    next(tmp_path.glob("raw/*.parquet")).rename(tmp_path / "pages.parquet")
    assert differences(spark, connect(str(tmp_path)), "op11", op11_url_filter, SQL["op11_url_filter"], str(tmp_path)) == []


def test_many_rules_longest_wins_and_ties_allow(spark):
    rules = [("com", "/ab", "block"), ("a.com", "/", "allow"), ("a.com", "/", "block"), ("", "/", "block"), (None, "/", "block"),
             ("b.com", None, "block"), *[(f"h{i}.net", f"/{i}", "block") for i in range(500)]]
    addresses = [("x.a.com/abc", "x.a.com", "/abc"), ("b.com", "b.com", ""), ("w.h7.net/70", "w.h7.net", "/70"), ("h7.net/8", "h7.net", "/8"),
                 ("com/ab", "com", "/ab"), ("acom/ab", "acom", "/ab")]
    got = fitting_rules(spark.createDataFrame(addresses, "address string, host string, path string"),
                        spark.createDataFrame(rules, "host string, path string, action string"))
    assert {tuple(r) for r in got.collect()} == {
        ("x.a.com/abc", "a.com/", "allow"), ("b.com", "b.com", "block"), ("w.h7.net/70", "h7.net/7", "block"), ("com/ab", "com/ab", "block"),
    }


def test_hubs_empty_tables_and_clashing_columns(spark):
    rules = spark.createDataFrame([("hub.net", "/bad", "block")], "host string, path string, action string")
    links = spark.range(2000).selectExpr("concat('http://s.net/', id) AS url", "'http://hub.net/bad' AS target")
    pages = spark.range(2000).selectExpr("concat('http://s.net/', id) AS url", "id AS `a.b`", "'x' AS _rule", "'y' AS address", "1 AS rule")
    got = judge(pages, rules, links)
    assert got.columns == ["url", "a.b", "address", "rule", "_host", "_path", "_rule", "_verdict"]
    assert got.where("_verdict = 'block' and _rule is null").count() == 2000
    assert judge(pages.limit(0), rules.limit(0)).count() == 0
    assert judge(pages, rules.limit(0)).where("_verdict = 'allow'").count() == 2000
    assert judge(frame(spark, [(1, "http://" + "l." * 5000 + "net/" + "p" * 500_000, None)]), rules).first()["_verdict"] == "allow"
