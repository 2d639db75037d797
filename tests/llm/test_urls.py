"""The URL filter against a plain Python walk over the links, and against its SQL."""

import random
import re

import duckdb
import pytest

from quaystone.llm import registry, url_filter

PAGE = "page_id long, url string, html string, host string, verdict int"
RULES = registry.URL_RULES


def canonical(href):
    return f'<html><head><link href="{href}" rel="canonical"></head>text</html>'


def refresh(url):
    return f"<META content='0; URL={url}' HTTP-EQUIV=Refresh>"


def plain_parts(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (found[1].lower(), found[2]) if found else ("", "")


def plain_rule(url, rules):
    host, path = plain_parts(url)
    fits = [(len(h + p), v == "allow", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def plain(pages, links, rules):
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = []
    for page_id, url, *_ in pages:
        rule, verdict = plain_rule(url, rules)
        seen, todo = {url}, [url]
        while todo:
            for n in near.get(todo.pop(), ()):
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        blocks = sorted(r for r, v in (plain_rule(u, rules) for u in seen if u is not None) if v == "block")
        if verdict is None:
            verdict = "block" if blocks else "allow"
        out.append((page_id, *plain_parts(url), rule, verdict, blocks[0] if rule is None and blocks else None))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


HARD = [
    (1, "http://a.test/x", canonical("http://bad.net/x")),                       # blocked over its canonical url
    (2, "http://b.test/y", refresh("http://a.test/x")),                          # and over two links
    (3, "https://w.example.net/en/1", canonical("http://bad.net/x")),            # its own allow is stronger
    (4, "http://c.test/z", canonical("https://w.example.net/en/1")),             # reaches the block through an allowed url
    (5, "HTTP://A.Test/x#top", None),                                            # the same node as page 1
    (6, "http://d.test/q", "<!-- " + canonical("http://bad.net/x") + " -->"),    # not a tag
    (7, "http://d.test/r", "<script>" + canonical("http://bad.net/x") + "</script>"),
    (8, "http://e.test/dir/page", canonical("../up?a=1&amp;b=2")),
    (9, "http://e.test/up?a=1&b=2", canonical("//bad.net/other")),
    (10, "http://f.test/", canonical("mailto:x@bad.net")), (11, "http://f.test/2", canonical("#here")),
    (12, None, canonical("http://bad.net/x")), (13, "no scheme", ""), (14, "", None), (15, "http://net", ""), (16, "http://net?x=/", ""),
    (17, "http://NET/", ""), (18, "http://x.org/fr/", ""), (19, "http://x.org/fr", ""), (20, "http://notexample.com/de/", ""),
    (21, "http://a.b.example.com/de/1", ""), (22, "http://g.test/" + "a/" * 20_000, canonical("http://bad.net/" + "b" * 50_000)),
    (23, "http://" + "a." * 5_000 + "net/", ""), (24, "http://h.test/x", '<link rel="alternate canonical" href=/net/../y>'),
    (25, "http://h.test/y", '<meta http-equiv="refresh" content="5">'), (26, "http://i.test", canonical("http://i.test")),
    (1, "http://a.test/x", canonical("http://bad.net/x")), (1, "http://a.test/x", canonical("http://bad.net/x")), (None, None, None),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "h", 3) for r in HARD], PAGE).repartition(4)


def rule_table(spark, rules=RULES):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


COLS = ("page_id", "host", "path", "rule", "verdict", "blocked_by")


@pytest.mark.parametrize("bound", [200_000, 0])
def test_hard_pages(spark, pages, bound):
    out = url_filter.filter_urls(pages, rule_table(spark), keep=("page_id", "host", "verdict"), broadcast_rules=bound)
    assert out.columns == ["host", "path", "rule", "verdict", "blocked_by", "page_id", "host_src", "verdict_src"]
    assert out.where("host_src <> 'h' or verdict_src <> 3").count() == 0
    links = [("http://a.test/x", "http://bad.net/x"), ("http://b.test/y", "http://a.test/x"), ("https://w.example.net/en/1", "http://bad.net/x"),
             ("http://c.test/z", "https://w.example.net/en/1"), ("HTTP://A.Test/x#top", "http://a.test/x"),
             ("http://e.test/dir/page", "http://e.test/up?a=1&b=2"), ("http://e.test/up?a=1&b=2", "http://bad.net/other"),
             (HARD[21][1], "http://bad.net/" + "b" * 50_000), ("http://h.test/x", "http://h.test/y")]
    want = plain([r for r in HARD], links, RULES)
    got = out.select(*COLS).collect()
    assert order(got) == order(want)
    assert {r["page_id"]: r["verdict"] for r in got if r["page_id"] in (1, 2, 3, 4, 6, 8, 15)} == {
        1: "block", 2: "block", 3: "allow", 4: "block", 6: "allow", 8: "block", 15: "allow"}


def test_same_as_sql(spark, pages):
    con = duckdb.connect()
    con.register("frame", pages.toPandas())
    con.sql("CREATE VIEW pages AS SELECT * FROM frame")
    want = con.sql(registry.OP12_SQL).fetchall()
    got = url_filter.filter_urls(pages, rule_table(spark), keep=("page_id",)).select(*COLS).collect()
    assert len(want) == len(HARD)
    assert order(got) == order([tuple(None if x != x else x for x in r) for r in want])


def test_redirect_log_with_a_hub(spark):
    rng = random.Random(5)
    urls = [f"http://s{k % 7}.{rng.choice(['test', 'net', 'org', 'com'])}/{rng.choice(['fr', 'de', 'p'])}/{k}" for k in range(300)]
    links = [(urls[k], urls[0]) for k in range(1, 100)] + [(rng.choice(urls[100:]), rng.choice(urls[100:])) for _ in range(70)]
    links += [(None, urls[3]), (urls[3], None), (urls[5], urls[5])] + links[:4]
    rules = [("s1.net", "/p/", "block"), ("com", "", "block"), ("s2.com", "/fr/", "allow"), ("s2.com", "/fr/", "block"),
             ("org", None, "block"), (None, "/", "block"), ("test", "/", "watch")]
    log = spark.createDataFrame(links, "from_url string, to_url string")
    pages = spark.createDataFrame([(k, u, None) for k, u in enumerate(urls)], "page_id long, url string, html string")
    got = url_filter.filter_urls(pages, rule_table(spark, rules), redirects=log, keep=("page_id",)).select(*COLS).collect()
    usable = [(h, p or "", v) for h, p, v in rules if h and v in ("allow", "block")]
    assert order(got) == order(plain(list(enumerate(urls)), [e for e in links if None not in e], usable))


def test_empty(spark, pages):
    none = spark.createDataFrame([], PAGE)
    assert url_filter.filter_urls(none, rule_table(spark), keep=("page_id",)).count() == 0
    got = url_filter.filter_urls(pages, rule_table(spark).where("false"), html_col=None, keep=("page_id",)).collect()
    assert len(got) == len(HARD) and all(r["verdict"] == "allow" and r["rule"] is None for r in got)
