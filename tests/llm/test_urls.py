"""URL rules and alias classes against plain Python."""

from __future__ import annotations

import random
import re

from oracle import compare, connect

from rollcall.llm import url_filters
from rollcall.llm.url_filters import OP3_SQL, RULES, alias_links, judge, op3_url_filters

FOLDER = "/root/testdata/sf0.01"


def parts(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    host, path, query = re.match(r"([^/?#]*)([^?#]*)(\?[^#]*)?", rest).groups()
    return "".join(c.lower() if c < "\x7f" else c for c in host), path, query or ""


def rule(host, path, rules):
    """The longest rule that fits; the longer host, then allow, among equals."""
    fits = [(-len(h) - len(p), -len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return min(fits)[:1:-1] if fits else (None, None)


def expected(pages, links, rules=RULES):
    node = lambda url: (lambda h, p, q: h + (p or "/") + q if h else None)(*parts(url))
    root = {}

    def top(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in links:
        if node(a) and node(b):
            root[top(node(a))] = top(node(b))
    verdicts = {}
    for k in list(root):
        host, path, _ = parts("x://" + k)
        verdicts.setdefault(top(k), set()).add(rule(host, path, rules)[1])
    out = []
    for key, url in pages:
        host, path, _ = parts(url)
        own, verdict = rule(host, path, rules)
        alias = verdicts.get(top(node(url)), set()) if node(url) else set()
        out.append((key, host, path, own, verdict or ("block" if "block" in alias and "allow" not in alias else "allow")))
    return sorted(out, key=repr)


def test_query_matches_sql(spark):
    assert compare(op3_url_filters(spark, FOLDER), connect(FOLDER), OP3_SQL) == 250


def test_random_links(spark, rows):
    draw = random.Random(6)
    hosts = ["a.org", "b.org", "WWW.Example.com", "example.com", "n.net", "xnet", "c.org", "d.org", "com"]
    address = lambda: f"{draw.choice(['http', 'https'])}://{draw.choice(hosts)}{draw.choice(['', '/', '/en/1', '/es/2', '/fr/', '/x'])}{draw.choice(['', '?q=1', '#f'])}"
    pages = [(k, address()) for k in range(150)] + [(1, None), (None, "no address"), (2, ""), (3, "http://"), (3, "http://")]
    links = [(address(), address()) for _ in range(14)] + [(None, address()), ("nothing", address())]
    table = spark.createDataFrame([(*row, "h", "v") for row in pages], "page_id int, url string, host string, verdict string")
    found = judge(table, spark.createDataFrame(links, "source string, target string"))
    assert rows(found) == expected(pages, links)


def test_links_of_pages(spark, rows):
    html = {
        1: '<head><LINK href="http://q.net/es/1" rel="canonical"><link rel=stylesheet href="/no.css">',
        2: "<meta content='3; URL=/z' http-equiv='Refresh'>",
        3: "<link rel='canonical' href='//A.org/x'>",
        4: "<link rel=canonical href=y.html><link rel=canonical href=?p=2>",
        5: None,
        6: "<link rel=canonical href=''><meta name=refresh content='url=/no'>",
    }
    pages = spark.createDataFrame([(f"http://h.org/d/{k}", text) for k, text in html.items()], "url string, html string")
    found = alias_links(pages).filter("target is not null")
    assert rows(found) == [
        ("http://h.org/d/1", "http://q.net/es/1"),
        ("http://h.org/d/2", "http://h.org/z"),
        ("http://h.org/d/3", "http://A.org/x"),
        ("http://h.org/d/4", "http://h.org/d/4?p=2"),
        ("http://h.org/d/4", "http://h.org/d/y.html"),
    ]


def test_allow_comes_before_block_in_a_class(spark, rows):
    pages = [(1, "http://a.org/"), (2, "http://b.org/"), (3, "http://n.net/es/")]
    table = spark.createDataFrame(pages, "page_id int, url string")
    links = [("http://a.org", "https://n.net/es/")]
    one = lambda some: [r[-1] for r in rows(judge(table, spark.createDataFrame(some, "source string, target string")))]
    assert one(links) == ["block", "allow", "block"]
    assert one([*links, ("http://n.net/es/", "http://x.com/")]) == ["allow", "allow", "block"]


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id int, url string, html string")
    assert judge(pages, alias_links(pages)).count() == 0
    one = spark.createDataFrame([(1, "http://a.org", None)], "page_id int, url string, html string")
    assert judge(one, alias_links(one), rules=()).first().verdict == "allow"


def test_random_rules(spark, rows):
    draw = random.Random(8)
    host = lambda: ".".join(draw.choices(["a", "b", "é", ""], k=draw.randrange(1, 5)))
    path = lambda: "".join(draw.choices(["/", "a", "é"], k=draw.randrange(5)))
    rules = [(host(), path(), draw.choice(["allow", "block"])) for _ in range(60)]
    pages = [(k, f"http://{host()}/{path()}") for k in range(200)] + [(-1, None), (-1, "x")]
    best = {(h, p): min(v for a, b, v in rules if (a, b) == (h, p)) for h, p, _ in rules}
    nothing = spark.createDataFrame([], "source string, target string")
    found = judge(spark.createDataFrame(pages, "page_id int, url string"), nothing, rules)
    assert rows(found) == expected(pages, [], [(*k, v) for k, v in best.items()])


def test_many_rules_of_one_host(spark):
    """A table of rules of any length: what meets a page are their different lengths, not the rules."""
    rules = spark.range(30_000).selectExpr("'example.com' AS host", "concat('/', id) AS path", "if(id % 2 = 0, 'block', 'allow') AS verdict")
    pages = spark.range(30_000).selectExpr("id AS page_id", "concat('https://www.example.com/', id, '/x') AS url")
    wrong = judge(pages, spark.createDataFrame([], "source string, target string"), rules)
    wrong = wrong.filter("verdict <> if(page_id % 2 = 0, 'block', 'allow') OR rule <> concat('example.com/', page_id) OR rule IS NULL")
    assert wrong.count() == 0
    lengths = url_filters.fitting_rules(pages.selectExpr("'example.com' AS host", "concat('/', page_id) AS path"), url_filters.rule_table(spark, rules))
    assert lengths.count() == 30_000
