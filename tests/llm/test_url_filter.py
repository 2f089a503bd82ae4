"""URL filters against trying every rule on every URL, and against the SQL counterpart."""

from __future__ import annotations

import random
import re

import pytest

from tillroll.llm import oracles
from tillroll.llm.queries import SITE_RULES, op13_url_filters
from tillroll.llm.url_filter import PATTERNS, Rule, filter_urls, lowered

FIELDS = "page_id long, url string"
CLASHING = "host string, path string, rule string, __host int, token string"


def pages(spark, rows):
    return spark.createDataFrame(
        [(*r, "h", "p", "r", 1, "t") for r in rows], f"{FIELDS}, {CLASHING}"
    )


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host, address = lowered(host), lowered(host) + rest[len(host) :]
    fits = []
    for rule in dict.fromkeys(rules):
        if rule.site:
            name, slash, start = rule.text.partition("/")
            name = lowered(name)
            fit = (host == name or host.endswith("." + name)) and path.startswith(slash + start)
        else:
            fit = re.search(rule.regex().replace(r"\z", r"\Z"), lowered(address)) is not None
        if fit:
            fits.append((rule.site, len(rule.text), rule.action == "allow", rule.text))
    best = max(fits, default=(None, 0, True, None))
    site = best[3] if best[0] else None
    pattern = best[3] if best[0] is False else None
    return host, path, site, pattern, "allow" if best[2] else "block"


def check(spark, rows, rules):
    got = filter_urls(pages(spark, rows), rules).collect()
    want = [(i, *plain(u, rules)) for i, u in rows]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    return {(r["page_id"], r["host"]): r for r in got}


EDGES = [
    (1, None),
    (2, ""),
    (3, "no scheme/net/"),
    (4, "://"),
    (5, "http://NET/"),
    (6, "http://net"),
    (7, "http://net?x=/"),
    (8, "ftp://a.b.Example.NET/en/x?y=://z"),
    (9, "http://example.net/EN/"),
    (10, "http://anet/ http://casino.net/"),
    (11, "http://example.com/de/#casino"),
    (12, "http://org/fr/"),
    (12, "http://org/fr/"),
    (None, "http://x.org/fr/casino"),
    (13, "http://é.example/\ncasino\n"),
    (14, "http://long.example/" + "a/" * 60000 + "poker"),
    (15, "http://shop.example/spam-filter/casino-x"),
    (16, "http://shop.example/thecasino/casinos"),
    (17, "http://shop.example/?q=CASINO"),
]


def test_edges(spark):
    got = check(spark, EDGES, SITE_RULES + PATTERNS)
    assert got[8, "a.b.example.net"]["rule"] == "example.net/en/"
    assert got[6, "net"]["rule"] is None
    assert got[14, "long.example"]["pattern"] == "^poker^"
    assert got[15, "shop.example"]["verdict"] == "allow"
    assert got[16, "shop.example"]["pattern"] is None


def test_empty_table_and_no_rules(spark):
    assert filter_urls(pages(spark, EDGES).limit(0), SITE_RULES).collect() == []
    check(spark, EDGES, [])


def test_random_rules_against_all_rules(spark):
    r = random.Random(5)
    words = ["net", "en", "ads", "x1", "shop", "a", "de"]
    word = lambda: r.choice(words)
    rules = [
        Rule(r.choice(["allow", "block"]), f"{word()}.{word()}/{word()}{r.choice(['/', ''])}", True)
        for _ in range(30)
    ]
    rules += [Rule("block", word(), True), Rule("allow", "*", False), Rule("block", "Shop/De", True)]
    rules += [
        Rule(
            r.choice(["allow", "block"]),
            "".join(r.choice(["^", "*", "-", "/", ""]) + word() for _ in range(r.randrange(1, 4)))
            + r.choice(["^", "*", ""]),
        )
        for _ in range(60)
    ]
    rows = [
        (
            i,
            "http://" + ".".join(word() for _ in range(r.randrange(1, 4)))
            + "".join(r.choice("/-?=.") + word() for _ in range(r.randrange(5))),
        )
        for i in range(400)
    ]
    check(spark, rows, rules)


def test_rules_are_filed_under_tokens_that_stand_alone():
    assert Rule("block", "example.net/en/", True).tokens() == ["en", "example", "net"]
    assert Rule("block", "example.net/en", True).tokens() == ["example", "net"]
    assert Rule("block", "net", True).tokens() == ["net"]
    assert Rule("block", "^casino*win^").tokens() == []
    assert Rule("block", "ads/^track^").tokens() == ["track"]


def test_sql_counterpart(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    from compare import difference

    assert difference(op13_url_filters(spark, sf_dir), con, oracles.op13()) is None


def test_no_python_and_no_shuffle(spark, sf_dir, capsys):
    op13_url_filters(spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert "html" not in plan.split("ReadSchema")[1].split("\n")[0]
