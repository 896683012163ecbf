"""Range join of urls and rules against a nested loop."""
import itertools

import pytest

from sparkwright.llm.url_filter import judge_urls

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("a.net", "", "allow"), ("net", "/e", "allow"), ("b.a.net", "/es/x", "block"),
         ("net", "/es/", "allow"), ("com", "/en/deep/", "allow"), (None, "/", "block"), ("org", None, "block")]


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
    tail = rest[n:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fit = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules if h is not None and p is not None
           and host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else default


def urls():
    hosts = ["com", "example.com", "www.example.com", "x.www.Example.COM", "notexample.com", "net", "a.net", "b.a.net", "ba.net",
             "c.b.a.net", "org", "", "net:80", "é.net"]
    tails = ["", "/", "/en", "/en/", "/en/x?q=/es/#f", "/es/", "/es/xy", "/e", "?/en/", "#a", "/en/deep/z"]
    return [None, "", "no scheme/en/", "://", "http://"] + [f"http://{h}{t}" for h, t in itertools.product(hosts, tails)] + ["http://a.net/"] * 50


@pytest.mark.parametrize("rules", [RULES, RULES[:1], [], [("net", "", "block")]])
def test_against_nested_loop(spark, rules):
    pages = spark.createDataFrame([(i if i % 7 else None, u, "t", "r", "k") for i, u in enumerate(urls())],
                                  "page_id long, url string, rule string, key string, row string")
    got = judge_urls(pages.repartition(3), spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    want = [(i if i % 7 else None, *brute(u, rules)) for i, u in enumerate(urls())]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_empty_pages(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert judge_urls(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0


def test_no_python_in_the_plan(spark):
    rules = spark.createDataFrame(RULES[:3], "host string, path string, verdict string")
    plan = judge_urls(spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string"), rules)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
