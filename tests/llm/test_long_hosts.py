"""URL filters on hosts of very many labels, equal rules, and expressions that most sites share."""

import time

from stratavox.llm import urls


def pages(spark, given):
    return spark.createDataFrame(list(enumerate(given)), "page_id long, url string").repartition(3)


def test_a_host_of_half_a_million_labels(spark):
    long = "a." * 500_000
    given = [f"http://{long}example.org/es/x", f"http://{long}net/", f"http://{long}", "http://org/", "http://x.com/de/1"]
    began = time.time()
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.verdicts(pages(spark, given)).collect()}
    assert got == {0: ("example.org/es/", "block"), 1: (None, "allow"), 2: (None, "allow"), 3: ("org/", "allow"), 4: ("com/de/", "block")}
    assert time.time() - began < 60


def test_rules_of_many_label_counts_and_equal_rules(spark):
    rules = [("a.b.c.d", "/", "block"), ("c.d", "/", "allow"), ("d", "/p", "block"), ("c.d", "/", "block"), ("", "/", "block"), (".d", "/", "allow")]
    given = ["x://a.b.c.d/p", "x://z.c.d/", "x://d/p/q", "x://q.d/", "x:///", "x://end./", "x://.d/", None, "a.b.c.d/"]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.verdicts(pages(spark, given), rules, "none").collect()}

    def plain(url):
        host, _, path = (url or "").partition("://")[2].partition("/")
        path = "/" + path if url and url.count("/") > 2 else ""
        if not url or "://" not in url:
            host, path = "", ""
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1:] if fits else (None, "none")

    assert got == {k: plain(u) for k, u in enumerate(given)}
    assert got[1] == ("c.d/", "block")


def test_sites_that_share_an_expression(spark):
    given = [f"http://h{i}.example.com/de/{i}" for i in range(3000)] + [f"http://h{i}.example.net/" for i in range(10)]
    got = urls.verdicts(pages(spark, given)).groupBy("rule", "verdict").count().collect()
    assert sorted(((r["rule"], r["verdict"], r["count"]) for r in got), key=repr) == sorted([("com/de/", "block", 3000), (None, "allow", 10)], key=repr)
