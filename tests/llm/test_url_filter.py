"""URL rules against plain matching; the cascade is exact for every key."""

from __future__ import annotations

import random

from ledgerloom.llm import url_filter as uf
from ledgerloom.llm.queries import URL_RULES


def plain(url, rules, otherwise="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("#")[0].split("?")[0]
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if not fit:
        return host, path, None, otherwise
    best = max(fit, key=lambda r: (len(r.key), len(r.host)))
    return host, path, best.key, best.verdict


URLS = [
    None, "", "no scheme", "://", "http://", "http://com", "http://com/", "HTTP://WWW.EXAMPLE.com/en/x?q#f",
    "https://example.com/en/", "https://notexample.com/en/", "https://a.b.net/fr/1", "https://net/es/", "ftp://x.net/ES/",
    "x://y://z.com/p", "http://example.com?/en/", "http://example.com#/en/", "http://É.com/é", "http://" + "a." * 300 + "com/" + "p" * 5000,
    "http://com/en/", "http://example.com/en", "http://..com/", "http://.com/",
]


def judged(spark, urls, rules, **more):
    df = spark.createDataFrame([(i, u, "?", "?") for i, u in enumerate(urls)], "page_id long, url string, _keys string, rule string")
    rows = uf.judge(df.repartition(3), rules, **more).collect()
    assert len(rows) == len(urls) and all(r._keys == "?" for r in rows)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}


def test_rules_of_the_query(spark):
    got = judged(spark, URLS * 2, URL_RULES)
    assert got == {i: plain(u, URL_RULES) for i, u in enumerate(URLS * 2)}


def test_many_rules_in_blocks(spark):
    rng = random.Random(5)
    names = ["a", "b", "cc", "d-e"]
    host = lambda: ".".join(rng.choice(names) for _ in range(rng.randint(1, 3)))
    path = lambda: "/" + "/".join(rng.choice(names) for _ in range(rng.randint(0, 3)))
    rules = list({r.key: r for r in (uf.Rule(rng.choice(["allow", "block"]), host(), path()) for _ in range(150))}.values())
    urls = [f"http://{host()}{path()}" for _ in range(400)]
    want = {i: plain(u, rules, "block") for i, u in enumerate(urls)}
    for keys_per_block in (10**6, 60):
        assert judged(spark, urls, rules, otherwise="block", keys_per_block=keys_per_block) == want


def test_cascade_is_exact(spark):
    rows = [(f"k{i}", i % 7 == 0) for i in range(4000)]
    universe = spark.createDataFrame(rows, "key string, listed boolean")
    levels = uf.cascade(universe)
    assert len(levels) > 2  # so some keys were false positives
    asked = universe.withColumn("words", uf._words_of(levels))
    got = asked.select("listed", uf.listed(asked["key"], levels, asked["words"]).alias("found")).collect()
    assert all(r.listed == r.found for r in got)


def test_no_rules_and_no_pages(spark):
    assert judged(spark, ["http://a.com/"], []) == {0: ("a.com", "/", None, "allow")}
    empty = spark.createDataFrame([], "page_id long, url string")
    assert uf.judge(empty, URL_RULES).count() == 0
