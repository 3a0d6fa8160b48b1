import itertools
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from feedloom.llm import urls
from feedloom.llm.urls import RULES, mined_rules, token_classes, tokens_of, url_verdicts


def mined(spark, rows):
    labelled = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row long, tokens array<string>, verdict string")
    return mined_rules(labelled, token_classes(labelled, math.ceil(urls.MIN_SUPPORT * len(rows))), len(rows)).collect()


def brute(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (re.sub("[A-Z]", lambda c: c.group().lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


URLS = [
    "http://a.example.com/en/1", "https://www.example.com/en/", "https://x.www.EXAMPLE.com/en/2?q=1", "http://b.net/es/3#x", "http://net/fr/",
    "http://c.net/de/3", "http://d.org/en/9.html", "http://example.com", "http://example.com?x", "ftp://com/", "no scheme", "", None, "://", "a://b://c/d",
    "http://notexample.com/en/1", "http://É.com/x", "http://com.evil.org/en/", "http://example.com:80/en/1",
]


def test_listed_rules_against_brute_force(spark, clashing):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    for r in url_verdicts(clashing(pages)).collect():
        host, path, rule, verdict = brute(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert verdict is None or r["verdict"] == verdict
        assert r["verdict"] in ("allow", "block")
    assert url_verdicts(pages.limit(0)).count() == 0


def test_verdicts_are_mined(spark):
    rows = [(i, f"http://h{i}.{'net/es' if i % 2 else 'com/de'}/{i}") for i in range(300)]
    rows += [(1000, "http://z.org/es/7"), (1001, "http://z.org/de/7"), (1002, "http://z.org/qq")]
    got = {r["page_id"]: r["verdict"] for r in url_verdicts(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert (got[1000], got[1001], got[1002]) == ("block", "allow", "allow")


def test_rules_are_pruned(spark):
    rows = [(["a", "b"], "block")] * 50 + [(["b", "c"], "allow")] * 50 + [(["a", "c"], "block")] * 50
    found = mined(spark, rows)
    best = {(tuple(r["tokens"]), r["says"]) for r in found}
    assert (("a",), "block") in best and not any(len(t) > 1 and "a" in t and s == "block" for t, s in best)
    assert all(r["confidence"] >= 0.6 and r["anchor"] in r["tokens"] for r in found)


@pytest.mark.parametrize("url, some", [("http://a-b.c.org/en/12.html?x=1&y#f", {"end:org", "host:a", "host:b", "dir0:en", "dir1:0", "query:x", "kind:html", "fragment:"}), ("x", set())])
def test_tokens(spark, url, some):
    got = spark.createDataFrame([(url,)], "u string").select(tokens_of(F.col("u"))).first()[0]
    assert some <= set(got) and len(got) == len(set(got)) and (some or not got)


def test_rules_may_need_many_tokens(spark):
    four = ["a", "b", "c", "d"]
    rows = [(four, "block")] * 50 + [([x for x in four if x != gone], "allow") for gone in four for _ in range(100)]
    found = mined(spark, rows)
    assert [(tuple(r["tokens"]), r["says"]) for r in found if r["says"] == "block"] == [(tuple(four), "block")]


def best_of(rows, tokens):
    """The verdicts of the surest rules of any length whose tokens are all there."""
    best, says = (0.0, 0.0), set()
    for size in range(1, len(tokens) + 1):
        for needs in itertools.combinations(sorted(tokens), size):
            met = [v for t, v in rows if set(needs) <= set(t)]
            for verdict in ("allow", "block"):
                n = met.count(verdict)
                if n < math.ceil(urls.MIN_SUPPORT * len(rows)) or n / len(met) < urls.MIN_CONFIDENCE:
                    continue
                mark = (n / len(met), n / len(rows))
                if mark > best:
                    best, says = mark, set()
                if mark == best:
                    says.add(verdict)
    return says or {urls.DEFAULT}


@pytest.mark.parametrize("seed", range(3))
def test_mined_verdicts_against_all_combinations(spark, monkeypatch, seed):
    monkeypatch.setattr(urls, "MIN_SUPPORT", 0.03)
    rng = random.Random(seed)
    names = "abcdef"
    listed, open_urls = [], []
    for i in range(150):
        own = [c for c in names if rng.random() < 0.4] + (["t1", "t2", "t3"] if i % 9 == 0 else [])
        block = rng.random() < (0.9 if "a" in own and "b" in own else 0.3)
        listed.append((i, f"http://x.{'net/es' if block else 'com/de'}/?" + "&".join(f"{c}=1" for c in own)))
    for i in range(40):
        own = [c for c in names if rng.random() < 0.4] + rng.sample(["t1", "t2", "t3"], rng.randrange(3))
        open_urls.append((1000 + i, "http://x.org/?" + "&".join(f"{c}=1" for c in own)))
    pages = spark.createDataFrame(listed + open_urls, "page_id long, url string")
    tokens = {r["page_id"]: r["t"] for r in pages.select("page_id", tokens_of(F.col("url")).alias("t")).collect()}
    rows = [(tokens[i], "block" if "net/es" in u else "allow") for i, u in listed]
    got = {r["page_id"]: r["verdict"] for r in url_verdicts(pages).collect()}
    for i, _ in open_urls:
        assert got[i] in best_of(rows, tokens[i])


def test_many_tokens_that_come_together(spark):
    names = "&".join(f"n{k}=1" for k in range(40))
    rows = [(i, f"http://h{i % 7}.{'net/es' if i % 2 else 'com/de'}/p{i % 5}?{names if i % 20 < 2 else 'q=1'}") for i in range(600)]
    rows += [(1000, f"http://z.org/?{names}"), (1001, "http://z.org/?n3=1")]
    begun = time.perf_counter()
    got = {r["page_id"]: r["verdict"] for r in url_verdicts(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert time.perf_counter() - begun < 60 and len(got) == 602
    assert got[1000] == got[1001]
