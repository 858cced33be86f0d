"""URL rules against plain rules and plain counts of token sets."""

import itertools
import re

from pyspark.sql import functions as F

from uptrail.llm import urls
from uptrail.llm.urls import Rule

RULES = [Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"), Rule("com", "/fr/", "allow"),
         Rule("com", "/de/", "block")]


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule(url):
    host, path = parts(url)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.host + r.path), default=None)


URLS = [None, "", "no scheme", "http://", "http://ORG/", "https://a.example.org/en/1x", "https://example.org/en/2", "https://badexample.org/es/",
        "http://x.example.com/de/1?a#b", "http://x.COM/fr/", "http://com", "http://com/de", "a://b://c/d", "http://h.org?x=/es/", "x\ny://q.com/de/z",
        "http://example.org/es/1#t", "http://É.org/a"]


def test_fixed_rules(spark):
    df = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS)] + [(0, URLS[5], "mine")], "page_id long, url string, rule string")
    none = spark.createDataFrame([], "url string, bad boolean")
    got = urls.judged(df, none, RULES)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    for r in got.collect():
        want = rule(r["url"])
        assert (r["host"], r["path"]) == parts(r["url"])
        assert (r["rule"], r["verdict"]) == ((want.host + want.path, want.verdict) if want else (None, "allow"))
    assert got.count() == len(URLS) + 1


def tokens(url):
    host, path = parts(url)
    query = url.split("?", 1)[1].split("#")[0] if "?" in url else ""
    return {t for t in [*("h:" + x for x in re.split(r"[.\-_]", host)), *("p:" + lower(x) for x in re.split(r"[/.\-_]", path)),
                        *("q:" + lower(x.split("=")[0]) for x in query.split("&"))] if len(t) > 2}


def test_mined_rules(spark):
    seen = []
    for i in range(400):
        word, lang, par = ("casino" if i % 5 == 0 else "news"), ("en" if i % 3 else "de"), ("?ref=x" if i % 2 else "")
        bad = word == "casino" and lang == "en" and i % 35 != 0
        seen.append((f"http://{word}.site{i % 7}.test/{lang}/{i}{par}", bad))
    sets = [(tokens(u), b) for u, b in seen]
    least, confidence = 20, 0.8
    counts = {}
    for items, bad in sets:
        for n in range(1, len(items) + 1):
            for s in itertools.combinations(sorted(items), n):
                c = counts.setdefault(s, [0, 0])
                c[0] += 1
                c[1] += bad
    found = {s: c[1] / c[0] for s, c in counts.items() if c[1] >= least and c[1] / c[0] >= confidence}
    rules = {s for s in found if not any(t in found and found[t] >= found[s] for t in itertools.combinations(s, len(s) - 1))}
    assert rules
    df = spark.createDataFrame(seen, "url string, bad boolean")
    got = {tuple(sorted(r["items"])) for r in urls.mined(df, "url", "bad", 0.002, least, confidence).groupBy("rule").agg(
        F.collect_list("item").alias("items")).collect()}
    assert got == rules
    new = [("http://casino.other.test/en/9",), ("http://casino.other.test/fr/9",), ("http://news.site1.test/en/1",), (None,), ("http://casino.x.org/en/",)]
    out = urls.judged(spark.createDataFrame(new, "url string"), df.union(spark.createDataFrame([(None, True), ("u", None)], df.schema)), RULES)
    for r in out.collect():
        want = rule(r["url"])
        mine = r["url"] is not None and any(set(s) <= tokens(r["url"]) for s in rules)
        assert r["verdict"] == (want.verdict if want else "block" if mine else "allow"), r
