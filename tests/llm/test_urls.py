from __future__ import annotations

import re

from venuelens.llm import urls

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

URLS = [
    None, "", "no scheme", "http://", "http://a.net", "HTTP://A.NET/", "http://net/x", "http://xnet/", "https://a.example.NET/en/1", "https://example.net/en", "https://badexample.net/en/1",
    "https://a.example.com/de/1?x", "https://a.example.com/fr/1", "http://org/fr/", "http://b.org/fr/casino", "http://b.org/casino", "http://casinos.org/", "http://a-casino.org/", "http://CASINO.org",
    "http://x.org/free?bets", "http://x.org/free", "http://x.org/free-free", "http://x.org/freebets", "http://x.org?u=http://a.net/", "a://b://c", "http://h#f/x", "http://u@h.net:80/p", "x\ny://h.net/\n?z",
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest).group().translate(LOWER)
        path = re.match("[^?#]*", rest[len(host) :]).group()
    rule = verdict = None
    for text, name, start, says in (("net/", "net", "/", "block"), ("example.net/en/", "example.net", "/en/", "allow"), ("example.com/de/", "example.com", "/de/", "block"), ("org/fr/", "org", "/fr/", "allow")):
        if (host == name or host.endswith("." + name)) and path.startswith(start) and (rule is None or len(text) > len(rule)):
            rule, verdict = text, says
    found = re.split("[^a-z0-9]", (url or "").translate(LOWER))
    strict, soft = len(set(urls.STRICT) & set(found)), len(set(urls.SOFT) & set(found))
    return host, path, rule, verdict or ("block" if strict or soft >= 2 else "allow"), strict, soft


def test_agrees_with_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[5], "x"), (3, URLS[3], "x")], "page_id long, url string, host string")
    got = urls.judge_urls(pages).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        assert tuple(r[1:]) == brute(URLS[r.page_id] if r.page_id is not None else URLS[5]), r
    assert urls.judge_urls(pages.limit(0)).count() == 0
    assert {r.verdict for r in urls.judge_urls(pages, rules=(), strict=(), soft=()).collect()} == {"allow"}
