import random
import re

import pytest

from mercato.llm import url_filters as U
from mercato.llm.queries import URL_RULES


def brute(url, rules, default="allow"):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (not r[0] or host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if not fits:
        return host, path, None, default
    top = max(fits, key=lambda r: (len(r[0].split(".")) if r[0] else 0, len(r[1]), r[2] == "block"))
    return host, path, top[0] + top[1], top[2]


URLS = [
    None, "", "no scheme", "://", "http://", "http://net", "http://NET/", "x://a.net/", "http://a.net?/x", "http://example.net/en/1", "http://example.net/en", "http://m.Example.net/EN/1",
    "http://notexample.net/en/1", "http://example.com/de/", "http://example.com/deu", "http://b.org/fr/a?b=/c", "http://b.org/fr#/", "http://u@a.net/x", "http://a.net:80/x", "http://a.net./x",
    "http://.net/x", "http://ÄÖ.net/ü", "http://a.net/" + "d/" * 3000, "http://" + "s." * 500 + "net/x", "http://a.net/x\ny", "a://b://c.net/",
]


def test_contract_rules_equal_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "h", "allow", 1) for i, u in enumerate(URLS)] + [(None, URLS[9], "h", "x", 2), (3, URLS[9], "h", "x", 2), (3, URLS[9], "h", "x", 2)], "page_id long, url string, host string, verdict string, rule int")
    got = sorted(map(tuple, U.judge_urls(pages, U.rules_frame(spark, URL_RULES)).collect()), key=str)
    assert got == sorted([(r.page_id, *brute(r.url, URL_RULES)) for r in pages.collect()], key=str)
    assert U.judge_urls(pages.limit(0), U.rules_frame(spark, URL_RULES)).count() == 0
    kept = U.drop_blocked(pages, U.rules_frame(spark, URL_RULES))
    assert kept.schema == pages.schema
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([tuple(r) for r in pages.collect() if brute(r.url, URL_RULES)[3] == "allow"], key=str)


def random_rules(rnd, n):
    labels, segments = ["a", "b", "net", "org"], ["", "x", "xy", "y", "x.html"]
    out = {}
    for _ in range(n):
        host = ".".join(rnd.choice(labels) for _ in range(rnd.randrange(0, 4)))
        path = rnd.choice(["", "/"]) + "/".join(rnd.choice(segments) for _ in range(rnd.randrange(0, 4)))
        out[host, path] = rnd.choice(["allow", "block"])
    return [(h, p, v) for (h, p), v in out.items()]


@pytest.mark.parametrize("seed,most", [(1, U.MOST_RULES), (2, 0), (3, 0)])
def test_trie_and_join_equal_brute_force(spark, monkeypatch, seed, most):
    rnd = random.Random(seed)
    rules = random_rules(rnd, 60)
    urls = ["http://" + ".".join(rnd.choice(["a", "b", "net", "org", "q"]) for _ in range(rnd.randrange(0, 5))) + rnd.choice(["", "/"]) + "/".join(rnd.choice(["", "x", "xy", "xyz", "y", "x.html5"]) for _ in range(rnd.randrange(0, 6))) + rnd.choice(["", "?a/b", "#c"]) for _ in range(300)]
    monkeypatch.setattr(U, "MOST_RULES", most)
    rows = list(enumerate(urls + [None]))
    got = U.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), U.rules_frame(spark, rules), default="block").collect()
    assert {r.page_id: tuple(r)[1:] for r in got} == {i: brute(u, rules, "block") for i, u in rows} and len(got) == len(rows)


def test_places_and_verdicts(spark):
    trie = U.UrlTrie([("a.b", "/x", "allow"), ("a.b", "/x", "block"), ("b", "", "allow"), ("", "/q/", "block")])
    assert trie.find("c.a.b", "/xyz/1") == ("a.b/x", "block") and trie.find("a.b", "/y") == ("b", "allow")
    assert trie.find("z", "/q/1") == ("/q/", "block") and trie.find("z", "/q") is None and trie.find("", "") is None
    pages = spark.createDataFrame([(1, "http://A.b/x"), (2, "http://c/")], "page_id long, url string")
    rules = U.rules_frame(spark, [("a.B", "/x", "allow"), ("A.b", "/x", "block"), (None, None, "allow")])
    assert {r.page_id: (r.rule, r.verdict) for r in U.judge_urls(pages, rules, default="block").collect()} == {1: ("a.b/x", "block"), 2: ("", "allow")}
    assert {r.verdict for r in U.judge_urls(pages, rules.limit(0), default="block").collect()} == {"block"}
    with pytest.raises(ValueError):
        U.judge_urls(pages, rules, default="maybe")
    with pytest.raises(Exception, match="allow or block"):
        U.judge_urls(pages, U.rules_frame(spark, [("a", "/", "deny")])).collect()
