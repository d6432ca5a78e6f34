"""URL filters: hosts, paths and rules against plain Python, the trees on URLs with a known kind."""

import random

from rightsweave.llm import urls
from rightsweave.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, host string, found string, last string, __label string, probability string"


def brute(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host = rest[:min(ends)] if ends else rest
    path = rest[len(host):]
    ends = [path.find(c) for c in "?#" if c in path]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path[:min(ends)] if ends else path


def brute_rule(host, path):
    fits = []
    for verdict, rule in URL_RULES:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


ODD = [None, "", "no scheme", "://", "http://", "HTTP://A.Net/x", "http://net/", "http://net", "http://net?x", "http://example.net/en/a",
       "http://m.example.net/EN/", "http://badnet/", "x://a.org/fr/?u=http://b.net/", "http://example.com/de/1#q", "http://example.com/den",
       "http://a.com/\nb?c", "http://ÀB.NET/é", "http://a.net:80/", "a://b://c/d", "http://" + "a" * 5000 + ".org/fr/" + "9" * 5000]


def frame(spark, found):
    return spark.createDataFrame([(i, u, "h", "f", "l", "b", "p") for i, u in enumerate(found)], SCHEMA)


def test_odd_rows(spark):
    found = ODD + ["http://a.net/1", "http://a.net/1"]
    rows = urls.judge(frame(spark, found), ["page_id"], URL_RULES, trees=2).collect()
    assert len(rows) == len(found)
    for r in rows:
        assert (r.host, r.path) == brute(found[r.page_id])
        rule, verdict = brute_rule(r.host, r.path)
        assert r.rule == rule and r.verdict == (verdict or ("block" if r.block_score >= 0.5 else "allow"))


def test_rules_of_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = urls.judge(pages, ["page_id", "url"], URL_RULES, trees=2).collect()
    assert len(rows) == pages.count()
    for r in rows:
        assert (r.host, r.path) == brute(r.url) and r.rule == brute_rule(r.host, r.path)[0]


def test_trees_learn_what_the_rules_show(spark):
    random.seed(2)
    word = lambda n: "".join(random.choices("abcdefgh", k=n))
    good = [f"https://{word(6)}.good.org/fr/{word(8)}" for _ in range(150)]
    bad = [f"http://{word(4)}-{random.randint(10 ** 6, 10 ** 8)}.net/{random.randint(10 ** 9, 10 ** 11)}?a=1&b={random.randint(1, 999)}&c=2"
           for _ in range(150)]
    new_good = [f"https://{word(6)}.site.org/en/{word(8)}" for _ in range(50)]
    new_bad = [f"http://{word(4)}-{random.randint(10 ** 6, 10 ** 8)}.xyz/{random.randint(10 ** 9, 10 ** 11)}?a=1&b=2&c=2" for _ in range(50)]
    rows = urls.judge(frame(spark, good + bad + new_good + new_bad), ["page_id"], URL_RULES).collect()
    verdicts = {r.page_id: r.verdict for r in rows}
    assert sum(verdicts[i] == "allow" for i in range(300, 350)) >= 45
    assert sum(verdicts[i] == "block" for i in range(350, 400)) >= 45


def test_one_kind_none_and_empty(spark):
    blocked = urls.judge(frame(spark, ["http://a.net/", "http://b.com/"]), ["page_id"], URL_RULES).collect()
    assert {r.verdict for r in blocked} == {"block"}
    allowed = urls.judge(frame(spark, ["http://b.com/", None]), ["page_id"], URL_RULES).collect()
    assert {r.verdict for r in allowed} == {"allow"}
    assert urls.judge(frame(spark, []), ["page_id"], URL_RULES).count() == 0
