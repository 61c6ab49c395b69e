import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quire.llm import url_filter
from quire.llm.catalog import QUERIES, URL_RULES

SF = "/root/testdata/sf0.001"


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def plain_rule(url, rules=URL_RULES):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (lower(m[1]), m[2]) if m else ("", "")
    fits = [(len(r), -i, r, v) for i, (v, r) in enumerate(rules)
            for h, p in [(r[:r.index("/")], r[r.index("/"):])] if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[2:] if fits else (None, None))


def plain_scores(urls, order=url_filter.ORDER):
    """url -> score, by dictionaries; one model per verdict."""
    text_of = {u: lower((u or "").split("://", 1)[-1]) for u in urls}
    counts = {"allow": Counter(), "block": Counter()}
    for u in urls:
        verdict = plain_rule(u)[3]
        if verdict and hashlib.md5(text_of[u].encode()).hexdigest()[0] > "2":
            s = "\x02" + text_of[u] + "\x03"
            for i in range(1, len(s)):
                for k in range(min(order, i) + 1):
                    counts[verdict][s[i - k:i + 1]] += 1
    follow = {v: defaultdict(list) for v in counts}
    for v in counts:
        for g, n in counts[v].items():
            follow[v][g[:-1]].append(n)

    def p(v, gram):
        coarse = p(v, gram[1:]) if len(gram) > 1 else 1 / 256
        seen = follow[v].get(gram[:-1])
        return (counts[v][gram] + len(seen) * coarse) / (sum(seen) + len(seen)) if seen else coarse

    out = {}
    for u in urls:
        s = "\x02" + text_of[u] + "\x03"
        grams = [s[max(0, i - order):i + 1] for i in range(1, len(s))]
        out[u] = sum(math.log(p("allow", g)) - math.log(p("block", g)) for g in grams) / len(grams)
    return out


def test_whole_table_equals_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r.page_id, r.url) for r in pages.select("page_id", "url").collect()]
    got = url_filter.judge(pages, URL_RULES).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule or "") for r in got) == \
        sorted((i, *plain_rule(u)[:2], plain_rule(u)[2] or "") for i, u in rows)
    want = plain_scores([u for _, u in rows])
    by_id = dict(rows)
    for r in got:
        assert math.isclose(r.score, want[by_id[r.page_id]], abs_tol=1e-9)
        if r.rule:
            assert r.verdict == plain_rule(r.url)[3]
    free = [r for r in got if not r.rule]
    allowed, blocked = [r.score for r in free if r.verdict == "allow"], [r.score for r in free if r.verdict == "block"]
    assert not allowed or not blocked or min(allowed) > max(blocked)
    query = QUERIES["op4_url_filter"](spark, SF)
    assert query.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(str(tuple(r)) for r in query.collect()) == \
        sorted(str((r.page_id, r.host, r.path, r.rule, r.verdict)) for r in got)


ODD = [None, "", "no scheme", "http://", "http://NET/", "http://net", "http://a.Example.NET/en/x?y#z", "http://example.net/EN/",
       "http://xexample.com/de/", "http://example.com/de/1", "https://b.example.com/de/#q", "ftp://org/fr/", "x://y://net/",
       "http://h?q://net/", "http://é.org/fr/ü", "http://a.net:80/", "http://" + "a" * 20_000 + ".net/", "http://[\n]/a\nb?c"]


@pytest.mark.parametrize("rules", [URL_RULES, [("allow", "a.b/"), ("block", "b/xx"), ("allow", "b/xx"), ("block", "c/")]])
def test_odd_urls(spark, rules):
    rows = [(i if i else None, u, "x") for i, u in enumerate(ODD + ODD[3:6] + ["q://a.b/xx", "q://z.a.b/xx1", "q://b/xx", "q://b/x"])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string").withColumn("text", F.lit(1))
    out = url_filter.judge(pages, rules).collect()
    assert sorted(str((r.page_id, r.host, r.path, r.rule)) for r in out) == sorted(str((i, *plain_rule(u, rules)[:3])) for i, u, _ in rows)
    assert {r.verdict for r in out} <= {"allow", "block"}
    assert url_filter.judge(pages.filter("false"), rules).count() == 0


def test_threshold(spark):
    def at(rows):
        return url_filter.calibrated(spark.createDataFrame(rows, "score double, a long, r long"))

    t = at([(-1.0, 0, 9), (-0.5, 1, 3), (0.5, 7, 0), (1.0, 3, 0)])
    assert -0.5 < t <= 0.5
    assert at([(0.3, 5, 0)]) == 0.0 and at([(0.3, 0, 5)]) == 0.0
    t = at([(0.1, 0, 5), (0.9, 5, 0)])
    assert 0.1 < t <= 0.9


def test_model_tells_the_classes_apart(spark):
    """URLs that no rule judges follow those that they resemble."""
    rows = [(i, f"http://news{i}.example.net/en/story/{i}") for i in range(120)]
    rows += [(1000 + i, f"http://cheap-pills{i}.net/buy?x={i}") for i in range(120)]
    rows += [(2000, "http://news7.other.com/en/story/9"), (2001, "http://cheap-pills9.com/buy?x=77")]
    got = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect()}
    assert got[2000] == "allow" and got[2001] == "block"
