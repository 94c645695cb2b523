import random
import re

import pytest

from tidemark.llm import urls
from tidemark.llm.urls import bloom_filter, blocks_for, filter_urls, judged, listed, maybe_listed, rule_table
from pyspark.sql import functions as F


def split(url):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def brute(url, rules, otherwise="allow"):
    host, path = split(url)
    fits = []
    for rule_host, rule_path, verdict in rules:
        rule_host = re.sub("[A-Z]", lambda m: m.group().lower(), rule_host)
        rule_path = rule_path or ""
        if rule_path and not rule_path.startswith("/"):
            rule_path = "/" + rule_path
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            rule = rule_host + rule_path
            fits.append((len(rule), len(rule_host), rule, verdict))
    return (host, path, *(max(fits)[2:] if fits else (None, otherwise)))


def pages_of(spark, given):
    return spark.createDataFrame([(i, u, "x", "x") for i, u in given], "page_id long, url string, host string, key string").repartition(3)


RULES = [("org", "/", "allow"), ("Example.org", "/es/", "block"), ("example.org", "en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block"), ("b.c", "/x", "allow"), ("c", "/xyz", "block"), ("same.net", "", "allow"), ("same.net", None, "block")]
URLS = ["http://example.org/es/1?x=/de/", "HTTP://A.EXAMPLE.ORG/en/12#t", "http://notexample.org/es/", "http://example.org", "http://org/",
        "https://a.b.com/de/x", "https://a.b.com/DE/x", "com/de/", None, "", "://", "http:///de/", "http://x.b.c/xyz", "http://c/xyz",
        "http://same.net", "http://x.same.net?q", "http://u:p@com:80/de/", "a://b.com/fr/://c.com/de/", "http://.org/", "http://..com/de/",
        "http://é.com/fr/é", "http://ÉX.org/es/", "http://com.org.com/de/" + "long/" * 20_000]


@pytest.mark.parametrize("broadcast", [0, 100])
def test_against_brute_force(spark, monkeypatch, broadcast):
    """Both ways of the join; repeated rows; columns with the names of the added ones."""
    monkeypatch.setattr(urls, "MOST_BROADCAST_RULES", broadcast)
    rng = random.Random(3)
    hosts, paths = ["a.com", "b.a.com", "c.org", "x.c.org", "d.net"], ["", "/", "/a", "/a/b", "/a/bc", "/b"]
    rules = list(RULES) + [(rng.choice(hosts), p, rng.choice(["allow", "block"])) for p in rng.sample(paths, 4)]
    rules = list({(h.lower(), p if not p or p.startswith("/") else "/" + p): (h, p, v) for h, p, v in sorted(rules, key=lambda r: r[2])}.values())
    given = list(enumerate(URLS + [f"http://{rng.choice(['', 'w.', 'v.w.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'z', '/z'])}"
                                   for _ in range(300)])) + [(None, "http://example.org/es/"), (7, None), (7, None)]
    out = judged(pages_of(spark, given), rule_table(spark, rules))
    got = sorted(((r.row.page_id, r.row.url, r.host, r.path, r.rule, r.verdict) for r in out.collect()), key=repr)
    assert got == sorted(((i, u, *brute(u, rules)) for i, u in given), key=repr)
    left = filter_urls(pages_of(spark, given), rule_table(spark, rules))
    assert left.columns == ["page_id", "url", "host", "key"]
    assert left.count() == sum(brute(u, rules)[3] == "allow" for _, u in given)


def test_filter_has_no_false_negative_and_few_false_positives(spark):
    n = 20_000
    blocks = blocks_for(n)
    assert blocks == 1024 and blocks_for(0) == 1 and blocks_for(10 ** 9) == urls.MOST_BLOCKS
    keys = spark.range(n).select(F.concat(F.lit("host"), F.col("id").cast("string"), F.lit("/p")).alias("key"))
    held = bloom_filter(keys, blocks).first()["words"]
    assert len(held) == blocks * urls.WORDS
    words = F.split(F.lit(",".join(map(str, held))), ",").cast("array<bigint>")
    assert keys.where(maybe_listed(F.col("key"), words, blocks)).count() == n
    others = spark.range(n).select(F.concat(F.lit("other"), F.col("id").cast("string")).alias("key"))
    assert others.where(maybe_listed(F.col("key"), words, blocks)).count() < 0.01 * n


def test_empty_tables_and_wrong_rules(spark):
    none = rule_table(spark, [])
    got = judged(pages_of(spark, [(1, "http://a.com/")]), none, "block").collect()
    assert [(r.rule, r.verdict) for r in got] == [(None, "block")]
    assert judged(pages_of(spark, []), rule_table(spark, RULES)).collect() == []
    for wrong in [("", "/", "allow"), ("a.com", "/", "maybe"), ("a.com", "/", None)]:
        with pytest.raises(Exception, match="a rule needs a host"):
            listed(rule_table(spark, [wrong])).collect()


def test_no_python_on_the_main_path(spark):
    plan = judged(pages_of(spark, [(1, "http://a.com/")]), rule_table(spark, RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
