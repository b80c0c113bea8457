from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from cartlens.llm import urls


def plain(url, listed, rules=urls.RULES):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda x: x.group().lower(), host)
    best = None
    for verdict, rule_host, rule_path in rules:
        fits = (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path)
        if fits and (best is None or len(rule_host + rule_path) > len(best[0])):
            best = (rule_host + rule_path, verdict)
    own = "block" if host in listed or host + path in listed else "allow"
    return host, path, best and best[0], best[1] if best else own


URLS = [
    "http://Example.ORG/es/1?x=/en/1", "https://a.example.org/en/19", "https://a.example.org/en/2", "x://y.com/fr/", None,
    "x://com/de/1", "x://xcom/de/1", "no scheme/com", "://host.net?q#/p", "a://b://c/d", "x://h#f?g/", "", "x://", "x://É.net/p",
    "http://example.org", "http://example.org/es", "http://ORG/", "x://y.com:80/de/", "x://spam.y.net/", "x://spammer.net/",
]


@pytest.mark.parametrize("most_bytes", [1 << 20, 100])
def test_against_plain_rules_and_list(spark, most_bytes):
    """One shard that tasks hold, and several that they read; a host with a third of all pages."""
    chance = random.Random(12)
    rows = list(enumerate(URLS))
    rows += [(100 + i, f"http://h{chance.randrange(3000)}.net/{i}") for i in range(4000)]
    rows += [(9000 + i, f"https://hot.net/en/{i % 1500}#x") for i in range(2000)]
    rows += [(9000, "https://hot.net/en/0")] * 3
    listed = {f"h{i}.net" for i in range(0, 3000, 7)} | {"absent.net", "spam.y.net"}
    listed |= {f"hot.net/en/{i}" for i in range(0, 3000, 11)} | {"h5.net/", "example.org/es"}
    keys = spark.createDataFrame([*((x,) for x in listed), (None,), ("h7.net",)], "key string")
    schema = "page_id long, url string, host string, listed boolean, address string, row string, passed int, shard int"
    pages = spark.createDataFrame([(i, u, "x", True, "a", "r", 1, 2) for i, u in rows], schema).repartition(3)
    got = [
        (r["page_id"], r["host"], r["path"], r["rule"], r["verdict"])
        for r in urls.judge_urls(pages, keys, most_bytes=most_bytes).collect()
    ]
    assert sorted(got, key=str) == sorted(((i, *plain(u, listed)) for i, u in rows), key=str)


def test_cascade_is_exact_and_bounded(spark):
    """Few listed among many, most listed, all listed; a shard stays near its bound."""
    for share in (40, 2, 1):
        universe = spark.range(5000).selectExpr("concat('k', id) key", f"id % {share} = 0 listed").cache()
        for most_bytes in (1 << 20, 100):
            cascade = urls.build_cascade(universe, most_bytes)
            assert (cascade.shards == 1) == (most_bytes == 1 << 20)
            assert cascade.n_bytes / cascade.shards < 2 * most_bytes
            found = urls.levels_passed(universe, "key", cascade)
            assert found.count() == 5000
            assert found.where("listed <> (passed % 2 = 1)").count() == 0
        assert urls.build_cascade(universe.where("not listed")) is None


def test_addresses_of_toxic_documents(spark):
    paths = ["/en/7?x", "/en/7.html", "/de/8", "/en/9#a", "/en/", "/x/7", "/en/99999999999999999999", ""]
    pages = spark.createDataFrame([(i, f"http://A.net{p}") for i, p in enumerate(paths)] + [(9, None)], "page_id long, url string")
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 0), (9, 1), (9, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    found = sorted(r["key"] for r in urls.toxic_addresses(pages, labels).collect())
    assert found == ["a.net/en/7", "a.net/en/7.html", "a.net/en/9"]
    assert urls.toxic_addresses(pages, labels.limit(0)).collect() == []


def test_listed_words(spark):
    hosts = ["a.spam.net", "spam-farm.org", "my-bets.com", "spammer.net", "pills", "x.pillsbury.com"]
    pages = spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(hosts)], "page_id long, url string")
    assert {r["key"] for r in urls.spam_hosts(pages).collect()} == {"a.spam.net", "spam-farm.org", "my-bets.com", "pills"}


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    keys = spark.createDataFrame([("a.net",)], "key string")
    assert urls.judge_urls(pages.limit(0), keys).collect() == []
    assert urls.judge_urls(pages, keys.limit(0)).first()["verdict"] == "allow"
    assert urls.judge_urls(pages.where(F.lit(True)), keys).first()["verdict"] == "block"
