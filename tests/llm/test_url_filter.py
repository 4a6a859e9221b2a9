from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from rowsift.llm import url_filter as u


@pytest.fixture(scope="module")
def model(spark):
    return u.train(u.seed_table(spark))


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    best = None
    for verdict, h, p in u.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, verdict)
    return best


URLS = [
    None, "", "no scheme", "http://", "http:///x", "://a.net/", "HTTP://WWW.Example.NET/en/1?x#y", "https://example.net/EN/1",
    "https://a.net", "https://a.net?x", "https://net/", "https://fakenet/", "https://x.net:80/", "http://u@b.net/q://c.org/fr/",
    "https://example.com/de/", "https://example.com/de", "https://sub.example.com/de/5", "https://notexample.com/de/", "https://W.org/fr/#a",
    "https://É.ORG/fr/ü", "a://b://c.net/", "https://x.org/fr\n/", "https://" + "l" * 5000 + ".net/" + "p" * 5000,
]


def test_parts_and_rules(spark, model):
    pages = spark.createDataFrame([(i, x, 1) for i, x in enumerate(URLS)], "page_id long, url string, rule int")
    rows = u.judge(pages, model).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        assert (r.host, r.path) == parse(URLS[r.page_id]), URLS[r.page_id]
        hit = rule_of(r.host, r.path)
        assert r.rule == (hit and hit[0])
        assert r.verdict == hit[1] if hit else r.verdict == ("block" if r.block_logit > 0 else "allow")


def test_held_out_urls(spark, model):
    good = ["https://www.example.org/es/41", "http://blog.example.com/en/3/", "https://library.city.test/en/books", "https://news.school.test/report/2020", "https://museum.guide.test/article/4"]
    bad = ["http://free-casino-slots.test/jackpot/bonus", "http://buy-cheap-viagra.test/pills/discount", "http://adult-xxx-cams.test/sexy", "http://warez-crack.test/torrent/keygen", "http://claim-your-prize.test/winner/free-iphone"]
    pages = spark.createDataFrame([(i, x) for i, x in enumerate(good + bad)], "page_id long, url string")
    verdicts = [r.verdict for r in u.judge(pages, model).orderBy("page_id").collect()]
    assert verdicts == ["allow"] * len(good) + ["block"] * len(bad)


def test_same_model_each_time(spark, model):
    assert u.train(u.seed_table(spark).repartition(5)) == model


def test_score_is_the_sum_of_weights(spark, model):
    df = spark.createDataFrame([("www.example.org", "/en/1")], "h string, p string")
    r = df.select(u.buckets(F.col("h"), F.col("p")).alias("b"), model.logit(F.col("h"), F.col("p")).alias("x")).first()
    assert abs(r.x - model.intercept - sum(model.weights[i] for i in r.b) / len(r.b)) < 1e-9


def test_few_or_no_labels(spark):
    seed = u.seed_table(spark)
    pages = spark.createDataFrame([(1, "http://q.test/"), (2, None)], "page_id long, url string")
    for labelled, want in ((seed.limit(0), "allow"), (seed.filter("label = 1"), "block"), (seed.filter("label = 0"), "allow"), (seed.selectExpr("url", "cast(null as int) label"), "allow")):
        assert {r.verdict for r in u.judge(pages, u.train(labelled)).collect()} == {want}
    assert u.judge(pages.limit(0), u.train(seed)).count() == 0
