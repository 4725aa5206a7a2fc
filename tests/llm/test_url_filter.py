import re

import pytest

from textflow.checks.plan_audit import audit
from textflow.llm.queries import REGISTRY
from textflow.llm.url_filter import (RULES, fit_filter, judge, labelled_urls)

SMALL = "/root/testdata/sf0.001"


def _parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def _rule(host, path):
    best = None
    for verdict, text in RULES:
        h, p = text.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            if best is None or len(text) > len(best[1]):
                best = verdict, text
    return best or (None, None)


@pytest.fixture(scope="module")
def model(spark):
    return fit_filter(labelled_urls(spark))


def test_rules_and_parts(spark, model):
    urls = [None, "", "no scheme", "http://", "http://COM", "http://com/",
            "http://a.COM/x?y=://z", "https://example.com/en/1",
            "https://www.example.com/en/1", "https://m.example.com/en/1",
            "https://wwwexample.com/en/1", "ftp://x.net/es/1", "x://net/fr/",
            "x://net/fr", "x://anet/fr/", "x://a.net#/es/", "x://a.net?q/es/",
            "x://É.net/es/", "x://a://b.net/es/", "a\nb://c.net/fr/x\ny?z",
            "x://example.com/en", "x://a.example.com/en/?#", "x://com/" + "p" * 90_000,
            "x://com/", "x://com/"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)],
                               "page_id long, url string, host string")
    got = {r.page_id: r for r in judge(df, model).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path = _parts(u)
        verdict, rule = _rule(host, path)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), u
        assert r.verdict == (verdict or ("block" if r.p_block > 0.5
                                         else "allow"))
    assert judge(df.filter("page_id < 0"), model).count() == 0


def test_model_learns_its_table(spark, model):
    rows = labelled_urls(spark).selectExpr("blocked as page_id", "url")
    got = judge(rows, model, rules=()).collect()
    right = sum((r.verdict == "block") == (r.page_id == 1) for r in got)
    assert right / len(got) > 0.97
    unseen = spark.createDataFrame(
        [(1, "http://www.best-casino.example.org/de/1"),
         (1, "http://adult-pics.example.net/en/2"),
         (0, "http://www.gardens.example.org/de/1"),
         (0, "http://blog.retion.example.net/en/2")],
        "page_id long, url string")
    assert [r.verdict for r in judge(unseen, model, rules=()).orderBy(
        "page_id").collect()] == ["allow", "allow", "block", "block"]


def test_registered_query_is_native_and_whole(spark):
    df = REGISTRY["op7_url_filter"](spark, SMALL)
    assert not audit(df)["python"]
    assert {r.page_id for r in df.collect()} == {
        r.page_id for r in spark.read.parquet(f"{SMALL}/pages.parquet")
        .select("page_id").collect()}
