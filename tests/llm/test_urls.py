import random
import re

import pytest
from pyspark.sql import functions as F

from contigloom.llm import urls

ODD = [None, "", "no scheme/at all", "http://", "HTTP://WWW.Example.COM/en/x?y=/fr/#z", "x://net", "ftp://a.net/es/", "https://ÄB.net/fr/é", "http://a.com", "http://a.com?x/",
       "http://notexample.com/en/", "http://example.com/en", "http://www.example.com/en/1", "http://u.www.example.com/en/", "a://b://c.net/fr/x", "http://\nx.net/es/q"]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, k) for k, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fits, key=lambda r: len(r[0]), default=(None, None))
    return host, path, *rule


def made(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rng.random() < 0.5:
            rows.append(f"http://s{rng.randrange(50)}.net/{rng.choice(['es', 'fr'])}/{i}?utm_source={rng.randrange(10 ** 6)}&b=2")
        else:
            rows.append(f"https://site{rng.randrange(50)}.com/a")
    return rows


def pages(spark, texts):
    return spark.createDataFrame([(i, u) for i, u in enumerate(texts)], "page_id long, url string")


def test_hosts_paths_and_rules_match_brute_force(spark):
    texts = ODD + made(60)
    rows = pages(spark, texts).withColumns({"suffix": F.lit("mine"), "features": F.lit(1), "n": F.lit(0), "rule": F.lit("x")})
    got = {r["page_id"]: r for r in urls.url_filter(rows).collect()}
    assert len(got) == len(texts)
    for i, u in enumerate(texts):
        host, path, rule, verdict = brute(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert verdict is None or got[i]["verdict"] == verdict
        assert got[i]["verdict"] in ("allow", "block")


def test_held_out_accuracy(spark):
    model_rows = urls.with_features(pages(spark, made(300))).withColumn("label", F.col("path").startswith("/a").cast("int").cast("double") * -1 + 1)
    model = urls.train(model_rows)
    held = urls.judge(urls.with_features(pages(spark, made(200, 9))), model).collect()
    assert sum((r["block_probability"] >= 0.5) == ("utm" in r["url"]) for r in held) >= 190


@pytest.mark.parametrize("texts, verdict", [(["http://a.org/x", None], "allow"), (["http://a.net/es/x", "http://b.org/"], "block"), (["http://a.com/x", "http://b.org/"], "allow")])
def test_without_two_kinds_of_labels(spark, texts, verdict):
    assert {r["verdict"] for r in urls.url_filter(pages(spark, texts)).collect()} == {verdict}


def test_empty_table_and_no_python_in_the_plan(spark):
    assert urls.url_filter(pages(spark, ["x"]).limit(0)).count() == 0
    plan = urls.url_filter(pages(spark, made(80)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
