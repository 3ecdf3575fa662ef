import re

from tests.conftest import SF01
from tests.llm.helpers import with_clashes
from threadsmith.llm.url_logit import RULES, judge_urls

ODD = ["http://EXAMPLE.net/en/1?x", "https://a.b.example.net/EN/1", "x.com", None, "", "://", "ftp://net", "http://net/",
       "http://org/fr/1#a?b", "http://www.orgx.org/fr", "http://example.com/de/2", "http://notexample.com/de/2",
       "http://a://b/c", "http://İ.net/", "https://casino-win.example.com/x"]


def expected(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", None
    host, path = re.match(r"([^/?#]*)([^?#]*)", url[at + 3:], re.S).groups()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else None


def test_rules_against_brute_force(spark):
    rows = list(enumerate(ODD)) + [(None, ODD[0]), (1, ODD[1])]
    pages = with_clashes(spark.createDataFrame(rows, "page_id long, url string"))
    given = spark.read.parquet(f"{SF01}/pages.parquet").select("page_id", "url")
    for table in (pages, given):
        urls = sorted(((r.page_id, r.url) for r in table.collect()), key=str)
        got = sorted(judge_urls(table).collect(), key=lambda r: str((r.page_id, r.host, r.path)))
        assert sorted((str(r.page_id), r.host, r.path, r.rule) for r in got if r.rule) == sorted(
            (str(i), *expected(u)[:2], expected(u)[2][0]) for i, u in urls if expected(u)[2])
        assert sorted((str(r.page_id), r.host, r.path) for r in got) == sorted((str(i), *expected(u)[:2]) for i, u in urls)
        ruled = dict((h + p, v) for v, h, p in RULES)
        assert all(r.verdict == ruled[r.rule] if r.rule else r.verdict == ("block" if r.p_block >= 0.5 else "allow") for r in got)
    assert judge_urls(pages.limit(0)).count() == 0


def test_regression_on_unseen_hosts(spark):
    urls = [("https://best-casino.example.com/en/4", "block"), ("https://m.adult-zone.example.com/fr/1", "block"),
            ("https://www.thether.example.com/en/12.html", "allow"), ("https://blog.sunflower.example.com/es/9", "allow")]
    got = judge_urls(spark.createDataFrame(list(enumerate(u for u, _ in urls)), "page_id long, url string")).orderBy("page_id")
    assert [r.verdict for r in got.collect()] == [v for _, v in urls]


def test_probabilities_against_brute_force(spark):
    """Every gram of ``^host|path`` looked up on its own, the weights summed in Python."""
    import math

    from pyspark.sql import functions as F

    from threadsmith.llm import url_logit as u
    urls = [x for x in ODD if x] + ["https://ab.example.org/é/1", "https://x/", "https://www.gardenclub.example.org/en/4"]
    weights, intercept = u.train(u.labelled_urls(spark))

    def grams(url):
        text = "^" + "|".join(expected(url)[:2])
        return [text[i:i + n] for n in u.GRAMS for i in range(len(text) - n + 1)]
    distinct = sorted({g for url in urls for g in grams(url)})
    hashed = spark.createDataFrame([(g,) for g in distinct], "g string").select("g", F.xxhash64("g").alias("h")).collect()
    bucket = {r.g: r.h % u.BUCKETS for r in hashed}
    got = {r.page_id: r.p_block for r in judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    for i, url in enumerate(urls):
        total = intercept + sum(weights[bucket[g]] for g in grams(url))
        assert math.isclose(got[i], 1 / (1 + math.exp(-total)), abs_tol=1e-6), url  # six digits
