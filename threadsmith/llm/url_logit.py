"""URL verdicts: rules on host and path, and a logistic regression on hashed character n-grams.

The regression is trained from a small labelled table of urls; its weights (one a bucket) become a literal
array, so that scoring is a projection without a join."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
CUT = 0.5
#: verdict, host suffix, path prefix; the longest rule that fits wins
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
#: training urls, without scheme: pages to block, then pages to allow
BLOCKED = """ads-track.example.com/en/1042 adserver.example.com/click/22 ad-tracker.example.org/pixel/9
track-clicks.example.com/r/55 m.ads-network.example.com/banner/7 spam-farm.example.com/en/93
spam-links.example.org/fr/31 link-farm.example.com/es/12 content-farm.example.org/en/5 casino-win.example.com/en/77
online-casino.example.org/slots/3 casino-bonus.example.com/de/8 win-big.example.com/jackpot/2
poker-win.example.org/play/6 free-bets.example.com/en/43 sports-bets.example.org/odds/1 bets-online.example.com/fr/14
adult-x.example.com/en/66 adult-video.example.org/x/4 xxx-adult.example.com/es/18 cheap-pills.example.com/en/27
buy-pills.example.org/rx/2 cheap-meds.example.com/en/9 pills-online.example.com/shop/5 free-prizes.example.com/win/3
cheap-loans.example.org/apply/1 free-money.example.com/now/8 malware-drop.example.com/exe/2""".split()
ALLOWED = """www.example.com/en/1042 blog.example.org/en/22 m.example.com/fr/9.html gardenhistory.example.org/en/55
therivers.example.com/en/7 cityarchive.example.com/en/93 www.mountainhut.example.org/es/31 blog.weather.example.com/es/12
library.example.org/en/5 orchestra.example.com/en/77/ m.museum.example.org/fr/3 blog.gardening.example.com/fr/8
lighthouse.example.com/en/2 harbour.example.org/de/6 townhall.example.com/en/43 sandstone.example.org/en/1
restaurant.example.com/es/14 blog.shepherd.example.com/en/66 northern.example.org/en/4 leather.example.com/fr/18
www.theatre.example.com/en/27 historian.example.org/en/2 stationer.example.com/en/9.html blog.reading.example.com/en/5
recipes.example.com/en/3/ cooking.example.org/es/1 school.example.com/en/8 football.example.com/en/2
university.example.org/en/310 bookshop.example.com/en/41 mathematics.example.org/en/17 hospital.example.com/fr/28
education.example.com/en/441 themountain.example.org/en/5.html www.national.example.com/de/20 stations.example.org/es/87
blog.thunder.example.com/en/902/ m.thinkers.example.org/en/33 tradition.example.com/fr/640 otherside.example.com/en/71
trains.example.com/en/19 gardeners.example.org/en/64 address.example.com/en/38 adults.example.org/en/71""".split()


def url_host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    rest = F.split_part(url, F.lit("://"), F.lit(1))
    after = F.substr(url, F.char_length(rest) + 4)
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    return F.when(F.contains(url, F.lit("://")), F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                                             "abcdefghijklmnopqrstuvwxyz")).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ?, # or the end, as written; empty without ://."""
    rest = F.split_part(url, F.lit("://"), F.lit(1))
    after = F.substr(url, F.char_length(rest) + 4)
    return F.when(F.contains(url, F.lit("://")), F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def best_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, suffix, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(suffix + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def gram_buckets(host: Column, path: Column) -> Column:
    """Bucket numbers (from 1) of the character n-grams of host and path, each with its start marked."""
    text = F.concat(F.lit("^"), host, F.lit("|"), path)
    size = F.char_length(text)

    def grams(n: int) -> Column:
        return F.when(size >= n, F.transform(
            F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1))),
            lambda i: (F.pmod(F.xxhash64(F.substr(text, i, F.lit(n))), F.lit(BUCKETS)) + 1).cast("int")
        )).otherwise(F.array().cast("array<int>"))
    return F.concat(*[grams(n) for n in GRAMS])


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled table: host, path, label (1: block)."""
    rows = [(url, 1.0) for url in BLOCKED] + [(url, 0.0) for url in ALLOWED]
    table = F.explode(F.array(*[F.struct(F.lit("https://" + u).alias("url"), F.lit(y).alias("label")) for u, y in rows]))
    return spark.range(1).select(table.alias("x")).select("x.*")


def train(labelled: DataFrame) -> tuple[list[float], float]:
    """Weights by bucket and the intercept, from a small table of url and label; an unseen bucket weighs 0."""
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    rows = labelled.select("label", gram_buckets(host, path).cast("array<string>").alias("buckets"))
    counter = CountVectorizer(inputCol="buckets", outputCol="features", vocabSize=BUCKETS).fit(rows)
    model = LogisticRegression(maxIter=100, regParam=0.0005, standardization=False).fit(counter.transform(rows))
    weights = [0.0] * BUCKETS
    for bucket, weight in zip(counter.vocabulary, model.coefficients.toArray()):
        weights[int(bucket) - 1] = round(float(weight), 6)
    return weights, float(model.intercept)


def block_probability(host: Column, path: Column, weights: list[float], intercept: float) -> Column:
    table = F.split(F.lit(",".join(f"{w:g}" for w in weights)), ",").cast("array<double>")
    total = F.aggregate(gram_buckets(host, path), F.lit(intercept), lambda acc, b: acc + F.element_at(table, b))
    return 1 / (1 + F.exp(-total))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
               labelled: DataFrame | None = None) -> DataFrame:
    """``pages`` -> (id, host, path, rule, verdict, p_block), one row a page.

    A null url or one without :// has empty host and path; it fits no rule and gets the
    regression's verdict for the empty text.  Ids are carried as they are; other columns are ignored.
    A projection: no shuffle, no Python."""
    weights, intercept = train(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    parts = pages.select(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias("__url"))
    parts = parts.select(id_col, url_host(F.col("__url")).alias("host"), url_path(F.col("__url")).alias("path"))
    host, path = F.col("host"), F.col("path")
    rule, verdict = best_rule(host, path, rules)
    scored = parts.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("ruled"),
                          F.round(block_probability(host, path, weights, intercept), 6).alias("p_block"))
    learned = F.when(F.col("p_block") >= CUT, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(id_col, "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "p_block")
