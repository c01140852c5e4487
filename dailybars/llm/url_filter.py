"""URL filter: host and path rules, and logistic regression for the rest.

The classifier is trained from the small labelled table below on hashed
character n-grams of host and path (Spark ML, DataFrame based). Everything
runs in DataFrame expressions over one scan; there is no join or shuffle.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased. Path: from there up to ``?``, ``#`` or the end. A rule
``host/path`` fits its host and all subdomains if the path starts with the
rule's path; the longest fitting rule wins (of equally long ones the first).

Defined results: a NULL URL or one without ``://`` has an empty host and path,
fits no rule and is judged on no n-grams (the regression's intercept, which
labelled URLs without a host hold on the allowing side); very
long URLs are judged whole; repeated rows are judged one by one; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK, ALLOW = "block", "allow"
RULES = (("net/", BLOCK), ("example.net/en/", ALLOW), ("example.com/de/", BLOCK),
         ("org/fr/", ALLOW))

# The labelled URL table, block first: invented, no row of the test pages. The
# last ones have no host, so that a URL without one is not blocked by default.
LABELLED = tuple((url, 1.0) for url in (
    "http://spam-ranch.example.org/en/81-x", "https://spam-links.example.org/es/11?utm_source=feed",
    "http://link-farm.example.com/fr/2", "https://spam-blog.example.org/de/now.html",
    "http://casino-bonus.example.com/win/now", "https://best-casino.example.org/en/slots",
    "http://poker-free.example.com/es/bonus", "https://cheap-pills.example.org/buy/now",
    "http://pills-online.example.com/en/order", "https://xxx-videos.example.org/hot",
    "http://adult-dating.example.com/fr/meet", "https://lottery-winner.example.org/claim/prize",
    "http://free-money.example.com/en/claim", "https://malware-download.example.org/setup.exe",
    "http://click-tracker.example.com/ads/9", "https://ads-farm.example.org/banner/77",
    "http://phishing-login.example.com/account/verify", "https://content-farm.example.org/en/5",
    "http://spam.example.com/en/one", "https://spamfarm.example.com/en/404",
)) + tuple((url, 0.0) for url in (
    "http://lorunta.example.com/fr/lire?page=31", "https://m.merindo.example.com/en/read#end",
    "https://kastelo.example.org/en/walks", "http://blog.veranta.example.org/en/post-12",
    "https://blog.garden.example.com/en/roses/", "http://m.rivers.example.org/es/ebro/",
    "https://www.library.example.org/en/books/12", "http://news.city.example.com/en/2021/05",
    "https://docs.project.example.org/guide/start.html", "http://wiki.history.example.com/en/rome",
    "https://museum.example.org/fr/collection", "http://university.example.com/en/course/7",
    "https://www.weather.example.org/es/today", "http://recipes.example.com/en/bread.html",
    "https://forum.cycling.example.org/en/thread/99", "http://shop.example.com/de/books",
    "https://m.teacher.example.com/es/lesson.html", "http://health.example.org/en/advice",
    "https://blog.astronomy.example.org/en/comets", "http://travel.example.com/fr/paris",
    "https://ostrava.example.com/es/plaza", "http://erendal.example.org/en/hills/",
    "", "about:blank", "mailto:reader", "tel:5550100", "/local/page.html", "readme.txt",
))

GRAMS = (3, 4)
BINS = 1 << 12
THRESHOLD = 0.5


def host_path(url: str = "url") -> tuple[F.Column, F.Column]:
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(F.col(url)))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    host = F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _grams(column: str, mark: str, n: int) -> F.Column:
    """The n-grams of a column between end marks, marked by field."""
    ended = F.concat(F.lit("^"), F.col(column), F.lit("$"))
    starts = F.sequence(F.lit(1), F.length(ended) - n + 1)
    grams = F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(ended, i, F.lit(n))))
    return F.when(F.length(ended) >= n, grams).otherwise(F.array().cast("array<string>"))


def with_features(urls: DataFrame, url: str = "url") -> DataFrame:
    host, path = host_path(url)
    parts = urls.withColumn("host", host).withColumn("path", path)
    grams = [F.when(F.col(c) != "", _grams(c, m, n)).otherwise(F.array().cast("array<string>"))
             for c, m in (("host", "h:"), ("path", "p:")) for n in GRAMS]
    return HashingTF(numFeatures=BINS, inputCol="grams", outputCol="features").transform(
        parts.withColumn("grams", F.concat(*grams))).drop("grams")


def train(spark: SparkSession, labelled=LABELLED) -> LogisticRegressionModel:
    rows = F.array(*[F.struct(F.lit(u).alias("url"), F.lit(y).alias("label"))
                     for u, y in labelled])
    table = spark.range(1).coalesce(1).select(F.inline(rows))
    return LogisticRegression(regParam=0.01, maxIter=60).fit(with_features(table))


def rule_columns(rules=RULES) -> tuple[F.Column, F.Column]:
    """(rule, verdict) of the longest fitting rule, NULL without one."""
    name = verdict = None
    for rule, action in sorted(rules, key=lambda r: -len(r[0])):
        host, slash, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col(
            "path").startswith(slash + path)
        name = F.when(fits, rule) if name is None else name.when(fits, rule)
        verdict = F.when(fits, action) if verdict is None else verdict.when(fits, action)
    return name, verdict


def judge(pages: DataFrame, rules=RULES, labelled=LABELLED) -> DataFrame:
    """page_id, host, path, rule, verdict and the regression's block_score."""
    model = train(pages.sparkSession, labelled)
    scored = model.transform(with_features(pages.select("page_id", "url")))
    rule, by_rule = rule_columns(rules) if rules else (F.lit(None).cast("string"),) * 2
    score = vector_to_array("probability")[1]
    return scored.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(by_rule, F.when(score >= THRESHOLD, BLOCK).otherwise(ALLOW)).alias("verdict"),
        score.alias("block_score"))
