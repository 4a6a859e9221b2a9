"""URL filter: listed rules first, then logistic regression on hashed character n-grams.

The model is trained from a small labelled table of URLs. Host and path give their
character n-grams apart, each with its ends marked; a hash deals them to a fixed number
of features, as shares of the URL's n-grams. Training and judging use the same column
expressions, and the fitted weights come back as one constant array, so judging is a
projection without shuffle or Python.

Defined results. Null URL or none with ``://``: host and path empty, no rule, judged by the
model on no n-grams. No labelled rows: everything without a rule is allowed; one class
only: that class. Labels are taken by URL; where they differ, block counts. Ties between rules:
the longest, then the first by text. Repeated rows are judged alike. Empty table: no rows.
Very long URLs are judged whole. Other columns never matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsift.llm.common import ascii_lower, let

FEATURES = 2048
NGRAM = 3
RIDGE = 1e-4
#: Most labelled rows that the classifier is fitted on; the smallest hashes are taken.
MAX_LABELLED = 100_000
#: (verdict, host, path), fixed by the contract.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Labelled URLs to train from where the caller has none: 1 is to be blocked.
SEED_URLS = (
    ("https://www.example.org/en/1", 0),
    ("http://blog.example.com/fr/201", 0),
    ("https://m.example.org/de/77.html", 0),
    ("https://shop.example.com/es/18/", 0),
    ("https://www.example.com/en/640?page=2", 0),
    ("http://archive.example.org/es/9", 0),
    ("https://news.site.test/2023/economy/report", 0),
    ("https://www.university.test/library/catalogue", 0),
    ("https://docs.project.test/guide/install", 0),
    ("https://weather.office.test/forecast/north", 0),
    ("https://museum.city.test/en/exhibitions/now", 0),
    ("https://health.agency.test/advice/children", 0),
    ("https://recipes.kitchen.test/bread/rye", 0),
    ("https://maths.school.test/lessons/algebra/3", 0),
    ("https://encyclopedia.test/article/River", 0),
    ("https://forum.gardeners.test/thread/4711", 0),
    ("https://court.state.test/decisions/2019/88", 0),
    ("https://journal.physics.test/volume/12/issue/4", 0),
    ("http://railway.museum.test/history", 0),
    ("https://travel.guide.test/islands/walks", 0),
    ("http://casino-bonus-win.test/free-spins/jackpot", 1),
    ("http://best-casino.test/slots/free-bonus", 1),
    ("http://cheap-pills-online.test/buy/viagra-now", 1),
    ("http://pharma-discount.test/buy-pills/no-prescription", 1),
    ("http://xxx-videos-free.test/hot/adult-cams", 1),
    ("http://adult-dating.test/sexy-singles/xxx", 1),
    ("http://free-crack-keygen.test/download/warez", 1),
    ("http://torrent-warez.test/download/crack-full", 1),
    ("http://click-ads-track.test/popup/banner?aff=99", 1),
    ("http://track.ads-popunder.test/banner/click", 1),
    ("http://win-free-iphone.test/claim-prize/winner", 1),
    ("http://lottery-winner.test/claim/prize-now", 1),
    ("http://fast-loan-cash.test/payday/apply-now", 1),
    ("http://payday-loans.test/cash-now/bad-credit", 1),
    ("http://replica-watches.test/buy/cheap-luxury", 1),
    ("http://cheap-replica-bags.test/luxury/discount", 1),
    ("http://secure-login-verify.test/account/update-password", 1),
    ("http://paypal-verify-account.test/login/secure-update", 1),
    ("http://poker-bet-win.test/sportsbook/free-bets", 1),
    ("http://bet-jackpot.test/casino/poker-bonus", 1),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_hit(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return F.lit(None).cast("struct<rule: string, verdict: string>") if out is None else out


def _ngrams(text: Column, mark: str, n: int) -> Column:
    ended = F.concat(F.lit("^"), text, F.lit("$"))
    return let(
        ended,
        lambda t: F.when(F.length(t) < n, F.array().cast("array<string>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.length(t) - (n - 1)), lambda i: F.concat(F.lit(mark), F.substring(t, i, F.lit(n))))
        ),
    )


def buckets(host: Column, path: Column, features: int = FEATURES, n: int = NGRAM) -> Column:
    """Feature numbers of all n-grams, repeats included."""
    grams = F.concat(_ngrams(host, "h", n), _ngrams(ascii_lower(path), "p", n))
    return F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(features)).cast("int"))


@dataclass(frozen=True)
class UrlModel:
    weights: tuple[float, ...]
    intercept: float
    features: int = FEATURES
    ngram: int = NGRAM

    def logit(self, host: Column, path: Column) -> Column:
        # one constant, folded by the optimizer
        w = F.split(F.lit(",".join(f"{x:.17g}" for x in self.weights)), ",").cast("array<double>")
        total = let(
            buckets(host, path, self.features, self.ngram),
            lambda b: F.aggregate(F.transform(b, lambda i: F.get(w, i)), F.lit(0.0), lambda a, x: a + x)
            / F.greatest(F.size(b), F.lit(1)),
        )
        return total + F.lit(self.intercept)


def train(labelled: DataFrame, features: int = FEATURES, n: int = NGRAM, ridge: float = RIDGE, max_rows: int = MAX_LABELLED) -> UrlModel:
    """Fit on a table (url, label); label 1 is to be blocked."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    rows = labelled.filter("url is not null and label is not null").groupBy("url").agg(F.max(F.col("label").cast("double")).alias("label"))
    rows = rows.orderBy(F.xxhash64("url"), "url").limit(max_rows)
    classes = sorted(r["label"] for r in rows.select("label").distinct().collect())
    if len(classes) < 2:
        sure = (1.0 if classes == [1.0] else -1.0) * 20
        return UrlModel((0.0,) * features, sure, features, n)
    b = rows.select("label", buckets(host_of(F.col("url")), path_of(F.col("url")), features, n).alias("b"))
    counts = F.transform(
        F.sequence(F.lit(0), F.lit(features - 1)),
        lambda i: F.size(F.filter("b", lambda x: x == i)) / F.greatest(F.size("b"), F.lit(1)),
    )
    # one ordered partition: the sums, and so the weights, are the same each time
    table = b.select("label", array_to_vector(counts.cast("array<double>")).alias("features")).coalesce(1)
    fit = LogisticRegression(regParam=ridge, standardization=False, maxIter=200).fit(table)
    return UrlModel(tuple(float(x) for x in fit.coefficients.toArray()), float(fit.intercept), features, n)


def seed_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SEED_URLS), "url string, label int")


def judge(pages: DataFrame, model: UrlModel, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url", key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict, block_logit) of every row."""
    parts = pages.select(key, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    scored = parts.select(
        key, "host", "path", rule_hit(F.col("host"), F.col("path"), rules).alias("hit"), model.logit(F.col("host"), F.col("path")).alias("block_logit")
    )
    learned = F.when(F.col("block_logit") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(key, "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", learned).alias("verdict"), "block_logit")
