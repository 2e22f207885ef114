"""URL filter: explicit rules first, a logistic regression on hashed n-grams for the rest.

Only DataFrame functions are used. The model is fitted by Spark's own logistic regression on a
small labelled table and is a fixed number of weights; scoring adds the weights of a URL's
distinct buckets inside the query plan, so that nothing is shuffled or sent to Python.

Rules are configuration: a handful of `host/path` strings held in the plan. A rule fits its
host and all subdomains where the URL's path starts with the rule's path; the longest wins,
a block rule before an allow rule of the same length.

Defined results: a null URL, or one without `://`, has an empty host and path, fits no rule
and is judged by the model's bias; ports and user names count as part of the host. Repeated
rows are judged alike; other columns are kept.
"""

from __future__ import annotations

import json
import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 8192
SIZES = (3, 4)

#: Words of hosts and paths of the labelled table: rows to block, rows to keep.
BAD = (
    "casino", "poker", "bets", "betting", "slots", "jackpot", "roulette", "blackjack", "bingo", "gamble",
    "pills", "viagra", "cialis", "pharmacy-discount", "meds-online", "steroids", "diet-miracle", "weight-loss",
    "adult", "porn", "xxx", "sex", "cams", "escort", "hotgirls", "nude", "webcam-chat", "hookup",
    "payday", "quick-loan", "easy-cash", "get-rich", "free-money", "forex-signal", "crypto-giveaway", "double-bitcoin",
    "crack", "keygen", "warez", "torrent", "serialz", "cracked", "replica", "fake-watches", "knockoff",
    "free-prize", "lottery", "you-won", "claim-reward", "win-phone", "spam", "linkfarm", "backlinks", "clickbait",
    "adserver", "adclick", "popunder", "tracker", "pixel", "banner-exchange", "traffic-buy", "seo-boost",
    "phish", "verify-account", "malware", "spyware", "dating-tonight", "milf", "fetish", "winbig",
)
GOOD = (
    "news", "weather", "library", "university", "science", "garden", "recipes", "travel", "history", "museum",
    "docs", "wiki", "blog", "school", "health", "music", "photos", "forum", "kitchen", "nature",
    "business", "sport", "sports", "politics", "opinion", "economy", "world", "europe", "culture", "society",
    "times", "post", "herald", "journal", "gazette", "tribune", "guardian", "chronicle", "magazine", "review",
    "research", "papers", "abstract", "articles", "archive", "press", "academy", "institute", "college", "course",
    "gov", "ministry", "parliament", "council", "city", "county", "police", "court", "law", "tax",
    "hospital", "clinic", "doctor", "medicine", "nursing", "physics", "chemistry", "biology", "math", "statistics",
    "software", "developer", "python", "linux", "github", "code", "data", "cloud", "network", "security",
    "books", "poems", "novel", "film", "cinema", "theatre", "opera", "dance", "art", "gallery",
    "football", "tennis", "cycling", "running", "hiking", "camping", "mountain", "river", "ocean", "island",
    "hotel", "restaurant", "cafe", "bakery", "wine", "cheese", "farm", "market", "shop", "fashion",
    "house", "home", "furniture", "architecture", "design", "bridge", "railway", "airport", "station", "transport",
    "children", "family", "parents", "teacher", "student", "language", "dictionary", "grammar", "translate", "letters",
    "church", "charity", "foundation", "society", "union", "workers", "energy", "climate", "water", "forest",
    "bank", "insurance", "finance", "company", "industry", "engineering", "motor", "about", "contact", "help",
    "deporte", "noticias", "actualite", "nachrichten", "wissenschaft", "universidad", "bibliotheque", "geschichte", "salud", "cuisine",
)
SUFFIXES = ("com", "net", "org", "info", "co.uk", "de", "fr", "es", "io", "eu")
FRONTS = ("", "www.", "m.", "blog.", "shop.")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): the words above, alone and in pairs, under a few subdomains, domains and
    paths that are the same for both labels; 1 blocks. A word to block stands in the host or in
    the path; the rest of its URL is as ordinary as the others."""
    rows = []
    for label, words in ((1.0, BAD), (0.0, GOOD)):
        for i in range(len(GOOD)):
            word, other, plain = words[i % len(words)], words[(7 * i + 3) % len(words)], GOOD[(11 * i + 5) % len(GOOD)]
            suffix, front = SUFFIXES[i % len(SUFFIXES)], FRONTS[i % len(FRONTS)]
            page = (f"en/{100 + i}", f"de/{200 + i}/", f"es/{300 + i}.html", f"fr/{i}?page=2", f"{2000 + i % 25}/{i % 12 + 1}/{plain}", plain)[i % 6]
            for url in (f"https://{front}{word}.{suffix}/{page}", f"http://{word}-{other}.{suffix}/", f"https://{front}{other}{word}.example.{suffix}/{page}", f"https://{front}{plain}.{suffix}/{word}/{i}"):
                rows.append({"url": url, "label": label})
    listed = F.from_json(F.lit(json.dumps(rows)), "array<struct<url:string,label:double>>")
    return spark.range(1).select(F.explode(listed).alias("row")).select("row.url", "row.label")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def grams(host: Column, path: Column) -> Column:
    """Distinct buckets of the character n-grams of host and path, each closed by its own mark."""

    def of(text: Column, size: int) -> Column:
        last = F.length(text) - size + 1
        starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.substring(text, i, F.lit(size))), F.lit(BUCKETS)))

    texts = F.concat(F.lit("^"), host, F.lit("$")), F.concat(F.lit(">"), F.lower(path), F.lit("<"))
    return F.array_distinct(F.concat(*(of(text, size) for text in texts for size in SIZES)))


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        return ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))


@dataclass(frozen=True)
class UrlModel:
    weights: tuple[float, ...]
    bias: float

    def score(self, host: Column, path: Column) -> Column:
        weights = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")
        total = F.aggregate(grams(host, path), F.lit(self.bias), lambda acc, bucket: acc + F.get(weights, bucket.cast("int")))
        return 1 / (1 + F.exp(-total))


def train(labelled: DataFrame, regularisation: float = 0.01) -> UrlModel:
    """Fit on (url, label) rows; the result has BUCKETS weights whatever their number."""
    present = grams(host_of(F.col("url")), path_of(F.col("url"))).cast("array<string>")
    counter = CountVectorizerModel.from_vocabulary([str(b) for b in range(BUCKETS)], "present", "features", binary=True)
    rows = counter.transform(labelled.select("label", present.alias("present"))).select("label", "features")
    fitted = LogisticRegression(regParam=regularisation, maxIter=30, standardization=False).fit(rows.coalesce(1))
    return UrlModel(tuple(float(w) for w in fitted.coefficients), float(fitted.intercept))


def judge(urls: DataFrame, model: UrlModel, rules: Sequence[Rule], url: str = "url", threshold: float = 0.5) -> DataFrame:
    """`urls` with host, path, rule, verdict and the model's score; these names replace
    columns that are there already."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    out = urls.withColumns({"host": host, "path": path})
    host, path = F.col("host"), F.col("path")
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    fitting = [F.when(r.fits(host, path), F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))) for r in ordered]
    rule = F.coalesce(*fitting) if fitting else F.lit(None).cast("struct<text:string,verdict:string>")
    score = model.score(host, path)
    out = out.withColumns({"rule": rule, "score": score})
    judged = F.coalesce(F.col("rule.verdict"), F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return out.withColumn("verdict", judged).withColumn("rule", F.col("rule.text"))
