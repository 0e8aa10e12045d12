"""URL filter: path rules first, else logistic regression on hashed character n-grams.

The classifier is trained from a small labelled URL table. Features are the character
n-grams of host and path, hashed to a fixed width; parsing, rules, features and scoring
are SQL expressions and Spark ML transformers, so no Python runs on executors.

Defined results
- NULL url or no ``://``: host and path are empty, no rule fits, the model judges the empty url.
- Very long urls are judged whole; a row's n-grams are as many as its characters. No two verdicts tie: odds of
  one half are allowed.
- Empty table: empty result. Repeated rows are judged alike. Extra columns pass through ``judge``,
  except those named like its outputs, which are replaced.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Rule:
    """``where`` is host and path in one, such as ``example.com/en/``."""

    verdict: str
    where: str


#: The rules of the registered query.
RULES = (Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"),
         Rule("block", "net/es/"), Rule("block", "net/fr/"))

#: Words of the labelled URL table. A host is a qualifier and a subject, in either order, with or without a hyphen.
BLOCKED = (
    "free cheap best win hot fast easy lucky mega super instant discount sale bonus deal offer vip adult click promo cash "
    "sexy nude buy order xxx".split(),
    "casino poker slots bingo jackpot roulette betting lottery gambling pharmacy diet steroids loans payday credit forex replica "
    "watches handbags webcam dating escorts porn tube warez keygen torrents cracks popups banners prizes giveaway leads "
    "traffic followers hookup money".split())
ALLOWED = (
    "city national open daily my the green local royal north south county public modern old new little river west central "
    "young world family study blue village home".split(),
    "library weather school museum recipes science garden airport history orchestra physics railway tourism university water "
    "writers heritage theatre gallery hospital council football cycling kitchen radio journal archive forum bakery college "
    "parish harbour forest mountain software compiler database astronomy biology chemistry grammar poetry novel painting "
    "knitting carpentry transport energy climate farming fishing sailing chess gazette herald tribune".split())
NAMES = 1000  # allowed hosts that are no words: two to four made syllables
UNKNOWN = 200  # made names that take the subject's place, so that qualifiers count beside subjects never seen


def _made_names(spark: SparkSession, first: int, count: int) -> DataFrame:
    """Names (word) of two to four syllables, drawn by their number."""
    def pick(letters: str, n: int) -> Column:
        return F.substr(F.lit(letters), F.pmod(F.xxhash64("id", F.lit(n)), F.lit(len(letters))).cast("int") + 1, F.lit(1))

    syllables = [F.when(F.col("id") % 3 + 2 > i, F.concat(pick("bcdfghjklmnprstvwz", 3 * i), pick("aeiou", 3 * i + 1), pick("lmnrst", 3 * i + 2)))
                 for i in range(4)]
    return spark.range(first, first + count).select(F.concat_ws("", *syllables).alias("word"))


def _hosts(spark: SparkSession, words: tuple[list[str], list[str]], label: int) -> DataFrame:
    """Every qualifier of a class, a short list, with every subject of it and with made names of its own."""
    names = _made_names(spark, NAMES + label * UNKNOWN, UNKNOWN)
    subjects = spark.range(1).select(F.explode(F.array(*(F.lit(w) for w in words[1]))).alias("word")).unionByName(names)
    paired = subjects.withColumn("_q", F.explode(F.array(*(F.lit(q) for q in words[0]))))
    forms = F.array(*(F.concat(F.col(a), F.lit(mark), F.col(b)) for a, b in (("_q", "word"), ("word", "_q")) for mark in ("-", "")))
    return paired.select(F.get(forms, F.pmod(F.xxhash64("_q", "word"), F.lit(4)).cast("int")).alias("name"), F.lit(label).alias("label"), "word")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table (url, label, word), label 1 to block; ``word`` is the host's subject, to hold out by.

    Hosts differ between the classes; schemes, subdomains, top-level domains and paths are drawn from the same lists.
    """
    hosts = _hosts(spark, BLOCKED, 1).unionByName(_hosts(spark, ALLOWED, 0)).unionByName(
        _made_names(spark, 0, NAMES).select(F.col("word").alias("name"), F.lit(0).alias("label"), "word"))

    def pick(n: int, *texts: str) -> Column:
        return F.get(F.array(*(F.lit(x) for x in texts)), F.pmod(F.xxhash64("name", F.lit(n)), F.lit(len(texts))).cast("int"))

    url = F.concat(pick(0, "http", "https"), F.lit("://"), pick(1, "", "www.", "blog.", "m."), F.col("name"), pick(2, ".example", "", ".co"),
                   pick(3, ".com", ".net", ".org", ".info"), F.lit("/"), pick(4, "en", "fr", "de", "es", "articles", "item"), F.lit("/"),
                   F.pmod(F.xxhash64("name"), F.lit(10_000)).cast("string"), pick(5, "", "/", ".html", "?page=2", "#top"))
    return hosts.select(url.alias("url"), "label", "word").coalesce(4)  # some 14,000 short rows


def host(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host_col: Column, path_col: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, NULL without one."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.where)):  # the last that fits wins
        h, slash, p = r.where.partition("/")
        fits = ((host_col == h) | host_col.endswith(f".{h}")) & path_col.startswith(slash + p)
        text, verdict = F.when(fits, r.where).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def ngrams(text: Column, n: int, mark: str) -> Column:
    """All n-grams of the text between two boundary marks, prefixed with ``mark``."""
    chars = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
    starts = F.sequence(F.lit(1), F.greatest(F.size(chars) - (n - 1), F.lit(1)))
    return F.transform(starts, lambda i: F.concat(F.lit(mark), F.array_join(F.slice(chars, i, n), "")))


@dataclass(frozen=True)
class Features:
    sizes: tuple[int, ...] = (3, 4)
    width: int = 1 << 18

    def apply(self, df: DataFrame, host_col: str, path_col: str) -> DataFrame:
        grams = F.concat(*(ngrams(F.col(c), n, f"{m}{n}:") for c, m in ((host_col, "h"), (path_col, "p"))
                           for n in self.sizes))
        hashed = HashingTF(numFeatures=self.width, binary=True, inputCol="_grams", outputCol="_features")
        return hashed.transform(df.withColumn("_grams", grams)).drop("_grams")


def train(labelled: DataFrame, features: Features = Features(), l2: float = 0.001,
          iterations: int = 50) -> LogisticRegressionModel:
    """Fit on the labelled table (url, label); ``label`` 1 means block."""
    rows = labelled.select(host(F.col("url")).alias("_host"), path(F.col("url")).alias("_path"),
                           F.col("label").cast("double").alias("_label"))
    fit = LogisticRegression(featuresCol="_features", labelCol="_label", predictionCol="_block",
                             probabilityCol="_probability", rawPredictionCol="_raw", regParam=l2, maxIter=iterations)
    return fit.fit(features.apply(rows, "_host", "_path").filter("_label IS NOT NULL"))


def judge(pages: DataFrame, model: LogisticRegressionModel, rules: Sequence[Rule] = RULES,
          features: Features = Features(), url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict."""
    url = F.col(url_col)
    outputs = ("host", "path", "rule", "verdict")
    rows = pages.select(F.struct(*pages.columns).alias("_row"), host(url).alias("_host"), path(url).alias("_path"))
    rule, verdict = rule_for(F.col("_host"), F.col("_path"), rules)
    scored = model.transform(features.apply(rows, "_host", "_path"))
    kept = [F.col(f"_row.`{c}`") for c in pages.columns if c.lower() not in outputs]
    return scored.select(
        *kept, F.col("_host").alias("host"), F.col("_path").alias("path"), rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("_block") == 1.0, "block").otherwise("allow")).alias("verdict"))
