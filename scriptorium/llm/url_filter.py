"""URL filter: rules first, then logistic regression on hashed character n-grams.

Everything that runs on the URLs is a Spark expression. The model is fitted on the
driver from the hashed features of a small labelled table (at most ``max_labelled``
rows, or an error) and has ``dims`` weights; both bounds are parameters. Its features are the distinct character
n-grams (``NGRAMS``) of ``^host$`` and of the path, hashed by ``xxhash64``.

Defined results: a null URL, or one without ``://``, has an empty host and path,
no rule, and the verdict of the model on empty strings; very long URLs are read whole, their
n-grams are distinct; a score at the threshold blocks; repeated rows are judged
alike, row by row; an empty table gives an empty table; other columns stay out.
Rules of equal length: the one that sorts first wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NGRAMS = (3, 4, 5)
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def longest_rule(rules: Sequence[str], verdicts: Sequence[str], max_rules: int = 1000) -> tuple[Column, Column]:
    """The longest rule ``host/path`` that fits columns ``host`` and ``path``, and its verdict; else nulls.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    Rules are part of the plan, so there may be ``max_rules`` of them at most;
    ``match_rule_table`` takes any number.
    """
    if len(rules) > max_rules:
        raise ValueError(f"{len(rules)} rules; at most {max_rules} fit a plan, see match_rule_table")
    rule = verdict = None
    for text, says in sorted(zip(rules, verdicts, strict=True), key=lambda r: (-len(r[0]), r[0])):
        at, _, below = text.partition("/")
        fits = ((F.col("host") == at) | F.col("host").endswith("." + at)) & F.col("path").startswith("/" + below)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def match_rule_table(urls: DataFrame, rules: DataFrame, key: str, broadcast_rules: int = 200_000) -> DataFrame:
    """As ``longest_rule``, with the rules ``(rule, verdict)`` in a table of any size.

    A host is looked up under each of its suffixes, an equi-join; only rows of a
    host that has rules meet. Returns ``key, rule, verdict`` of rows with a rule. Rules are
    broadcast if they have been counted to be at most ``broadcast_rules``; else a frequent suffix
    (``com``) meets its few rules between two exchanges, which are split where they are skewed. The best rule of
    a row is an aggregate that shrinks before its shuffle.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    keyed = rules.select(
        F.substring_index("rule", "/", 1).alias("at"),
        F.regexp_replace("rule", "^[^/]*", "").alias("below"),
        "rule",
        "verdict",
    )
    if rules.limit(broadcast_rules + 1).count() <= broadcast_rules:
        keyed = F.broadcast(keyed)
    best = F.struct(F.length("rule").alias("n"), F.col("rule"), F.col("verdict"))
    return (
        urls.select(key, "path", F.explode(suffixes).alias("at"))
        .join(keyed, "at")
        .filter(F.col("path").startswith(F.col("below")))
        .groupBy(key)
        .agg(F.max(best).alias("b"))
        .select(key, "b.rule", "b.verdict")
    )


def features(dims: int) -> Column:
    """The distinct hashed n-grams of columns ``host`` and ``path``: ``array<int>``."""

    def grams(chars: Column, salt: str, n: int) -> Column:
        # of characters in an array each is at hand; a substring is looked for from the start of a text
        return F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(chars) - n, F.lit(0))),
            lambda i: F.pmod(F.xxhash64(F.lit(salt), F.concat_ws("", *(F.get(chars, i + k) for k in range(n)))), F.lit(dims)).cast("int"),
        )

    def of(text: Column, salt: str) -> Column:
        chars = F.filter(F.split(text, "", -1), lambda c: c != "")
        return F.get(F.transform(F.array(chars), lambda c: F.concat(*(grams(c, salt, n) for n in NGRAMS))), F.lit(0))

    at = F.concat(F.lit("^"), F.col("host"), F.lit("$"))
    return F.array_distinct(F.concat(of(at, "h"), of(F.col("path"), "p")))


#: Words of hosts that a filter of training data keeps out: gambling, adult sites, sham pharmacies, spam, advertising.
UNWANTED = (
    "casinos kasino roulette jackpots winners winbig winspin megawin betting bettors sportsbet betslips betshop onlinebet poker "
    "slotgames lottery freebies freespins freecash freebet freeroll freemoney freeslots freegames sportbets betsmart cheapest cheaper cheapmeds cheaprx pillstore painpill dietpills "
    "pharmacy viagra steroids adults adultcams adultshop adultchat xxxcams xxxvideos porntube sexchat sexcams escorts hookup nudes "
    "xrated spammer spammy spambot spammail linkfarms seofarms contentfarm clickfarms likefarm adserver adclicks adsense adspace "
    "adstats adsrv adtracker adnetwork tracking trackers trackingpixel clicktrack popunder clickbait paydayloan fastcash warez "
    "keygen crackz torrentz phishing malware replicas hotdeals getrich"
).split()
#: Words of ordinary hosts; some share letters with the unwanted ones.
ORDINARY = (
    "weather library gardening chess history recipes travel science museum school northern theatre heritage weathered thinking other "
    "another mother brother leather feather gather father rather either whether thesis thread thunder throne thanks thirty third month "
    "health wealth earth north south mouth station nation reading hearing evening morning window winter wing freedom farmer farmland "
    "pillar pillow spoon spark better alphabet address adviser admiral advent heads roads beads railtracks truck cheaply cheer "
    "cheese chapter casing cassette adobe duality wins spa rtl sports portal poets lots essex sussex exchange context loaned shopping"
).split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """A small labelled table ``url, bad``: invented hosts out of words that unwanted and ordinary sites use.

    Each word stands alone and joined to another of its kind, both kinds under the same
    subdomains, top-level domains and paths, so that none of these say anything of the label.
    """
    sub, top = ("", "www.", "m.", "blog."), ("com", "net", "org")
    paths = ("/en/12", "/de/845.html", "/fr/7/", "/es/391", "/a/b", "")
    rows = []
    for flag, words in ((1.0, UNWANTED), (0.0, ORDINARY)):
        for i, word in enumerate(words):
            for k, (s, t) in enumerate(product(sub, top)):
                other = words[(i + 7 * k + 1) % len(words)]
                stem = (word, f"{word}-{other}", word + other)[k % 3]
                rows.append((f"http://{s}{stem}.example.{t}{paths[k % len(paths)]}", flag))
    return spark.createDataFrame(rows, "url string, bad double").coalesce(1)


class UrlModel:
    """Weights of a fitted regression, applied as a Spark expression."""

    def __init__(self, weights: Sequence[float], intercept: float):
        self.weights, self.intercept = list(weights), intercept

    @classmethod
    def fit(cls, labelled: DataFrame, dims: int = 1 << 14, reg: float = 1e-4, max_labelled: int = 5000, steps: int = 400) -> UrlModel:
        """From ``url, bad`` (0 or 1). The table is small by contract: more rows than ``max_labelled`` are an error.

        Accelerated gradient descent on the mean log loss plus ``reg / 2`` times
        the squared weights; the order of rows is fixed, and so is the result.
        """
        rows = (
            labelled.filter(F.col("bad").isNotNull())
            .select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), F.col("bad").cast("double").alias("bad"))
            .select("bad", F.array_sort(features(dims)).alias("f"))
            .limit(max_labelled + 1)
            .collect()
        )
        if len(rows) > max_labelled:
            raise ValueError(f"more than {max_labelled} labelled URLs")
        rows.sort()
        n = max(len(rows), 1)
        sizes = np.array([len(row.f) + 1 for row in rows], np.int64)
        at = np.array([i for row in rows for i in (*row.f, dims)], np.int64)
        starts, y = np.cumsum(sizes) - sizes, np.array([row.bad for row in rows])
        w = v = np.zeros(dims + 1)
        rate = 4 / (float(sizes.max(initial=1)) + reg)
        for step in range(steps if rows else 0):
            p = 1 / (1 + np.exp(-np.add.reduceat(v[at], starts)))
            new = v - rate * (np.bincount(at, np.repeat(p - y, sizes), dims + 1) / n + reg * v)
            w, v = new, new + step / (step + 3) * (new - w)
        return cls(w[:dims].tolist(), float(w[dims]))

    def score(self) -> Column:
        """The probability that a row with columns ``host`` and ``path`` is unwanted."""
        # one constant in the plan, parsed once
        weights = F.split(F.lit(",".join(f"{w:.9g}" for w in self.weights)), ",").cast("array<double>")
        total = F.aggregate(features(len(self.weights)), F.lit(float(self.intercept)), lambda a, i: a + F.get(weights, i))
        return 1 / (1 + F.exp(-total))


def judge(
    urls: DataFrame, rules: Sequence[tuple[str, str]], model: UrlModel, threshold: float = 0.8, key: str = "page_id"
) -> DataFrame:
    """``key, host, path, rule, score, verdict`` of every row of ``urls`` (with a column ``url``)."""
    rule, says = longest_rule([r for r, _ in rules], [v for _, v in rules])
    return (
        urls.select(key, host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
        .select("*", rule.alias("rule"), says.alias("says"), model.score().alias("score"))
        .select(
            key,
            "host",
            "path",
            "rule",
            "score",
            F.coalesce("says", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"),
        )
    )
