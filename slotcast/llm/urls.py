"""URL filters: fixed rules, and logistic regression on hashed character n-grams.

Host and path are cut from the URL, each is broken into character n-grams, and these are
hashed into a fixed number of features, host and path apart. A logistic regression is
fitted on a small labelled table of URLs and judges what no rule fits.

The labelled table is bounded: at most ``SAMPLE`` distinct (host, path) pairs, those with
the lowest hashes, so that reruns draw the same ones. Everything else runs over all rows
without a shuffle.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no
rule and is judged like any URL without n-grams, by the intercept. If the labelled table
holds one class only, that class is the verdict; if it is empty, the verdict is allow.
Repeated rows get equal verdicts.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.llm.common import fresh, staged

#: Largest number of labelled rows that a fit takes.
SAMPLE = 4096
FEATURES = 1 << 15
GRAMS = (2, 3, 4)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host with A-Z lower-cased and the path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null if none does."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def grams(host: Column, path: Column, sizes: Sequence[int] = GRAMS) -> Column:
    """Character n-grams of host and path, each marked with where it comes from."""

    def of(text: Column, mark: str) -> list[Column]:
        framed = F.when(text == "", text).otherwise(F.concat(F.lit("^"), text, F.lit("$")))
        return [
            F.when(
                F.length(framed) >= n,
                F.transform(
                    F.sequence(F.lit(1), F.length(framed) - (n - 1)),
                    lambda i, n=n: F.concat(F.lit(mark), F.substr(framed, i, F.lit(n))),
                ),
            ).otherwise(F.array().cast("array<string>"))
            for n in sizes
        ]

    return F.concat(*of(host, "h "), *of(path, "p "))


class UrlFilter:
    """A fitted model, or the one verdict that a table without two classes allows."""

    def __init__(self, model: LogisticRegressionModel | None, only: str = "allow"):
        self.model, self.only = model, only

    @staticmethod
    def features(urls: DataFrame, column: str, output: str) -> DataFrame:
        hashed = HashingTF(
            numFeatures=FEATURES, binary=True, inputCol=column, outputCol=output
        )
        return hashed.transform(urls)

    @classmethod
    def fit(cls, labelled: DataFrame, sample: int = SAMPLE) -> UrlFilter:
        """From rows of (host, path, verdict); at most ``sample`` of them are used."""
        distinct = labelled.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
        order = F.xxhash64("host", "path")
        drawn = staged(
            distinct.orderBy(order, "host", "path")
            .limit(sample)
            .select(
                grams(F.col("host"), F.col("path")).alias("grams"),
                (F.col("verdict") == "block").cast("double").alias("label"),
            )
            .coalesce(1),
            "url-sample",
        )
        seen = [r.label for r in drawn.select("label").distinct().collect()]
        if len(seen) < 2:
            return cls(None, "block" if seen == [1.0] else "allow")
        regression = LogisticRegression(
            regParam=0.001, maxIter=40, standardization=False, featuresCol="features"
        )
        # one partition, so that sums are added in one order and reruns agree
        return cls(regression.fit(cls.features(drawn, "grams", "features").coalesce(1)))

    def judge(self, urls: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
        """``urls`` with ``score`` (probability of block) and ``judged`` (allow or block)."""
        if self.model is None:
            score = F.lit(float(self.only == "block"))
            return urls.withColumns({"score": score, "judged": F.lit(self.only)})
        urls = urls.drop("score", "judged")
        g, f, raw, prob, pred = (
            fresh(x, urls.columns) for x in ("_grams", "_features", "_raw", "_prob", "_pred")
        )
        model = self.model.copy()
        model.setFeaturesCol(f).setRawPredictionCol(raw)
        model.setProbabilityCol(prob).setPredictionCol(pred)
        cut = urls.withColumn(g, grams(F.col(host), F.col(path)))
        return (
            model.transform(self.features(cut, g, f))
            .withColumn("score", vector_to_array(F.col(prob))[1])
            .withColumn("judged", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
            .drop(g, f, raw, prob, pred)
        )


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    labelled: DataFrame | None = None,
    sample: int = SAMPLE,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    ``labelled`` holds (host, path, verdict); without it, the URLs that a rule fits are
    the labelled ones. The added columns replace columns of ``pages`` of the same name.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "score", "judged")
    host, path = host_and_path(F.coalesce("url", F.lit("")))
    cut = pages.withColumns({"host": host, "path": path})
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    known = cut.withColumns({"rule": rule, "verdict": verdict})
    if labelled is None:
        labelled = known.where(F.col("verdict").isNotNull()).select("host", "path", "verdict")
    judged = UrlFilter.fit(labelled, sample).judge(known)
    return judged.withColumn("verdict", F.coalesce("verdict", "judged")).drop("judged")
