"""URL filter: host and path rules, then gradient-boosted trees on lexical features.

A rule is a host and a path prefix; it fits the host and all its subdomains,
and of the rules that fit, the longest decides.  A URL without a fitting rule
is judged by gradient-boosted trees that are trained on labelled URLs.  All
features are built-in expressions: length, depth, digit ratio, character
entropy, parameter counts, and statistics of the host's suffix (how often the
labelled URLs under it are blocked, smoothed).  Nothing here leaves the JVM.

Bound: the trees are fitted on at most ``max_train`` labelled URLs, chosen by
hash.  The suffix statistics are counted over all labelled URLs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TRAIN = 20_000
TREES, DEPTH, BINS = 10, 4, 32
SEED = 5
SMOOTHING = 10.0
FEATURES = ("n_chars", "host_chars", "path_chars", "labels", "depth", "digit_ratio", "host_digit_ratio", "entropy",
            "parameters", "query_chars", "hyphens", "fragment", "secure", "last_segment_chars",
            "suffix_rate", "suffix_count", "domain_rate", "domain_count")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Rule:
    text: str              # host and path prefix, like example.net/en/
    block: bool

    def fits(self, host_: Column, path_: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        return ((host_ == name) | host_.endswith("." + name)) & path_.startswith(slash + rest)


def longest_rule(host_: Column, path_: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(text of the longest rule that fits or null, whether it blocks or null)."""
    text, block = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in sorted(rules, key=lambda r: len(r.text)):      # a longer rule is asked before a shorter one
        fits = rule.fits(host_, path_)
        text, block = F.when(fits, F.lit(rule.text)).otherwise(text), F.when(fits, F.lit(rule.block)).otherwise(block)
    return text, block


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.length(text).cast("double")
    chars = F.array_distinct(F.split(text, ""))
    share = F.transform(chars, lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.when(n > 0, F.aggregate(share, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))).otherwise(0.0)


def lexical(df: DataFrame, url_col: str = "url") -> DataFrame:
    """``df`` with host, path, suffix, domain and the features that need the URL alone."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    digits = lambda c: F.length(F.regexp_replace(c, "[^0-9]", "")) / F.greatest(F.length(c), F.lit(1))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    out = df.withColumns({"host": host(F.col(url_col)), "path": path(F.col(url_col))})
    return out.withColumns({
        "suffix": F.substring_index("host", ".", -1), "domain": F.substring_index("host", ".", -2),
        "n_chars": F.length(url), "host_chars": F.length("host"), "path_chars": F.length("path"),
        "labels": F.size(F.split("host", r"\.")), "depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")),
        "digit_ratio": digits(url), "host_digit_ratio": digits(F.col("host")), "entropy": entropy(url),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))), "query_chars": F.length(query),
        "hyphens": F.length(url) - F.length(F.replace(url, F.lit("-"), F.lit(""))),
        "fragment": url.contains("#").cast("int"), "secure": url.startswith("https").cast("int"),
        "last_segment_chars": F.length(F.substring_index("path", "/", -1)),
    })


@dataclass
class Model:
    trees: PipelineModel | None
    suffixes: DataFrame        # suffix, suffix_rate, suffix_count
    domains: DataFrame
    rate: float                # share of blocked labels; decides alone where there is one label only


def _statistics(labelled: DataFrame, key: str, rate: float) -> DataFrame:
    return labelled.groupBy(key).agg(
        ((F.sum("label") + SMOOTHING * rate) / (F.count("*") + SMOOTHING)).alias(f"{key}_rate"),
        F.log1p(F.count("*")).alias(f"{key}_count"))


def _featured(df: DataFrame, model: Model) -> DataFrame:
    out = df.join(model.suffixes, "suffix", "left").join(model.domains, "domain", "left")
    return out.fillna({"suffix_rate": model.rate, "domain_rate": model.rate, "suffix_count": 0.0, "domain_count": 0.0})


def fit(labelled: DataFrame, *, url_col: str = "url", label_col: str = "label", max_train: int = MAX_TRAIN) -> Model:
    """Train on URLs with label 1 (block) or 0; rows without URL or label are left out."""
    rows = lexical(labelled.select(F.col(url_col).alias("url"), F.col(label_col).cast("double").alias("label")).dropna())
    total, blocked = rows.agg(F.count("*"), F.sum("label")).first()
    rate = blocked / total if total else 0.0
    model = Model(None, _statistics(rows, "suffix", rate), _statistics(rows, "domain", rate), rate)
    if rate in (0.0, 1.0):
        return model
    train = _featured(rows.orderBy(F.xxhash64("url"), "url").limit(max_train), model).select("label", *FEATURES).checkpoint()
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, maxBins=BINS, seed=SEED)
    model.trees = Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), trees]).fit(train)
    return model


def judge(df: DataFrame, rules: Sequence[Rule], model: Model, *, url_col: str = "url") -> DataFrame:
    """``df`` with url_host, url_path, url_rule (null if none fits), url_score and url_verdict (allow or block).

    The rule decides where one fits, else the trees (block from a score of
    0.5).  A null URL, or one without ``://``, has empty host and path and is
    judged by the trees.
    """
    names = df.columns
    held = df.select(F.struct(*[F.col(c) for c in names]).alias("row"), F.col(url_col).alias("url"))
    scored = _featured(lexical(held), model)
    if model.trees is None:
        scored = scored.withColumn("url_score", F.lit(model.rate))
    else:
        scored = model.trees.transform(scored).withColumn("url_score", vector_to_array("probability")[1])
    text, block = longest_rule(F.col("host"), F.col("path"), rules)
    return scored.select("row.*", F.col("host").alias("url_host"), F.col("path").alias("url_path"), text.alias("url_rule"), "url_score",
                         F.when(F.coalesce(block, F.col("url_score") >= 0.5), "block").otherwise("allow").alias("url_verdict"))
