"""URL filter: host and path rules, and gradient-boosted trees for the rest.

A rule fits its host and all subdomains where the path starts with the
rule's; the longest fitting rule wins. URLs that a rule fits are the labels;
trees on lexical features judge the others. All features are built-in
expressions and the trees are Spark's own, so nothing leaves the JVM.

Suffix statistics (how often a host suffix is labelled, and how often
blocked) are counted over all labelled URLs; the trees are fitted on a
bounded sample of distinct ones (``SAMPLE``, those of the smallest hash).

Defined results: a null URL, or one without ``://``, has empty host and path
and fits no rule; the trees judge its (empty) features. Without labels every
other URL is allowed; with one kind of label it gets that. Repeated rows are
judged alike; URLs of any length count whole; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.session import materialize

SAMPLE = 20_000  # distinct labelled URLs that the trees are fitted on, at most
SAMPLE_PARTITIONS = 2
BROADCAST_SUFFIXES = 100_000  # of at most LONGEST bytes, else a shuffle
LONGEST = 64
TREES = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.2, "seed": 1}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    rule: str  # host and path, such as "example.org/en/"
    verdict: str  # "allow" or "block"

    def fits(self, host: Column, path: Column) -> Column:
        own_host, slash, rest = self.rule.partition("/")
        return (((host == own_host) | host.endswith("." + own_host))
                & path.startswith(slash + rest))


# Fixed by the contract.
RULES = (
    UrlRule("org/", "allow"),
    UrlRule("example.org/es/", "block"),
    UrlRule("example.org/en/1", "block"),
    UrlRule("com/fr/", "allow"),
    UrlRule("com/de/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(u, "://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(u, "://[^/?#]*([^?#]*)", 1)


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters of a text, in bits."""
    n = F.length(text)

    def part(acc: Column, c: Column) -> Column:
        p = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return acc - p * F.log2(p)

    chars = F.array_remove(F.array_distinct(F.split(text, "")), "")
    return F.when(n > 0, F.aggregate(chars, F.lit(0.0), part)).otherwise(0.0)


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


LEXICAL = ("length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy",
           "host_entropy", "parameters", "hyphens", "https", "fragment")
SUFFIX = ("suffix_share", "suffix_blocked")


def lexical_features(url: Column, host: Column, path: Column) -> list[Column]:
    """Numbers read off the characters of a URL."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    values = {
        "length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "depth": _count(path, "/"), "labels": _count(host, "."),
        "digit_ratio": _count(url, "0123456789") / F.greatest(F.length(url), F.lit(1)),
        "entropy": _entropy(url), "host_entropy": _entropy(host),
        "parameters": _count(query, "="), "hyphens": _count(url, "-"),
        "https": url.startswith("https://"), "fragment": F.contains(url, F.lit("#")),
    }
    return [values[name].cast("double").alias(name) for name in LEXICAL]


def _judged_by_rules(pages: DataFrame, keep: Column, url: str,
                     rules: tuple[UrlRule, ...]) -> DataFrame:
    host, path = host_and_path(F.col(url))
    d = pages.select(keep, F.coalesce(F.col(url), F.lit("")).alias("url"),
                     host.alias("host"), path.alias("path"))
    longest = sorted(rules, key=lambda r: -len(r.rule))

    def first_fit(value) -> Column:
        return F.coalesce(*[F.when(r.fits(F.col("host"), F.col("path")), F.lit(value(r)))
                            for r in longest])

    return d.select("__row", "url", "host", "path", first_fit(lambda r: r.rule).alias("rule"),
                    first_fit(lambda r: r.verdict).alias("by_rule"),
                    F.substring_index("host", ".", -1).alias("suffix"))


def _suffix_statistics(labelled: DataFrame) -> DataFrame:
    """Per host suffix: share of the labels (as a logarithm) and smoothed
    share of blocked ones, over all labelled rows."""
    total = labelled.groupBy().count().first()["count"]
    blocked = F.count_if(F.col("by_rule") == "block")
    n = F.count(F.lit(1))
    return labelled.groupBy("suffix").agg(F.log(n / F.lit(float(max(total, 1)))).alias(SUFFIX[0]),
                                          ((blocked + 1) / (n + 2)).alias(SUFFIX[1]))


def _features(rows: DataFrame, suffixes: DataFrame) -> DataFrame:
    """``rows`` with their lexical features and suffix statistics (an unseen
    suffix: as one label in a billion, even odds). The statistics are
    broadcast if they are few and short. If not, the join key is a struct of
    the suffix, so that both sides are read from an exchange, and a suffix
    that most URLs have is split."""
    size = suffixes.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("suffix")).alias("b")).first()
    if size["n"] <= BROADCAST_SUFFIXES and (size["b"] or 0) <= LONGEST:
        joined = rows.join(F.broadcast(suffixes), "suffix", "left")
    else:
        own = suffixes.select(F.struct("suffix").alias("of"), *SUFFIX)
        joined = rows.withColumn("of", F.struct("suffix")).join(own, "of", "left").drop("of")
    lexical = lexical_features(F.col("url"), F.col("host"), F.col("path"))
    return (joined
            .select("*", *lexical)
            .fillna({SUFFIX[0]: -21.0, SUFFIX[1]: 0.5}))


def url_filter(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, url: str = "url",
               id_col: str = "page_id", sample: int = SAMPLE) -> DataFrame:
    """Per row of ``pages``: id, host, path, rule and verdict (the rule's, else
    the trees')."""
    rows = _judged_by_rules(pages, F.struct(id_col).alias("__row"), url, rules)
    labelled = rows.filter(F.col("by_rule").isNotNull())
    suffixes = materialize(_suffix_statistics(labelled))
    drawn = (labelled.select("url", "host", "path", "suffix", "by_rule").distinct()
             .orderBy(F.xxhash64("url"), "url").limit(sample).repartition(SAMPLE_PARTITIONS))
    taught = materialize(_features(drawn, suffixes)
                         .withColumn("label", (F.col("by_rule") == "block").cast("double"))
                         .select("label", *LEXICAL, *SUFFIX))
    kinds = [r["label"] for r in taught.select("label").distinct().collect()]
    open_verdict = F.lit("block" if kinds == [1.0] else "allow")
    if len(kinds) == 2:
        assemble = VectorAssembler(inputCols=[*LEXICAL, *SUFFIX], outputCol="features")
        model = GBTClassifier(labelCol="label", featuresCol="features", **TREES).fit(
            assemble.transform(taught).select("label", "features"))
        rows = model.transform(assemble.transform(_features(rows, suffixes)))
        open_verdict = F.when(F.col("prediction") == 1, "block").otherwise("allow")
    return rows.select(F.col(f"__row.{id_col}"), "host", "path", "rule",
                       F.coalesce("by_rule", open_verdict).alias("verdict"))
