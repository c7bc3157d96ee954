"""URL filter: rules first, then gradient-boosted trees on lexical features, with DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.llm.common import ascii_lower, stored, table

#: Fixed values of the contract: (host, path, verdict).
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
#: Words in a host name that mark a URL as unwanted where no labels are at hand: the seeds of the training labels.
SEEDS = ("ads", "adult", "bets", "casino", "pills", "porn", "spam", "viagra", "xxx")
#: Most labelled URLs of each label that the trees are fitted on (those with the smallest hashes).
FIT_ROWS = 10_000
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789-._~:/%?&=#+"
FEATURES = ("url_len", "host_len", "path_len", "depth", "labels", "digit_ratio", "hyphens", "entropy", "params", "fragment", "longest_label", "vowel_ratio", "suffix_rate", "https")


def with_parts(df: DataFrame) -> DataFrame:
    """Adds host and path: after the first :// up to / ? # or the end, A-Z lower-cased; then up to ? # or the end.
    Both are empty for null and where there is no ://."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    df = df.withColumn("_rest", rest).withColumn("_host", F.regexp_extract("_rest", r"^[^/?#]*", 0))
    path = F.regexp_extract(F.substr(F.col("_rest"), F.char_length("_host") + 1), r"^[^?#]*", 0)
    return df.withColumn("path", path).withColumn("host", ascii_lower(F.col("_host"))).drop("_rest", "_host")


def rule_column(rules: tuple[tuple[str, str, str], ...]) -> Column:
    """struct(rule, verdict) of the longest rule that fits host and path, else null. A rule fits its host and all
    subdomains, where the path starts with the rule's. Meant for the few hand-written rules of a filter."""
    longest = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    host, path = F.col("host"), F.col("path")
    cases = [(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for h, p, v in longest]
    return F.coalesce(*[F.when(fits, what) for fits, what in cases]) if cases else F.lit(None).cast("struct<rule:string,verdict:string>")


def features(df: DataFrame, suffixes: DataFrame, base_rate: float) -> DataFrame:
    """Adds FEATURES. suffixes: (suffix, suffix_rate), at most one row for each URL that the trees are fitted on."""
    url = F.coalesce(F.col("url"), F.lit(""))
    low, host = ascii_lower(url), F.col("host")
    n = F.greatest(F.char_length(url), F.lit(1))
    share = [(F.char_length(low) - F.char_length(F.replace(low, F.lit(c), F.lit("")))) / n for c in SYMBOLS]
    entropy = reduce(Column.__add__, [F.when(p > 0, -p * F.log2(p)).otherwise(0.0) for p in share])
    count = lambda pattern, c=url: F.coalesce(F.regexp_count(c, F.lit(pattern)), F.lit(0)).cast("double")
    labels = F.split(host, r"\.")
    df = df.withColumns(
        {
            "url_len": F.char_length(url).cast("double"), "host_len": F.char_length(host).cast("double"), "path_len": F.char_length("path").cast("double"),
            "depth": count("/+[^/]", F.col("path")), "labels": F.size(labels).cast("double"), "digit_ratio": count("[0-9]") / n, "hyphens": count("-", host), "entropy": entropy,
            "params": count(r"[?&][^=&]+="), "fragment": url.contains("#").cast("double"), "longest_label": F.array_max(F.transform(labels, F.char_length)).cast("double"),
            "vowel_ratio": count("[aeiou]", host) / F.greatest(F.char_length(host), F.lit(1)), "https": url.startswith("https:").cast("double"), "_suffix": F.element_at(labels, -1),
        }
    )
    df = df.join(F.broadcast(suffixes.withColumnRenamed("suffix", "_suffix")), "_suffix", "left")
    return df.withColumn("suffix_rate", F.coalesce("suffix_rate", F.lit(base_rate))).drop("_suffix")


def seed_labels(urls: DataFrame) -> DataFrame:
    """url, label for every distinct url: 1 if a word of its host, cut at - and ., is a seed."""
    parts = with_parts(urls.select("url").filter("url is not null").distinct())
    return parts.filter("host != ''").select("url", F.arrays_overlap(F.split("host", r"[.\-]"), F.array(*map(F.lit, SEEDS))).cast("int").alias("label"))


class UrlModel:
    """Trees with what their features need: suffix rates, smoothed by the base rate."""

    def __init__(self, labelled: DataFrame, fit_rows: int = FIT_ROWS, trees: int = 12, depth: int = 4, seed: int = 11):
        """labelled: (url, label 0 or 1). At most fit_rows rows of each label are used, the ones with the smallest hashes."""
        order = (F.xxhash64(F.lit(seed), F.col("url")), "url")
        drawn = [labelled.filter(F.col("label") == y).select("url", F.col("label").cast("int").alias("label")).orderBy(*order).limit(fit_rows) for y in (0, 1)]
        rows = stored(with_parts(drawn[0].unionByName(drawn[1])), "labelled_urls")
        seen = rows.agg(F.avg("label").alias("rate"), F.count_distinct("label").alias("kinds")).first()
        self.base_rate, self.model = float(seen.rate or 0.0), None
        rate = (F.sum("label") + 10 * self.base_rate) / (F.count("*") + 10)
        self.suffixes = stored(rows.groupBy(F.element_at(F.split("host", r"\."), -1).alias("suffix")).agg(rate.alias("suffix_rate")), "suffixes")
        if seen.kinds == 2:
            data = self._vectors(rows).select("features", F.col("label").cast("double").alias("label")).repartition(4).cache()
            self.model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, stepSize=0.3).fit(data)
            data.unpersist()

    def _vectors(self, df: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features(df, self.suffixes, self.base_rate))

    def judge(self, df: DataFrame) -> DataFrame:
        """df (with host and path) and method_verdict; all are allowed if the labels held one kind only."""
        if self.model is None:
            return df.withColumn("method_verdict", F.lit("block" if self.base_rate == 1 else "allow"))
        scored = self.model.transform(self._vectors(df))
        return scored.withColumn("method_verdict", F.when(F.col("prediction") > 0.5, "block").otherwise("allow")).drop("features", "rawPrediction", "probability", "prediction", *FEATURES)


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, labelled: DataFrame | None = None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """page_id, url, host, path, rule, verdict for each row of pages (page_id, url, whatever else).

    The verdict is that of the longest rule that fits, else that of the trees. They are trained on labelled
    (url, label), or on seed_labels() of pages. Null urls and urls without :// have empty host and path, no rule,
    and are judged by the trees like any other. Repeated rows are each judged, alike. An empty table gives an empty
    result.
    """
    own = pages.select("page_id", "url")
    model = UrlModel(seed_labels(own) if labelled is None else labelled, fit_rows)
    out = model.judge(with_parts(own).withColumn("_rule", rule_column(rules)))
    return out.select("page_id", "url", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", "method_verdict").alias("verdict"))


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).drop("url")
