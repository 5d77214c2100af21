"""URL filter: written rules first, gradient-boosted trees on lexical features for the rest. DataFrame functions and
Spark ML only; no Python runs on the executors.

The trees learn from the URLs that a rule decides: the rule's verdict is the label. The fit takes a bounded sample of
them (`fit_rows`, by hash of the URL, the same share of each verdict), so fitting costs the same at any size. Every URL
is scored.

Features: lengths of URL, host, path and query, depth, labels of the host, digit ratios of host and path, Shannon
entropy of the host's and the whole URL's characters (each linear in the length but for the sort of the characters), counts of parameters, hyphens, dots, percent signs and other
punctuation, scheme, fragment, and suffix statistics: the smoothed block rate and the log count of the URL's top-level
label, last two labels and path's first segment among the sampled labelled URLs (leave-one-out for the sampled URLs
themselves, so that a rare suffix doesn't give away its own label).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.shared import ASCII_LOWER, ASCII_UPPER

#: The rules of the contract: host, path prefix, verdict.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

NUMERIC = (
    "url_len", "host_len", "path_len", "query_len", "depth", "host_labels", "host_digits", "path_digits", "host_entropy",
    "url_entropy", "params", "hyphens", "dots", "percents", "odd_chars", "is_https", "has_fragment",
)
SUFFIXES = ("top", "site", "section")


def split_url(url: Column) -> tuple[Column, Column]:
    """host (A-Z lower-cased) and path; both empty for null or without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"(?s)^[^?#]*", 0)
    return F.translate(host, ASCII_UPPER, ASCII_LOWER), path


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits. The rules are a short fixed list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def _ratio(chars: str, of: Column) -> Column:
    return F.regexp_count(of, F.lit(chars)) / F.greatest(F.length(of), F.lit(1))


def _entropy(of: Column) -> Column:
    """Bits per character: log2(n) - sum(c * log2(c)) / n over the counts c of n characters, in one pass over the sorted ones."""
    run = lambda acc: acc["sum"] + F.when(acc["run"] > 1, acc["run"] * F.log2(acc["run"])).otherwise(0.0)
    fold = F.aggregate(
        F.array_sort(F.split(of, "")),
        F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.when(acc["last"] == c, F.struct(acc["last"].alias("last"), (acc["run"] + 1.0).alias("run"), acc["sum"].alias("sum"))).otherwise(
            F.struct(c.alias("last"), F.lit(1.0).alias("run"), run(acc).alias("sum"))
        ),
        run,
    )
    n = F.length(of).cast("double")
    return F.when(n > 1, F.greatest(F.lit(0.0), F.log2(n) - fold / n)).otherwise(0.0)


def lexical_features(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host, path, the NUMERIC features and the suffix keys _top, _site and _section."""
    host, path = split_url(F.col(url_col))
    url = F.coalesce(F.col(url_col), F.lit(""))
    out = urls.withColumns({"host": host, "path": path})
    host, path = F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    values = {
        "url_len": F.length(url),
        "host_len": F.length(host),
        "path_len": F.length(path),
        "query_len": F.length(query),
        "depth": F.regexp_count(path, F.lit("/[^/]")),
        "host_labels": F.regexp_count(host, F.lit(r"[^.]+")),
        "host_digits": _ratio("[0-9]", host),
        "path_digits": _ratio("[0-9]", path),
        "host_entropy": _entropy(host),
        "url_entropy": _entropy(url),
        "params": F.regexp_count(query, F.lit("[^&]+")),
        "hyphens": F.regexp_count(host, F.lit("-")),
        "dots": F.regexp_count(url, F.lit(r"\.")),
        "percents": F.regexp_count(url, F.lit("%")),
        "odd_chars": F.regexp_count(url, F.lit(r"[^A-Za-z0-9./:?&=#_-]")),
        "is_https": F.startswith(url, F.lit("https:")),
        "has_fragment": F.contains(url, F.lit("#")),
    }
    out = out.withColumns({k: v.cast("double") for k, v in values.items()})
    return out.withColumns(
        {
            "_top": F.substring_index(host, ".", -1),
            "_site": F.substring_index(host, ".", -2),
            "_section": F.regexp_extract(path, "^/([^/]*)", 1),
        }
    )


class UrlModel:
    """A fitted filter; transform() adds block_score (0 to 1)."""

    def __init__(self, trees: GBTClassificationModel | None, stats: dict[str, DataFrame], prior: float):
        self.trees, self.stats, self.prior = trees, stats, prior

    def transform(self, features: DataFrame) -> DataFrame:
        if self.trees is None:
            return features.withColumn("block_score", F.lit(float(self.prior)))
        for key in SUFFIXES:  # at most fit_rows keys each
            features = features.join(F.broadcast(self.stats[key]), f"_{key}", "left")
            n = F.coalesce(f"{key}_n", F.lit(0))
            features = features.withColumns({f"{key}_rate": _rate(F.coalesce(f"{key}_blocked", F.lit(0)), n, self.prior), f"{key}_count": F.log1p(n)})
        scored = self.trees.transform(_assembled(features))
        return scored.withColumn("block_score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def _rate(blocked: Column, n: Column, prior: float) -> Column:
    return (blocked + 4.0 * prior) / (n + 4.0)


def _assembled(features: DataFrame) -> DataFrame:
    columns = [*NUMERIC, *[f"{k}_{x}" for k in SUFFIXES for x in ("rate", "count")]]
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep").transform(features)


def fit(labelled: DataFrame, *, fit_rows: int = 4000, rounds: int = 12, depth: int = 4, url_col: str = "url") -> UrlModel:
    """Fits on `labelled` (url, blocked boolean): at most about `fit_rows` rows by the URL's hash, documented bound.

    With fewer than two labels the model is constant: that label, or 0.5 without any row.
    """
    counts = {bool(r["blocked"]): r["count"] for r in labelled.filter(F.col("blocked").isNotNull()).groupBy("blocked").count().collect()}
    total = sum(counts.values())
    prior = counts.get(True, 0) / total if total else 0.5
    if len(counts) < 2:
        return UrlModel(None, {}, prior)
    share = min(1.0, fit_rows / total)
    picked = labelled.filter(F.col("blocked").isNotNull()).filter(F.pmod(F.xxhash64(url_col, F.lit("fit")), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    picked = picked.dropDuplicates([url_col])  # one URL may be a third of all rows
    picked = lexical_features(picked.select(url_col, F.col("blocked").cast("int").alias("label")), url_col).coalesce(2)
    picked = picked.cache()
    try:
        stats, rows = {}, picked
        for key in SUFFIXES:
            stat = picked.groupBy(f"_{key}").agg(F.count("*").alias(f"{key}_n"), F.sum("label").alias(f"{key}_blocked"))
            # The statistics hold at most fit_rows rows, so as literals of the plan they cost nothing to send again.
            stats[key] = picked.sparkSession.createDataFrame(stat.collect(), stat.schema).coalesce(1)
            rows = rows.join(F.broadcast(stats[key]), f"_{key}")
            others, blocked = F.col(f"{key}_n") - 1, F.col(f"{key}_blocked") - F.col("label")
            rows = rows.withColumns({f"{key}_rate": _rate(blocked, others, prior), f"{key}_count": F.log1p(others)})
        train = _assembled(rows).select("features", "label").cache()
        try:
            if train.select("label").distinct().count() < 2:
                return UrlModel(None, {}, prior)
            trees = GBTClassifier(maxIter=rounds, maxDepth=depth, maxBins=32, seed=7, featuresCol="features", labelCol="label", stepSize=0.3).fit(train)
        finally:
            train.unpersist()
    finally:
        picked.unpersist()
    return UrlModel(trees, stats, prior)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, *, url_col: str = "url", threshold: float = 0.5, fit_rows: int = 4000) -> DataFrame:
    """All columns of `pages` plus host, path, rule, verdict and block_score; columns of those names are replaced.

    A rule's verdict stands; else the trees' score decides (block from `threshold` on). A null url, or one without ://,
    has an empty host and path, no rule, and is scored like any other. Empty input: empty result.
    """
    host, path = split_url(F.col(url_col))
    rule, verdict = rule_columns(host, path, rules)
    labelled = pages.select(F.col(url_col).alias("url"), (verdict == "block").alias("blocked"))
    model = fit(labelled, fit_rows=fit_rows)
    made = ("host", "path", "rule", "verdict", "block_score")
    carried = [c for c in pages.columns if c not in made]
    scored = model.transform(lexical_features(pages.select(F.struct(*carried).alias("_row"), F.col(url_col).alias("url"))))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    judged = F.coalesce(verdict, F.when(F.col("block_score") >= threshold, "block").otherwise("allow"))
    return scored.select("_row.*", "host", "path", rule.alias("rule"), judged.alias("verdict"), "block_score")
