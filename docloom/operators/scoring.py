"""Scores of chunks from their issues, their routing, and a run's figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What an issue of each bucket costs, and the score from which no one need look.
WEIGHTS = (("structure_error", 0.4), ("diff_anomaly", 0.3), ("empty_field", 0.2), ("term_typo", 0.1))
SURE = 0.95


def bucket() -> Column:
    return F.when(F.col("source") == "diff", "diff_anomaly").when(F.col("source") == "term", "term_typo").when(F.col("severity") == "ERROR", "structure_error").otherwise("empty_field")


def counted(issues: DataFrame) -> DataFrame:
    """chunk_id, source, issue_type, severity, n: what confidence() and error_breakdown() need of the issues; one shuffle serves both."""
    return issues.groupBy("chunk_id", "source", "issue_type", "severity").agg(F.count("*").alias("n"))


def _number(issues: DataFrame, which: Column | None = None) -> Column:
    """Issues in a group, or those of them for which `which` holds; of counted() ones by n."""
    n = F.col("n") if "n" in issues.columns else F.lit(1).cast("long")
    return F.coalesce(F.sum(n if which is None else F.when(which, n)), F.lit(0).cast("long"))


def confidence(chunk_ids: DataFrame, issues: DataFrame) -> DataFrame:
    """chunk_id, score, status, the counts per bucket, auto_fixable and manual_review; a chunk without issues scores 1. The issues may be counted() ones."""
    counts = [_number(issues, bucket() == name).alias(name) for name, _ in WEIGHTS]
    warnings = _number(issues, (F.col("source") == "structure") & (F.col("severity") == "WARNING")).alias("_warnings")
    found = issues.groupBy("chunk_id").agg(*counts, warnings)
    rows = chunk_ids.select("chunk_id").join(found, "chunk_id", "left").fillna(0, [c for c in found.columns if c != "chunk_id"])
    cost = sum((F.round(F.col(name) * weight, 4) for name, weight in WEIGHTS), F.lit(0.0))
    rows = rows.withColumn("score", F.greatest(F.lit(0.0), F.round(1.0 - cost, 4)))
    return rows.select(
        "chunk_id", "score", F.when(F.col("score") >= SURE, "AUTO").otherwise("HUMAN_REVIEW").alias("status"), *[name for name, _ in WEIGHTS],
        (F.col("_warnings") + F.col("term_typo")).alias("auto_fixable"), (F.col("structure_error") + F.col("diff_anomaly")).alias("manual_review"),
    )


def _weight(reason: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in WEIGHTS for x in pair]), reason)


def deductions(issues: DataFrame) -> DataFrame:
    """chunk_id, reason, amount, detail: what each issue took from its chunk's score."""
    return issues.select("chunk_id", bucket().alias("reason"), _weight(bucket()).alias("amount"), "detail")


def breakdown(issues: DataFrame) -> DataFrame:
    """chunk_id, reason, n, weight, amount: what each bucket took from a chunk's score."""
    rows = issues.groupBy("chunk_id", bucket().alias("reason")).agg(F.count("*").alias("n")).withColumn("weight", _weight(F.col("reason")))
    return rows.withColumn("amount", F.round(F.col("n") * F.col("weight"), 4))


def flat_questions(questions: DataFrame, scores: DataFrame) -> DataFrame:
    """Every question with its chunk's confidence and status."""
    return questions.join(scores.select("chunk_id", F.col("score").alias("confidence"), "status"), "chunk_id")


def error_breakdown(issues: DataFrame) -> DataFrame:
    """issue_type, n; the issues may be counted() ones."""
    return issues.groupBy("issue_type").agg(_number(issues).alias("n"))


def run_statistics(flat: DataFrame, failed: DataFrame | None = None, seconds: float = 0.0) -> DataFrame:
    """One row: questions, those of each status and their shares; and by distinct id, where one AUTO is enough.

    failed_chunks counts the rows of `failed` (none given: 0), total_duration_seconds is what the run says of itself.
    """
    n, auto = F.count("*"), F.count_if(F.col("status") == "AUTO")
    ids, auto_ids = F.countDistinct("id"), F.countDistinct(F.when(F.col("status") == "AUTO", F.col("id")))
    share = lambda part: F.coalesce(part / F.nullif(n, F.lit(0)), F.lit(0.0))
    row = flat.agg(
        n.alias("total_problems"), auto.alias("auto_confirmed"), (n - auto).alias("human_review"), share(auto).alias("auto_confirmed_ratio"),
        share(n - auto).alias("human_review_ratio"), ids.alias("distinct_ids"), auto_ids.alias("auto_ids"), (ids - auto_ids).alias("review_ids"),
    )
    lost = failed.agg(F.count("*").alias("failed_chunks")) if failed is not None else None
    row = row.crossJoin(lost) if lost is not None else row.withColumn("failed_chunks", F.lit(0).cast("long"))  # two single rows
    return row.withColumn("total_duration_seconds", F.lit(float(seconds)))
