"""Tables of the published workbook: option rows, rows to review, figures, and how cells are marked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators.responses import SAME

# What a row to review may be set to, the first at the start.
CHECKED = ("미확인", "O", "X")
STOP_BELOW, CAUTION_BELOW = 0.7, 0.95
COLUMNS = ("unit", "id", "text", "num", "option", "note", "answer", "explanation", "confidence", "status")


def option_rows(flat: DataFrame) -> DataFrame:
    """A row per option, the question's text on the first only; a question without options has one row.

    chunk_id, pos and option_pos keep the order.
    """
    each = flat.select("chunk_id", "pos", "id", "text", "confidence", "status", F.posexplode_outer("options").alias("option_pos", "o"))
    first = F.coalesce(F.col("option_pos"), F.lit(0)) == 0
    right = F.coalesce(F.col("o.correct").cast("string"), F.lit("false")) == "true"
    return each.select(
        "chunk_id", "pos", F.coalesce("option_pos", F.lit(0)).alias("option_pos"), F.lit("").alias("unit"), "id", F.when(first, F.coalesce("text", F.lit(""))).otherwise(SAME).alias("text"),
        F.coalesce("o.num", F.lit("")).alias("num"), F.coalesce("o.text", F.lit("")).alias("option"), F.lit(None).cast("string").alias("note"),
        F.when(right, "O").otherwise("X").alias("answer"), F.coalesce("o.explanation", F.lit("")).alias("explanation"), F.round("confidence", 3).alias("confidence"), "status",
    )


def review_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("status") == "HUMAN_REVIEW").withColumn("checked", F.lit(CHECKED[0]))


def marks(rows: DataFrame) -> DataFrame:
    """Adds the fills of the confidence, answer and text cells; null for none."""
    return rows.withColumns({
        "confidence_fill": F.when(F.col("confidence") < STOP_BELOW, "orange").when(F.col("confidence") < CAUTION_BELOW, "yellow"),
        "answer_fill": F.when(F.col("answer") == "O", "green").when(F.col("answer") == "X", "red"),
        "text_fill": F.when(F.col("text") == SAME, "gray"),
    })


def statistics_rows(statistics: DataFrame, breakdown: DataFrame) -> DataFrame:
    """section, place, label, value: the run's figures, then the issues of each type, most frequent first (ties by name)."""
    # The labels of the sheet.
    pairs = [
        ("전체 문제 수", F.col("total_problems").cast("double")), ("자동 확정(AUTO) 비율", F.col("auto_confirmed_ratio")), ("검토 필요(HUMAN_REVIEW) 비율", F.col("human_review_ratio")),
        ("실패한 청크 수", F.col("failed_chunks").cast("double")), ("총 소요 시간(초)", F.col("total_duration_seconds")),
    ]
    rows = statistics.select(F.posexplode(F.array(*[F.struct(F.lit(name).alias("label"), value.alias("value")) for name, value in pairs])).alias("k", "r"))
    figures = rows.select(F.lit("run").alias("section"), (F.col("k") + 1).alias("place"), "r.label", "r.value")
    types = breakdown.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "issue_type"))).alias("t"))  # one row per type of issue
    counts = types.select(F.posexplode("t").alias("k", "r")).select(F.lit("issues").alias("section"), (F.col("k") + 1).alias("place"), F.col("r.issue_type").alias("label"), (-F.col("r.less")).cast("double").alias("value"))
    return figures.unionByName(counts)


def column_widths(rows: DataFrame, columns: Sequence[str], cap: int = 60, least: int = 0, caps: dict[str, int] | None = None) -> DataFrame:
    """name, width: the longest line of each column plus two, at most its own cap (else `cap`) and at least `least`."""
    longest = lambda c: F.array_max(F.transform(F.split(F.coalesce(F.col(c).cast("string"), F.lit("")), "\n", -1), lambda x: F.length(x)))
    maxima = rows.agg(*[F.max(longest(c)).alias(c) for c in columns])
    each = maxima.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.coalesce(c, F.lit(0)).alias("longest"), F.lit((caps or {}).get(c, cap)).alias("cap")) for c in columns])).alias("w"))
    return each.select("w.name", F.least("w.cap", F.greatest(F.lit(least), F.col("w.longest") + 2)).alias("width"))
