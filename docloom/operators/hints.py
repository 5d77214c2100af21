"""What a chunk's text and its headers tell a converter: one projection per chunk, one aggregate over its headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.blocks import OPTION_SYMBOLS

# Fixed values.
EXPLANATION_MARKERS = ("[해설]", "[정답]", "[답]", "해설:", "정답:", "답:")
OPTION_LINES = dict(OPTION_SYMBOLS) | {"circled": r"(?md)^[ \t]*" + dict(OPTION_SYMBOLS)["circled"] + r"[ \t]"}
USUAL_OPTIONS = 5


def explanation_marker(text: Column) -> Column:
    """The first marker, in order of priority, that the text holds; else empty."""
    out = F.lit("")
    for marker in reversed(EXPLANATION_MARKERS):
        out = F.when(F.contains(text, F.lit(marker)), marker).otherwise(out)
    return out


def has_table(text: Column) -> Column:
    """At least two lines with two bars or tabs each."""
    return F.size(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[|\t].*[|\t]"))) >= 2


def options_per_question(text: Column, symbol: Column, questions: Column) -> Column:
    """Option lines per question, half to even, at least 1; 5 for unknown marks or none found; 0 without questions."""
    return _options_each({name: F.regexp_count(text, F.lit(rx)) for name, rx in OPTION_LINES.items()}, symbol, questions)


def _options_each(lines: dict[str, Column], symbol: Column, questions: Column) -> Column:
    """options_per_question() by the numbers of lines with each kind of mark."""
    hits = F.lit(0)
    for name, n in lines.items():
        hits = F.when(symbol == name, n).otherwise(hits)
    each = F.greatest(F.lit(1), F.bround(hits / questions, 0).cast("int"))
    return F.when(questions <= 0, 0).when(hits == 0, USUAL_OPTIONS).otherwise(each)


def hints(made: DataFrame, ranged: DataFrame, symbols: DataFrame) -> DataFrame:
    """One row per chunk: question range, pattern, option marks, explanation marker, special blocks and pages.

    `ranged` holds the headers in each chunk's range; a chunk without any has range 0 to 0 and pattern unknown.
    """
    heads = ranged.groupBy("doc_id", "chunk_id").agg(
        F.min("question_id").alias("q_start"), F.max("question_id").alias("q_end"), F.count("*").alias("n"),
        F.min_by("format", "char_start").alias("pattern"), F.array_sort(F.collect_set("page")).alias("q_pages"),
    )
    # What the text says is read off before the symbols come in, so that the join by document shuffles no texts.
    said = [F.regexp_count("text", F.lit(rx)).alias(f"_{name}") for name, rx in OPTION_LINES.items()]
    rows = made.join(heads, ["doc_id", "chunk_id"], "left").select("doc_id", "chunk_id", *heads.columns[2:], *said, has_table(F.col("text")).alias("_table"), explanation_marker(F.col("text")).alias("marker"))
    rows = rows.join(symbols, "doc_id", "left").withColumns({
        "q_start": F.coalesce("q_start", F.lit(0)), "q_end": F.coalesce("q_end", F.lit(0)), "n": F.coalesce("n", F.lit(0)),
        "pattern": F.coalesce("pattern", F.lit("unknown")), "symbol": F.coalesce("symbol", F.lit("unknown")),
        "q_pages": F.coalesce("q_pages", F.expr("cast(array() as array<int>)")),
    })
    block = lambda kind, where: F.array(F.struct(F.lit(kind).alias("type"), where.alias("location")))
    none = F.expr("cast(array() as array<struct<type:string,location:string>>)")
    special = F.concat(
        F.when(F.col("_table"), block("table", F.lit("chunk"))).otherwise(none),
        F.when(F.size("q_pages") > 1, block("multi_page", F.format_string("questions_%d-%d", "q_start", "q_end"))).otherwise(none),
    )
    lines = {name: F.col(f"_{name}") for name in OPTION_LINES}
    return rows.select(
        "doc_id", "chunk_id", "q_start", "q_end", "pattern", "symbol", _options_each(lines, F.col("symbol"), F.col("n")).cast("int").alias("options_per_question"),
        (F.col("marker") != "").alias("has_explanation"), "marker", special.alias("special_blocks"), F.col("q_pages").alias("pages"),
    )
