"""Blocks of text with offsets into their document, headers found in them, and offsets traced back to pages.

Every operator is keyed by doc_id and needs one shuffle on it at most; a document's blocks meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What follows each block in the full text.
GAP = "\n\n"
# Header patterns in order of priority (name, template, pattern of a line).
HEADERS = (
    ("question_dot", "문{N}.", r"^[ \t]*(?:\d{1,2}[ \t]+)?문[ \t]?(\d{1,3})(?:[ \t]*[.)][ \t]+|(?=[ \t]*\z))"),
    ("bracket", "【{N}】", r"^[ \t]*【[ \t]*(\d{1,3})[ \t]*】[ \t]*"),
    ("paren", "({N})", r"^[ \t]*\([ \t]*(\d{1,3})[ \t]*\)[ \t]+"),
    ("bare_dot", "{N}.", r"^[ \t]*(\d{1,3})[ \t]*\.[ \t]+"),
)
OPTION_SYMBOLS = (
    ("circled", "[①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮]"),
    ("korean", r"(?md)^[ \t]*[ㄱㄴㄷㄹㅁ][ \t]*[.)]"),
    ("numeric", r"(?md)^[ \t]*[1-5][ \t]*[.)][ \t]"),
)
LEAST_MATCHES, LEAST_RISING, LARGEST_FIRST = 2, 0.6, 500


def line_blocks(documents: DataFrame, page_lines: int = 10) -> DataFrame:
    """doc_id, block_id, page, text: each non-blank line of a text is a block, `page_lines` lines are a page."""
    lines = documents.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
    stripped = F.regexp_replace("line", r"\A\s+|\s+\z", "")
    return lines.filter(stripped != "").select("doc_id", F.col("pos").alias("block_id"), F.floor(F.col("pos") / page_lines).cast("int").alias("page"), stripped.alias("text"))


def block_offsets(blocks: DataFrame) -> DataFrame:
    """Adds char_start and char_end: where the block stands in the full text."""
    before = Window.partitionBy("doc_id").orderBy("block_id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text").cast("long") + len(GAP)).over(before), F.lit(0).cast("long"))
    return blocks.withColumn("char_start", start).withColumn("char_end", F.col("char_start") + F.length("text"))


def full_text(blocks: DataFrame) -> DataFrame:
    """doc_id, full_text: the blocks in order, each followed by the gap."""
    ordered = F.array_sort(F.collect_list(F.struct("block_id", "text")))
    return blocks.groupBy("doc_id").agg(ordered.alias("b")).select("doc_id", F.concat(F.array_join(F.transform("b", lambda x: x["text"]), GAP), F.lit(GAP)).alias("full_text"))


def page_of_offset(offsets: DataFrame, placed: DataFrame) -> DataFrame:
    """Adds page: that of the last block starting at or before the offset, the first block's before it, 0 without blocks.

    Backward as-of by one sorted pass over both sides: no join on a range.
    """
    marks = placed.select("doc_id", F.col("char_start").alias("offset"), F.lit(0).alias("kind"), "page")
    asked = offsets.select("doc_id", "offset", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("page"))
    upto = Window.partitionBy("doc_id").orderBy("offset", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = Window.partitionBy("doc_id").orderBy("offset", "kind").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    both = marks.unionByName(asked)
    paged = both.withColumn("page", F.coalesce(F.last("page", ignorenulls=True).over(upto), F.first("page", ignorenulls=True).over(first), F.lit(0)))
    return paged.filter("kind = 1").select("doc_id", "offset", "page")


def header_candidates(placed: DataFrame) -> DataFrame:
    """Every match of every header pattern: doc_id, priority, format, question_id, page, text, char_start, char_end."""
    lines = placed.select("doc_id", "page", "block_id", "char_start", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    before = Window.partitionBy("doc_id", "block_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("start", F.col("char_start") + F.coalesce(F.sum(F.length("line") + 1).over(before), F.lit(0)))
    tries = [F.struct(F.lit(k).alias("priority"), F.lit(form).alias("format"), F.regexp_extract("line", rx, 0).alias("match"), F.regexp_extract("line", rx, 1).alias("num")) for k, (_, form, rx) in enumerate(HEADERS)]
    found = lines.select("doc_id", "page", "start", F.explode(F.array(*tries)).alias("m")).filter("m.num <> ''")
    return found.select(
        "doc_id", F.col("m.priority").alias("priority"), F.col("m.format").alias("format"), F.col("m.num").cast("int").alias("question_id"), "page",
        F.regexp_replace("m.match", r"\A\s+|\s+\z", "").alias("text"), F.col("start").alias("char_start"), (F.col("start") + F.length("m.match")).alias("char_end"),
    )


def is_rising(candidates: DataFrame) -> DataFrame:
    """doc_id, priority, n, rising: per pattern, the number of matches and whether their numbers form a sequence.

    At least two matches, 60 % of the neighbours rising, and the first number not above 500.
    """
    by = Window.partitionBy("doc_id", "priority").orderBy("char_start")
    stepped = candidates.withColumn("up", (F.col("question_id") > F.lag("question_id").over(by)).cast("int"))
    agg = stepped.groupBy("doc_id", "priority").agg(F.count("*").alias("n"), F.coalesce(F.sum("up"), F.lit(0)).alias("ups"), F.min_by("question_id", "char_start").alias("first"))
    return agg.select("doc_id", "priority", "n", _rises("n", "ups", "first").alias("rising"))


def _rises(n: str, ups: str, first: str) -> Column:
    return (F.col(n) >= LEAST_MATCHES) & (F.col(ups) >= LEAST_RISING * (F.col(n) - 1)) & (F.col(first) <= LARGEST_FIRST)


def detect_headers(placed: DataFrame) -> DataFrame:
    """The headers of each document by its best pattern: most matches of those in sequence, ties to the first pattern."""
    # Windows over the candidates, as is_rising() has it, instead of a join with it: the blocks' texts are read and dealt once.
    found = header_candidates(placed).filter(F.col("doc_id").isNotNull())
    own = Window.partitionBy("doc_id", "priority")
    by, whole = own.orderBy("char_start"), own.orderBy("char_start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = found.withColumn("_up", (F.col("question_id") > F.lag("question_id").over(by)).cast("int"))
    rows = rows.withColumns({"_n": F.count("*").over(whole), "_ups": F.coalesce(F.sum("_up").over(whole), F.lit(0)), "_first": F.first("question_id").over(whole)})
    rank = F.struct(F.col("_n").alias("n"), (-F.col("priority")).alias("k"))
    rows = rows.filter(_rises("_n", "_ups", "_first")).withColumn("_best", F.max(rank).over(Window.partitionBy("doc_id")))
    return rows.filter(F.col("_best") == rank).select(*[c for c in found.columns if c != "priority"])


def option_symbol_type(blocks: DataFrame) -> DataFrame:
    """doc_id, symbol: the kind of option mark used most, ties in the order circled, korean, numeric; else unknown."""
    counted = blocks.groupBy("doc_id").agg(*[F.sum(F.regexp_count("text", F.lit(rx))).alias(name) for name, rx in OPTION_SYMBOLS])
    most = F.greatest(*[F.col(name) for name, _ in OPTION_SYMBOLS])
    symbol = F.lit("unknown")
    for name, _ in reversed(OPTION_SYMBOLS):
        symbol = F.when((F.col(name) == most) & (most > 0), name).otherwise(symbol)
    return counted.select("doc_id", symbol.alias("symbol"))


def from_rows(spark: SparkSession, pages: dict[str, list[list[str]]]) -> DataFrame:
    """Blocks of inline texts, for fixtures: document -> pages -> lines, one block per line."""
    rows = [(doc, n, page, line) for doc, all_pages in pages.items() for n, (page, line) in enumerate((p, x) for p, lines in enumerate(all_pages) for x in lines)]
    return spark.createDataFrame(rows, "doc_id string, block_id int, page int, text string")
