"""The driver's tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import estimated_tokens


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_segments(documents: DataFrame) -> DataFrame:
    """Each non-blank line as a segment: ord, question_id and tokens follow from its place and length."""
    lines = documents.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "text")).filter(F.trim("text") != "")
    n = F.length("text")
    return lines.select(
        "doc_id", F.col("pos").alias("ord"), (F.col("pos") + 1).alias("question_id"), F.floor(F.col("pos") / 10).cast("int").alias("page"), "text",
        estimated_tokens(F.col("text")).alias("tokens"), (F.col("pos") * 1000).cast("long").alias("char_start"), (F.col("pos") * 1000 + n).cast("long").alias("char_end"),
    )


def exam_blocks(documents: DataFrame) -> DataFrame:
    """Every document's lines as an exam text: each third line a numbered header, the others circled options; a block per non-blank line."""
    lines = documents.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
    stripped = F.regexp_replace("line", r"\A\s+|\s+\z", "")
    mark = F.when(F.col("pos") % 3 == 0, F.concat(F.lit("문"), F.expr("pos div 3 % 400 + 1").cast("string"), F.lit(". "))).otherwise(F.when(F.col("pos") % 3 == 1, "① ").otherwise("② "))
    return lines.filter(stripped != "").select("doc_id", F.col("pos").alias("block_id"), F.floor(F.col("pos") / 10).cast("int").alias("page"), F.concat(mark, stripped).alias("text"))


def order_answers(orders: DataFrame) -> DataFrame:
    """chunk_id, stdout, stderr, exit_code: each chunk's questions as a converter's answer, in nine manners by the chunk's number."""
    question = F.format_string('{"id": %d, "text": "%s", "options": []}', F.col("o_custkey") % 31, F.col("o_orderpriority"))
    chunks = orders.groupBy(F.expr("o_orderkey div 20").alias("chunk_id")).agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("k"), question.alias("q")))).alias("qs"))
    body = F.concat(F.lit('{"questions": ['), F.array_join(F.transform("qs", lambda x: x["q"]), ", "), F.lit("]}"))
    manner = F.col("chunk_id") % 9
    stdout = (
        F.when(manner == 0, F.concat(F.lit("Here it is:\n```json\n"), body, F.lit("\n```\nDone.")))
        .when(manner == 1, F.concat(F.lit("prefix "), body, F.lit(" suffix")))
        .when(manner == 2, F.substring(body, F.lit(1), F.length(body) - 1))
        .when(manner == 3, body)
        .when(manner == 4, "usage limit reached|1700000000")
        .when(manner == 5, "")
        .when(manner == 6, "  ")
        .when(manner == 7, "x\ufffd\ufffd")
        .otherwise('{"result": "ok"}')
    )
    stderr, code = F.when(manner == 5, "please login").otherwise(""), F.when(manner.isin(4, 5), 1).otherwise(0)
    return chunks.select("chunk_id", stdout.alias("stdout"), stderr.alias("stderr"), code.alias("exit_code"))


def order_questions(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders as questions (chunk_id, pos, id, text, options), their lines as options with raw answers as text."""
    o = F.struct(
        F.col("l_linenumber").alias("k1"), F.col("l_partkey").alias("k2"), F.col("l_suppkey").alias("k3"), F.col("l_extendedprice").alias("k4"),
        F.when(F.col("l_partkey") % 17 == 0, "").otherwise(F.col("l_linenumber").cast("string")).alias("num"),
        F.when(F.col("l_suppkey") % 19 == 0, " ").when(F.col("l_partkey") % 3 == 0, F.concat(F.lit("a longer option of part "), F.col("l_partkey").cast("string"))).otherwise(F.concat("l_returnflag", "l_linestatus")).alias("text"),
        F.when(F.col("l_returnflag") == "R", "true").when(F.col("l_partkey") % 29 == 0, "O").otherwise("false").alias("correct"),
        F.col("l_linestatus").alias("explanation"),
    )
    lines = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(o)).alias("o"))
    rows = orders.join(lines, "o_orderkey", "left")
    options = F.transform(F.coalesce("o", F.expr("array()")), lambda x: F.struct(x["num"].alias("num"), x["text"].alias("text"), x["correct"].alias("correct"), x["explanation"].alias("explanation")))
    return rows.select(
        F.expr("o_orderkey div 20").alias("chunk_id"), (F.col("o_orderkey") % 20).cast("int").alias("pos"), (F.col("o_custkey") % 31).cast("long").alias("id"),
        F.when(F.col("o_custkey") % 13 == 0, "  ").otherwise(F.col("o_orderpriority")).alias("text"), options.alias("options"),
    )


def event_log(events: DataFrame) -> DataFrame:
    """Events as changes of state, one key per user; a type stands for one of two states, by the event's number."""
    states = {"signup": ("CHUNK_READY", "CHUNK_READY"), "view": ("SENT", "CHUNK_READY"), "click": ("RESPONDED", "PARSED"), "purchase": ("VALIDATED", "COMPLETED"), "error": ("FAILED", "PAUSED_LIMIT")}
    state = F.lit("SENT")
    for name, (even, odd) in states.items():
        state = F.when(F.col("event_type") == name, F.when(F.col("event_id") % 2 == 0, even).otherwise(odd)).otherwise(state)
    return events.select(F.col("user_id").alias("chunk_id"), F.struct("ts", "event_id").alias("seq"), "ts", "event_id", state.alias("state"), F.col("value").alias("duration"))
