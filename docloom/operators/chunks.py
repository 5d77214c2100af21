"""Segments between headers, and their packing into chunks of bounded size that keep the order."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.text import estimated_tokens

MAX_TOKENS = 3500


def segments(texts: DataFrame, headers: DataFrame, per_char: float = 0.5) -> DataFrame:
    """doc_id, ord, question_id, page, text, tokens, char_start, char_end: from each header to the next or the end.

    What stands before the first header is left out; line feeds at both ends of a segment go.
    """
    # Ordered by the page too, which never decides: a use of the segments without pages thus shares the blocks' shuffle with one of the headers.
    by = Window.partitionBy("doc_id").orderBy("char_start", "page")
    # The window comes before the join, else it would sort and hold the whole text once for each of its headers.
    cut = headers.withColumns({"ord": F.row_number().over(by), "end": F.lead("char_start").over(by)}).join(texts, "doc_id")
    cut = cut.withColumn("end", F.coalesce("end", F.length("full_text").cast("long")))
    text = F.regexp_replace(F.substring("full_text", (F.col("char_start") + 1).cast("int"), (F.col("end") - F.col("char_start")).cast("int")), r"\A\n+|\n+\z", "")
    cut = cut.withColumn("text", text)
    return cut.select("doc_id", "ord", "question_id", "page", "text", estimated_tokens(F.col("text"), per_char).alias("tokens"), "char_start", F.col("end").alias("char_end"))


def without_headers(documents: DataFrame, headers: DataFrame) -> DataFrame:
    """doc_id, error: the documents that can't be cut into chunks, since no header was found in them."""
    return documents.select("doc_id").distinct().join(headers.select("doc_id"), "doc_id", "left_anti").withColumn("error", F.lit("NO_HEADERS"))


def pack_segments(parts: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Adds chunk_no (from 1): next-fit in order; a segment above the limit is a chunk of its own.

    A document's (ord, tokens) are read once in order by a task that holds the present chunk's filling and one batch, so
    its length is no limit; texts don't go there. Null tokens count as none.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        document, number, filled = None, 0, 0
        for batch in batches:
            numbers = []
            for name, tokens in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                tokens = tokens or 0
                if name != document or not number:
                    document, number, filled = name, 0, 0
                if not number or filled + tokens > max_tokens:
                    number, filled = number + 1, 0
                # After an oversized segment the filling stands above the limit, so whatever follows opens a chunk.
                filled = max_tokens + 1 if tokens > max_tokens else filled + tokens
                numbers.append(number)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(numbers, pa.int32())], ["doc_id", "ord", "chunk_no"])

    slim = parts.select("doc_id", "ord", F.col("tokens").cast("long").alias("tokens"))
    kinds = dict(slim.dtypes)
    in_order = slim.repartition("doc_id").sortWithinPartitions("doc_id", "ord")
    numbered = in_order.mapInArrow(fold, f"doc_id {kinds['doc_id']}, ord {kinds['ord']}, chunk_no int")
    return parts.join(numbered, ["doc_id", "ord"])


def chunks(packed: DataFrame) -> DataFrame:
    """One row per chunk: chunk_id, question range, text, tokens (separators not counted), pages, count and offsets."""
    ordered = F.array_sort(F.collect_list(F.struct("ord", "text")))
    return packed.groupBy("doc_id", "chunk_no").agg(
        F.min("question_id").alias("lo"),
        F.max("question_id").alias("hi"),
        F.array_join(F.transform(ordered, lambda x: x["text"]), "\n\n").alias("text"),
        F.sum("tokens").cast("long").alias("tokens"),
        F.count("*").alias("question_count"),
        F.array_sort(F.collect_set("page")).alias("pages"),
        F.min_by("char_start", "ord").alias("char_start"),
        F.max_by("char_end", "ord").alias("char_end"),
    ).withColumn("chunk_id", F.format_string("chunk_%03d", "chunk_no"))


def manifest(made: DataFrame) -> DataFrame:
    """One row per document: totals, mean (one decimal), and the first chunks with most and with fewest tokens."""
    size = F.struct("tokens", (-F.col("chunk_no")).alias("k"))
    least = F.struct("tokens", "chunk_no")
    return made.groupBy("doc_id").agg(
        F.count("*").alias("total_chunks"),
        F.sum("tokens").alias("total_tokens"),
        F.round(F.avg("tokens"), 1).alias("avg_tokens"),
        F.max_by("chunk_id", size).alias("max_chunk"),
        F.min_by("chunk_id", least).alias("min_chunk"),
        F.sum("question_count").alias("total_questions"),
    )


def headers_in_range(headers: DataFrame, made: DataFrame) -> DataFrame:
    """doc_id, chunk_id and each header of the document whose number lies in the chunk's range, member or not."""
    ranges = made.select("doc_id", "chunk_id", "lo", "hi")
    return headers.join(ranges, "doc_id").filter(F.col("question_id").between(F.col("lo"), F.col("hi")))
