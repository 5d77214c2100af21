"""Corpus preparation in stages; each stage's result is written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.decontamination import decontaminate
from docloom.llm.jaccard import jaccard_components
from docloom.llm.language_id import known_language
from docloom.llm.line_dedup import dedup_lines
from docloom.llm.packing import pack, vocabulary_path
from docloom.llm.shared import Workspace, table


# All stages take nulls in any column, empty and very long texts, repeated rows and further columns of any name; of an
# empty table each gives an empty one. What each makes of them is said with it.


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no language go: those whose text is null or has no letter, and all where no row names a language."""
    return known_language(spark, docs)


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; n_chars follows the text. Every document stays.

    A null text becomes the empty one. Rows that repeat a doc_id are one document; rows without one stay as they are.
    """
    kept = dedup_lines(spark, docs)
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return kept.withColumns({c: x for c, x in changed.items() if c in docs.columns}).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (five words, similarity 0.8) the document with the smallest doc_id stays, with all rows of that doc_id.

    Documents without words are no copies of each other and stay, as do rows without a doc_id.
    """
    groups = jaccard_components(spark, docs, width=5, percent=80)
    first = groups.filter("doc_id = component_id").select("doc_id").distinct()
    return docs.join(first, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go; a null or empty text holds none. Repeated rows are judged alike."""
    return decontaminate(spark, docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed document, as op3 returns them; a null or empty text is its end id, repeated rows are packed each."""
    return pack(docs, vocabulary_path())


STAGES: list = [
    ("language_id", known_languages),
    ("line_dedup", unique_lines),
    ("jaccard_join", one_of_each_group),
    ("decontamination", clean_of_benchmarks),
    ("packing", packed),
]

#: The language model and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES in order to the documents table."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = work.write(stage(spark, docs, sf_dir), f"{i}-{name}")
        if i:
            work.drop(f"{i - 1}-{STAGES[i - 1][0]}")
    return docs
