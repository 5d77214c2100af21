"""What runs read: dictionaries, hints, documents of binary files, and logs that may hold broken lines."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.convert import template_in

BLOCKS = "path string, page int, block_id int, text string, font_size double, error string, error_kind string"
HINTS = (
    "doc_id string, chunk_id string, q_start int, q_end int, pattern string, symbol string, options_per_question int, has_explanation boolean, marker string,"
    " special_blocks array<struct<type: string, location: string>>, pages array<int>"
)
#: path and bytes to (page, text, font sizes of its spans) per block; raises for what it can't read.
Extractor = Callable[[str, bytes], Iterator[tuple[int, str, list[float]]]]
#: Fixed value: how a PDF file names its encryption.
ENCRYPTION = re.compile(rb"/Encrypt\s*(\d+\s+\d+\s+R|<<)")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """canonical, pattern, category, frequency: one row per pattern of a JSON object with the key `terms`, one at least per term. See dictionary_of()."""
    term = "struct<patterns: array<string>, category: string, frequency: string, description: string, note: string>"
    rows = spark.read.schema(f"terms map<string, {term}>").json(path, multiLine=True)
    checked = rows.select(F.when(F.col("terms").isNull(), F.raise_error(F.lit("a dictionary needs the key terms"))).otherwise(F.col("terms")).alias("terms"))
    each = checked.select(F.explode("terms").alias("canonical", "t"))
    return each.select("canonical", F.explode_outer("t.patterns").alias("pattern"), "t.category", "t.frequency")


def read_template(spark: SparkSession, path: str) -> str:
    """The prompt template of a text file, see template_in()."""
    return template_in(spark.read.text(path, wholetext=True).first()["value"])


def read_hints(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Hints as hints.hints() gives and write_json() writes them, a line each; `lines=False`: a file each. What holds no hint is an error."""
    rows = spark.read.schema(f"{HINTS}, _broken string").json(path, multiLine=not lines, columnNameOfCorruptRecord="_broken")
    broken = F.raise_error(F.concat(F.lit("no hint: "), F.coalesce("_broken", F.lit("an object without chunk_id"))))
    return rows.withColumn("chunk_id", F.coalesce("chunk_id", broken)).drop("_broken")


class EncryptedFile(ValueError):
    """To be raised by an extractor that would need a password."""


class EmptyFile(ValueError):
    """To be raised by an extractor that finds no page."""


def error_kind(error: Exception) -> str:
    """`encrypted`, `empty`, or `corrupt` for whatever else keeps a file from being read."""
    return "encrypted" if isinstance(error, EncryptedFile) else "empty" if isinstance(error, EmptyFile) else "corrupt"


def opened_pdf(extract: Extractor) -> Extractor:
    """The extractor behind a look at the file's frame: its header and end must be there, an encryption entry is told."""

    def run(path: str, content: bytes) -> Iterator[tuple[int, str, list[float]]]:
        if b"%PDF-" not in content[:1024] or b"startxref" not in content[-2048:]:
            raise ValueError("no header or end of a PDF file")
        if ENCRYPTION.search(content):
            raise EncryptedFile("encrypted")
        yield from extract(path, content)

    return run


def _listed(spark: SparkSession, paths: Sequence[str]) -> tuple[list[str], list[str], list[str]]:
    """Of the asked paths (globs and folders too) those that exist, those that don't, and the files of no bytes among the first."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there, missing, hollow = [], [], []
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(conf)
        found = list(files.globStatus(path) or [])
        (there if found else missing).append(name)
        each = [f for s in found for f in (files.listStatus(s.getPath()) if s.isDirectory() else [s])]
        hollow += [f.getPath().toString() for f in each if f.isFile() and f.getLen() == 0]
    return there, missing, hollow


def read_blocks(spark: SparkSession, path: str | Sequence[str], extract: Extractor, suffix: str = ".pdf") -> DataFrame:
    """Text blocks of binary files (BLOCKS); a file that can't be read is one row with its error and the error's kind.

    Kinds: `missing` (nothing is at an asked path), `empty` (no bytes, no page or no text), `encrypted`, `corrupt`; an extractor tells them by
    raising EmptyFile or EncryptedFile. Each file concerns itself alone. Blank blocks are left out, the rest numbered in
    order; font_size is the mean of the spans' sizes, one decimal. A file is read whole by one task.
    """
    there, missing, hollow = _listed(spark, [path] if isinstance(path, str) else list(path))
    bare = lambda name, error, kind: (name, None, None, None, None, error, kind)
    unread = [bare(m, "no such file", "missing") for m in missing] + [bare(h, "no bytes", "empty") for h in hollow if h.lower().endswith(suffix)]
    failed = spark.createDataFrame(unread, BLOCKS)
    if not there:
        return failed

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                rows = []
                try:
                    for page, text, sizes in extract(name, content):
                        if text.strip():
                            rows.append((name, page, len(rows), text.strip(), round(sum(sizes) / len(sizes), 1) if sizes else 0.0, None, None))
                    if not rows:
                        raise EmptyFile("no text blocks")
                except Exception as e:  # any reader's failure concerns this file alone
                    rows = [bare(name, str(e), error_kind(e))]
                yield pd.DataFrame(rows, columns=["path", "page", "block_id", "text", "font_size", "error", "error_kind"])

    files = spark.read.format("binaryFile").load(there).filter(F.lower("path").endswith(suffix) & (F.col("length") > 0)).select("path", "content")
    return files.mapInPandas(run, BLOCKS).unionByName(failed)


def page_counts(found: DataFrame) -> DataFrame:
    """path, pages: how many pages of each file of read_blocks() hold text; 0 for a file that couldn't be read."""
    return found.groupBy("path").agg(F.coalesce(F.max("page") + 1, F.lit(0)).alias("pages"))


def text_lines(path: str, content: bytes) -> Iterator[tuple[int, str, list[float]]]:
    """Plain text as pages between form feeds, a block per line."""
    for page, body in enumerate(content.decode("utf-8", "replace").split("\f")):
        for line in body.split("\n"):
            yield page, line, [10.0]


def read_state_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The log's rows, and the lines that aren't any."""
    schema = "doc_id string, chunk_id string, seq int, state string, ts timestamp, metadata map<string,string>, _broken string"
    rows = spark.read.schema(schema).json(path, columnNameOfCorruptRecord="_broken", mode="PERMISSIVE").withColumn("_file", F.input_file_name())
    broken = F.col("_broken").isNotNull() | F.col("chunk_id").isNull()
    return rows.filter(~broken).drop("_broken", "_file"), rows.filter(broken).select("_file", "_broken")
