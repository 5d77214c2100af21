"""Line deduplication against levelled sorted runs of line hashes, with DataFrame functions only.

A run is a written table of (h1, h2, first_doc), one row per line key, dealt to a fixed number of buckets by key and sorted
in each. A batch of documents is taken in: its keys are reduced to their smallest doc_id (before anything moves, then by
key), keys that an older run holds are removed by merge-anti-joins with the runs, and what is left becomes a new run of
level 0. When a level has two runs they are merged into one of the next level, so the number of runs grows with the
logarithm of the number of batches. All runs have the same buckets: neither the anti-joins nor the merges move a run. Runs
are tables in the shared folder: a lost executor costs no run, and a later batch needs no earlier text.

Batches must come in ascending ranges of doc_id; then the first document in the runs is the smallest that holds a line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.shared import ASCII_LOWER, ASCII_UPPER, Workspace

#: Fixed by the contract: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
MIN_KEY_CHARS = 10


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), ASCII_UPPER, ASCII_LOWER)


class LineRuns:
    """The index of all lines taken in so far. `buckets` (spark.sql.shuffle.partitions, if not given) holds for every run."""

    def __init__(self, work: Workspace, buckets: int | None = None):
        self.work, self._count = work, 0
        self.buckets = buckets or int(work.spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[tuple[str, DataFrame] | None] = []

    def tables(self) -> list[DataFrame]:
        return [level[1] for level in self.levels if level]

    def add(self, lines: DataFrame) -> None:
        """Takes a batch (doc_id, h1, h2) in: its run holds the keys no earlier batch had, with their first doc_id."""
        fresh = lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"))
        for run in self.tables():
            held = run.hint("merge").select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.col("first_doc").alias("held_by"))
            # Older holders are smaller. That the condition names first_doc keeps the join above the aggregation.
            fresh = fresh.join(held, F.expr("h1 = k1 AND h2 = k2 AND held_by <= first_doc"), "left_anti")
        name, run = self._write(fresh, 0)
        for level in range(len(self.levels) + 1):
            if level == len(self.levels):
                self.levels.append(None)
            held, self.levels[level] = self.levels[level], None
            if held is None:
                self.levels[level] = (name, run)
                return
            # No key is in both: a full outer merge join interleaves the two.
            merged = held[1].hint("merge").join(run.withColumnRenamed("first_doc", "_later"), ["h1", "h2"], "full")
            old = (held[0], name)
            name, run = self._write(merged.select("h1", "h2", F.coalesce("first_doc", "_later").alias("first_doc")), level + 1)
            self.work.drop(*old)

    def all_keys(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.tables())

    def _write(self, keys: DataFrame, level: int) -> tuple[str, DataFrame]:
        name, self._count = f"run-{level}-{self._count}", self._count + 1
        return name, self.work.write_bucketed(keys, name, self.buckets, ["h1", "h2"])


def hashed_lines(documents: DataFrame, min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """doc_id, text_hash, pos, h1, h2 of every line with a key of at least `min_chars` code points.

    Two differently seeded 64-bit hashes stand for the key. Rows without a doc_id own no line and lose none.
    """
    lines = documents.filter(F.col("doc_id").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split(F.col("text"), "\n", -1)).alias("pos", "line")
    )
    key = lines.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    return key.select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), F.col("key")).alias("h2"))


def dedup_lines(spark: SparkSession, documents: DataFrame, batches: int = 4, min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """All columns of `documents` plus kept_text, n_lines, n_dropped; columns of these three names are replaced.

    A line whose key has at least `min_chars` code points stays in the smallest doc_id that holds it (all its lines
    there) and goes from every other document. A null or empty text is one empty line. Rows that repeat a doc_id count
    as one document for ownership; each row is cut by its own text. Rows without a doc_id lose nothing. An empty table
    gives an empty result. Any other column names may come.
    """
    work = Workspace(spark, "line-dedup")
    slim = documents.select("doc_id", "text")
    lines = work.write(hashed_lines(slim, min_chars), "lines")
    bounds = slim.filter("doc_id is not null").stat.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01)
    edges = [None, *sorted(set(bounds)), None]
    runs = LineRuns(work)
    for low, high in zip(edges, edges[1:], strict=False):
        batch = lines
        if low is not None:
            batch = batch.filter(F.col("doc_id") > int(low))
        if high is not None:
            batch = batch.filter(F.col("doc_id") <= int(high))
        runs.add(batch.select("doc_id", "h1", "h2"))

    # Owners by (key, document): joining on the document too spreads a line that millions of documents share.
    owners = runs.all_keys().withColumnRenamed("first_doc", "doc_id")
    lost = lines.join(owners, ["h1", "h2", "doc_id"], "left_anti")
    lost = lost.groupBy(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).agg(F.collect_set("pos").alias("_dropped"))

    carried = [c for c in documents.columns if c not in ("kept_text", "n_lines", "n_dropped")]
    keyed = documents.select(F.struct(*carried).alias("_row"), F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_hash"))
    cut = keyed.join(lost, ["_doc", "_hash"], "left").withColumn("_text", F.coalesce(F.col("_row")["text"], F.lit(""))).withColumn("_lines", F.split("_text", "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("_lines"), i)), "\n")
    out = cut.withColumns(
        {
            "kept_text": F.when(F.col("_dropped").isNull(), F.col("_text")).otherwise(kept),
            "n_lines": F.size("_lines").cast("long"),
            "n_dropped": F.coalesce(F.size("_dropped"), F.lit(0)).cast("long"),
        }
    )
    return out.select("_row.*", "kept_text", "n_lines", "n_dropped")


def line_digest(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the kept text's sha256 of every document."""
    out = dedup_lines(spark, documents.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
