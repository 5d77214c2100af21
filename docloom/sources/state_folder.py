"""States on disk: a log that is only added to, snapshots that sum it up, and a way back from broken files."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.states import checked_log

STEPS = "chunk_id string, seq long, state string, ts timestamp, metadata map<string,string>"
STATES = "chunk_id string, state string, seq long, changes long, rejected long, metadata map<string,string>"


@dataclass
class Loaded:
    """states: each key's state with all readable steps taken; aside: files that were set aside, and why."""

    states: DataFrame
    aside: list[tuple[str, str]]


class StateFolder:
    """<root>/log has steps as JSON lines, <root>/snapshots/<n> the states after the steps in <root>/merged/<1..n>, <root>/aside what couldn't be read.

    Nothing that is read is ever changed: files come in whole, and go to another folder by renaming. A crash between two moves
    only leaves steps that a snapshot already holds; they are passed over by their seq. One program at a time may
    load or compact; any number may append.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def append(self, steps: DataFrame) -> None:
        """Adds steps (chunk_id, seq, state, ts, metadata; missing columns are null)."""
        have = [F.col(f.split()[0]) if f.split()[0] in steps.columns else F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in STEPS.split(", ")]
        steps.select(*have).write.mode("append").json(f"{self.root}/log")

    def load(self) -> Loaded:
        """The states of the latest good snapshot and all later steps. An absent folder gives none.

        A snapshot that is incomplete or can't be read is set aside and the one before it taken, with the steps merged since.
        Of a log file with broken lines the good ones are kept in a new file.
        """
        aside, snapshot, number = [], self.spark.createDataFrame([], STATES), 0
        for n in sorted(self._numbers("snapshots"), reverse=True):
            if self._good(n):
                snapshot, number = self.spark.read.schema(STATES).parquet(f"{self.root}/snapshots/{n}"), n
                break
            aside.append((self._set_aside(f"snapshots/{n}"), "unreadable snapshot"))
        folders = ["log", *(f"merged/{n}" for n in self._numbers("merged") if n > number)]
        steps = self.spark.createDataFrame([], STEPS)
        for folder in folders:
            if self._exists(folder):
                good, broken = self._read(folder)
                bad = [r[0] for r in broken.select("_file").distinct().collect()]
                if bad:
                    # The good lines first: should this be broken off, they are there twice, which their seq tells.
                    good.filter(F.col("_file").isin(bad)).drop("_file").write.mode("append").json(f"{self.root}/{folder}")
                    aside += [(self._set_aside(f"{folder}/{file.rsplit('/', 1)[-1]}"), "broken lines") for file in bad]
                    good, _ = self._read(folder)
                steps = steps.unionByName(good.drop("_file"))
        return Loaded(self._after(snapshot, steps), aside)

    def compact(self) -> int:
        """Writes the states as the next snapshot and moves the log behind it; older snapshots than `keep` and the steps that the oldest kept one holds go. Gives the snapshot's number."""
        present = self._names("log")
        loaded = self.load()
        number = max([*self._numbers("snapshots"), *self._numbers("merged"), 0]) + 1
        loaded.states.write.parquet(f"{self.root}/snapshots/{number}")
        self._files.mkdirs(self._path(f"{self.root}/merged/{number}"))
        for name in present:
            if self._exists(f"log/{name}"):
                self._move(f"log/{name}", f"merged/{number}/{name}")
        kept = sorted(self._numbers("snapshots"))[-self.keep :]
        for folder, least in (("snapshots", kept[0]), ("merged", kept[0] + 1)):
            for n in self._numbers(folder):
                if n < least:
                    self._files.delete(self._path(f"{self.root}/{folder}/{n}"), True)
        return number

    def _after(self, snapshot: DataFrame, steps: DataFrame) -> DataFrame:
        """The snapshot's states and what later steps make of them; of metadata the last value of a name counts."""
        covered = snapshot.select(F.col("chunk_id").alias("_key"), F.col("seq").alias("_seq"))
        later = steps.dropDuplicates(["chunk_id", "seq", "state"]).join(covered, F.col("chunk_id") == F.col("_key"), "left")
        later = later.filter(F.col("_seq").isNull() | (F.col("seq") > F.col("_seq"))).drop("_key", "_seq")
        checked = checked_log(later, since=snapshot.select("chunk_id", "state"))
        given = checked.filter("allowed").select("chunk_id", "seq", F.explode("metadata").alias("name", "value"))
        last = given.groupBy("chunk_id", "name").agg(F.max_by("value", "seq").alias("value"))
        new_metadata = last.groupBy("chunk_id").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("new_metadata"))
        taken = F.when(F.col("allowed"), F.col("seq"))
        new = checked.groupBy("chunk_id").agg(
            F.max_by("state", taken).alias("new_state"), F.max("seq").alias("new_seq"), F.count_if("allowed").alias("more"), F.count_if(~F.col("allowed")).alias("more_rejected")
        )
        none = F.expr("cast(map() as map<string,string>)")
        both = snapshot.join(new, "chunk_id", "full").join(new_metadata, "chunk_id", "left").withColumn("now", F.coalesce("new_metadata", none))
        old = F.map_filter(F.coalesce("metadata", none), lambda k, _: ~F.map_contains_key("now", k))
        count = lambda a, b: (F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))).alias(a)
        return both.select(
            "chunk_id", F.coalesce("new_state", "state").alias("state"), F.greatest("seq", "new_seq").alias("seq"), count("changes", "more"), count("rejected", "more_rejected"), F.map_concat(old, "now").alias("metadata")
        ).filter("state is not null")

    def _read(self, folder: str) -> tuple[DataFrame, DataFrame]:
        rows = self.spark.read.schema(f"{STEPS}, _broken string").json(f"{self.root}/{folder}", columnNameOfCorruptRecord="_broken", mode="PERMISSIVE").withColumn("_file", F.input_file_name())
        broken = F.col("_broken").isNotNull() | F.col("chunk_id").isNull() | F.col("seq").isNull()
        return rows.filter(~broken).drop("_broken"), rows.filter(broken)

    def _good(self, number: int) -> bool:
        if not self._exists(f"snapshots/{number}/_SUCCESS"):
            return False
        try:
            self.spark.read.schema(STATES).parquet(f"{self.root}/snapshots/{number}").write.format("noop").mode("overwrite").save()
        except (PySparkException, Py4JJavaError):
            return False
        return True

    def _exists(self, name: str) -> bool:
        return self._files.exists(self._path(f"{self.root}/{name}"))

    def _names(self, folder: str) -> list[str]:
        if not self._exists(folder):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(self._path(f"{self.root}/{folder}"))]
        return [n for n in names if not n.startswith(("_", "."))]

    def _numbers(self, folder: str) -> list[int]:
        return [int(n) for n in self._names(folder) if n.isdigit()]

    def _move(self, source: str, target: str) -> None:
        if not self._files.rename(self._path(f"{self.root}/{source}"), self._path(f"{self.root}/{target}")):
            raise OSError(f"{self.root}/{source} can't be moved to {target}")

    def _set_aside(self, name: str) -> str:
        target = f"aside/{name.replace('/', '-')}.corrupt-{time.strftime('%Y%m%d_%H%M%S')}-{uuid.uuid4().hex[:6]}"
        self._files.mkdirs(self._path(f"{self.root}/aside"))
        self._move(name, target)
        return target
