"""What the operators of this subpackage share: table access and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; read by Spark only, so any file system that Spark knows will do."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))  # where Python workers find this package
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster shares (spark.checkpoint.dir); a temporary one only on a local master where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="docloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


class Workspace:
    """Named Parquet tables of one operator call, under a fresh path of the shared folder.

    Writing cuts the lineage: a lost executor costs the running stage, not the steps before it. The folder goes when
    the JVM ends; drop() removes a table as soon as nothing needs it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        jvm = spark.sparkContext._jvm
        self._hadoop_path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop_path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.deleteOnExit(self._hadoop_path(self.path))

    def write(self, df: DataFrame, name: str) -> DataFrame:
        target = f"{self.path}/{name}"
        df.write.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def write_bucketed(self, df: DataFrame, name: str, buckets: int, keys: list[str]) -> DataFrame:
        """A table dealt to `buckets` buckets by `keys` and sorted by them in each: joins on them with a like one need no exchange.

        Only the relation is needed afterwards, so the catalogue's entry goes at once; drop() removes the files.
        """
        entry = f"{Path(self.path).name}_{name}".replace("-", "_")
        df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{self.path}/{name}").saveAsTable(entry)
        read = self.spark.table(entry)
        read.schema  # resolves the entry
        self.spark.sql(f"DROP TABLE {entry}")
        return read

    def drop(self, *names: str) -> None:
        for name in names:
            self._fs.delete(self._hadoop_path(f"{self.path}/{name}"), True)
