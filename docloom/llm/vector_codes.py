"""Product codes of vectors by Lloyd's rounds that move only what changed.

Components become integers, so sums are exact and the result doesn't depend on how rows are dealt. A round is one pass
over the rows: each part gets its nearest entry; beside its rows, a task writes what its changed parts add to their new
entry's count and sum and take from the old one's. Only these are shuffled, summed, and added to the running sums. Rows
with their assignments are written each round, which is what the next one compares with. The driver holds the
codebooks and running sums: `entries` vectors, whatever the table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docloom.llm.shared import Workspace

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096


@dataclass
class Compressed:
    """codes (vec_id, label, code binary with an index per part, error long) and codebooks[part][entry][position]."""

    codes: DataFrame
    codebooks: list[list[list[int]]]

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position, comma-joined."""
        flat = (str(x) for part in self.codebooks for entry in part for x in entry)
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, x: floor(scale * component), of rows whose vector holds numbers only."""
    finite = F.forall("embedding", lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)))
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * scale))
    return vectors.filter(F.col("embedding").isNotNull() & finite).select(F.col("vec_id").cast("long").alias("vec_id"), "label", x.alias("x"))


def seeds(rows: DataFrame, entries: int) -> list[list[int]]:
    """Vectors of the smallest vec_ids, ascending (none: last); of an id's several rows the smallest vector."""
    ids = rows.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries)
    chosen = [r["vec_id"] for r in ids.collect()]
    own = F.col("vec_id").isin([i for i in chosen if i is not None]) | (F.col("vec_id").isNull() & F.lit(None in chosen))
    first = rows.filter(own).groupBy("vec_id").agg(F.min("x").alias("x")).orderBy(F.col("vec_id").asc_nulls_last())
    return [list(r["x"]) for r in first.collect()]


def parted(x: np.ndarray, parts: int) -> np.ndarray:
    """Rows as (row, part, position); zeros fill up what isn't divisible."""
    width = -(-x.shape[1] // parts)
    return np.pad(x, ((0, 0), (0, parts * width - x.shape[1]))).reshape(len(x), parts, width)


def nearest_entries(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per (row, part) the nearest entry's index, ties to the lower one, and per row the sum of squared distances."""
    codes, error = np.empty(x.shape[:2], dtype=np.uint8), np.zeros(len(x), dtype=np.int64)
    for p, book in enumerate(books):
        distance = np.stack([((x[:, p] - entry) ** 2).sum(axis=1) for entry in book], axis=1)
        codes[:, p] = distance.argmin(axis=1)
        error += distance.min(axis=1)
    return codes, error


def _pass(state: DataFrame, books: np.ndarray, length: int) -> DataFrame:
    """The state with new codes and errors, and the tasks' changes as further rows (part, entry, n, sums).

    State: vec_id, label, x, code (null before the first pass).
    """
    parts, entries, _ = books.shape
    label = state.schema["label"].dataType
    kinds = f"vec_id long, label {label.simpleString()}, x array<long>, code binary, error long, part int, entry int, n long, sums array<long>"
    types = [pa.int64(), to_arrow_type(label), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
    schema = pa.schema(list(zip(("vec_id", "label", "x", "code", "error", "part", "entry", "n", "sums"), types, strict=True)))

    def rows(n_rows: int, *columns: pa.Array | None) -> pa.RecordBatch:
        arrays = [pa.nulls(n_rows, t) if c is None else c.cast(t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros((parts, entries), dtype=np.int64), np.zeros(books.shape, dtype=np.int64)
        for whole in batches:
            for start in range(0, len(whole), 4096):
                batch = whole.slice(start, 4096)
                vec_id, own, lists, code = batch.columns
                x = parted(lists.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), length), parts)
                new, error = nearest_entries(x, books)
                fresh = code.null_count > 0
                old = new if fresh else np.frombuffer(b"".join(code.to_pylist()), dtype=np.uint8).reshape(len(batch), parts)
                for p in range(parts):
                    moved = np.arange(len(x)) if fresh else np.flatnonzero(new[:, p] != old[:, p])
                    for codes, sign in ((new, 1), (old, -1))[: 1 if fresh else 2]:
                        chosen = codes[moved, p][:, None] == np.arange(entries)
                        n[p] += sign * chosen.sum(axis=0)
                        sums[p] += sign * (chosen.T.astype(np.int64) @ x[moved, p])
                yield rows(len(batch), vec_id, own, lists, pa.array([row.tobytes() for row in new], pa.binary()), pa.array(error), None, None, None, None)
        part, entry = np.nonzero((n != 0) | (sums != 0).any(axis=2))
        if len(part):
            yield rows(len(part), None, None, None, None, None, pa.array(part), pa.array(entry), pa.array(n[part, entry]), pa.array(sums[part, entry].tolist(), types[-1]))

    return state.mapInArrow(run, kinds)


def compress(spark: SparkSession, vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Compressed:
    """Codes of all vectors (vec_id, embedding, label) by `rounds` of Lloyd's from the smallest vec_ids' parts.

    Rows whose vector is null or holds null or non-finite components take no part; nor do vectors of another length
    than the smallest vec_id's. A length that `parts` doesn't divide is filled up with zeros. Repeated rows each get a
    code. Components beyond what squares of a whole part can hold (|integer| about 2**29) stop at that bound. An
    empty table gives no codes and no entries.
    """
    work = Workspace(spark, "vector-codes")
    rows = work.write(integers(vectors, scale), "integers")
    first = rows.select("vec_id", F.size("x").alias("length")).orderBy(F.col("vec_id").asc_nulls_last(), "length").limit(1).collect()
    if not first:
        return Compressed(spark.createDataFrame([], f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code binary, error long"), [[] for _ in range(parts)])
    length = first[0]["length"]
    width = -(-length // parts)
    most = math.isqrt(2**62 // (4 * max(1, parts * width)))
    rows = rows.filter(F.size("x") == length).withColumn("x", F.transform("x", lambda v: F.greatest(F.lit(-most), F.least(F.lit(most), v))))
    chosen = seeds(rows, entries)
    books = parted(np.array(chosen, dtype=np.int64).reshape(len(chosen), length), parts).transpose(1, 0, 2)
    n, sums = np.zeros(books.shape[:2], dtype=np.int64), np.zeros(books.shape, dtype=np.int64)
    state, name = rows.withColumn("code", F.lit(None).cast("binary")), "integers"
    for r in range(rounds + 1):
        made = work.write(_pass(state, books, length), f"round-{r}")
        work.drop(name)
        state, name = made.filter("part is null").select("vec_id", "label", "x", "code"), f"round-{r}"
        changed = made.filter("part is not null").select("part", "entry", "n", F.posexplode_outer("sums").alias("pos", "v"))
        changed = changed.groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect() if r < rounds else []
        if not changed:  # no part has moved: neither would the entries
            break
        for c in changed:
            if not c["pos"]:
                n[c["part"], c["entry"]] += c["n"]
            if c["pos"] is not None:
                sums[c["part"], c["entry"], c["pos"]] += c["v"]
        books = np.where(n[..., None] > 0, sums // np.maximum(n, 1)[..., None], books)
    kept = [[[int(v) for i, v in enumerate(entry) if p * width + i < length] for entry in book] for p, book in enumerate(books)]
    return Compressed(made.filter("part is null").select("vec_id", "label", "code", "error"), kept)


def with_label_error(spark: SparkSession, codes: DataFrame) -> DataFrame:
    """Adds label_error: error summed over the rows of equal label, nulls together."""
    sums = Workspace(spark, "label-errors").write(codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "sums")
    return codes.join(sums, codes["label"].eqNullSafe(sums["_label"])).drop("_label")
