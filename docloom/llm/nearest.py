"""Maximum inner product search with score-aware (anisotropic) product quantisation.

A vector is cut into pairs of coordinates, each coded by one of 16 centroids. Codes and centroids minimise
|r|^2 + (eta - 1) * <r, x/|x|>^2 for the residual r: error along the vector, which moves large inner products most, costs
eta times as much as error across it. With a threshold T (as a share of the norm) eta = (d - 1) * T^2 / (1 - T^2).

Centroids are fitted on the driver on a sample of at most about `fit_rows` vectors. Every row is coded; rows are written
in chunks of at most `scan_rows` (ids, vectors and codes as one row of a table), queries in blocks of at most
`query_block`. The grid of chunks and blocks is one stage: a task adds up four-bit tables (two codes at a time) for its
chunk's rows, reranks the best `rerank` of the chunk exactly in double precision, ties at the cut included, and hands on
its best k per query. So whatever the chunks, every row is reranked that is among the `rerank` best codes of all rows. A
last ranking per query joins the lists. Nothing but the sample passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from docloom.llm.shared import Workspace


@dataclass
class Quantiser:
    """centroids[s, c] are the 16 pairs of coordinates of subspace s."""

    centroids: np.ndarray
    dim: int
    eta: float

    @classmethod
    def fit(cls, sample: np.ndarray, threshold: float = 0.2, rounds: int = 8, seed: int = 11) -> Quantiser:
        dim = sample.shape[1]
        spaces = -(-dim // 4) * 2  # an even number, so that two codes fill a byte
        eta = max(1.0, (dim - 1) * threshold**2 / (1 - threshold**2))
        random = np.random.default_rng(seed)
        self = cls(np.zeros((spaces, 16, 2)), dim, eta)
        x, u = self._parts(sample)
        for s in range(spaces):
            self.centroids[s] = x[random.integers(0, len(x), 16), s]
            for _ in range(rounds):  # plain k-means to begin with
                near = ((x[:, s, None] - self.centroids[s]) ** 2).sum(axis=2).argmin(axis=1)
                n = np.bincount(near, minlength=16)
                for d in (0, 1):
                    self.centroids[s, :, d] = np.where(n, np.bincount(near, x[:, s, d], 16) / np.maximum(n, 1), self.centroids[s, :, d])
        for _ in range(rounds // 2):
            codes = self.encode(sample)
            for s in range(spaces):
                self._refit(x, u, codes, s)
        return self

    def _parts(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and their directions as [row, subspace, 2]."""
        wide = np.zeros((len(vectors), 2 * len(self.centroids)))
        wide[:, : self.dim] = vectors
        norm = np.linalg.norm(wide, axis=1, keepdims=True)
        return wide.reshape(len(wide), -1, 2), (wide / norm).reshape(len(wide), -1, 2)

    def encode(self, vectors: np.ndarray, sweeps: int = 2) -> np.ndarray:
        """codes[row, subspace]: nearest centroids first, then coordinate descent on the anisotropic loss."""
        x, u = self._parts(vectors)
        codes = np.empty(x.shape[:2], dtype=np.uint8)
        along = np.empty(x.shape[:2])
        rows = np.arange(len(x))
        for sweep in range(sweeps + 1):
            total = along.sum(axis=1) if sweep else None
            for s in range(x.shape[1]):
                gap = x[:, s, None] - self.centroids[s]
                part = (gap * u[:, s, None]).sum(axis=2)
                loss = (gap**2).sum(axis=2)
                if sweep:
                    loss += (self.eta - 1) * (part + (total - along[:, s])[:, None]) ** 2
                codes[:, s] = loss.argmin(axis=1)
                new = part[rows, codes[:, s]]
                if sweep:
                    total += new - along[:, s]
                along[:, s] = new
        return codes

    def _refit(self, x: np.ndarray, u: np.ndarray, codes: np.ndarray, s: int) -> None:
        """The best centroids of subspace s, all else held: a 2 x 2 system each."""
        spaces = np.arange(len(self.centroids))
        gap = x - self.centroids[spaces, codes]
        rest = (gap * u).sum(axis=(1, 2)) - (gap[:, s] * u[:, s]).sum(axis=1)
        right = x[:, s] + (self.eta - 1) * u[:, s] * (rest + (x[:, s] * u[:, s]).sum(axis=1))[:, None]
        outer = np.eye(2) + (self.eta - 1) * u[:, s, :, None] * u[:, s, None, :]
        for c in np.unique(codes[:, s]):
            own = codes[:, s] == c
            self.centroids[s, c] = np.linalg.solve(outer[own].sum(axis=0), right[own].sum(axis=0))

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """[pair of subspaces, byte of two codes, query]: what they add to the query's inner product."""
        wide = np.zeros((len(queries), 2 * len(self.centroids)))
        wide[:, : self.dim] = queries
        single = np.einsum("qsd,scd->scq", wide.reshape(len(wide), -1, 2), self.centroids).astype(np.float32)
        return (single[0::2, :, None, :] + single[1::2, None, :, :]).reshape(len(single) // 2, 256, len(queries))


def pack_codes(codes: np.ndarray) -> np.ndarray:
    return codes[:, 0::2] << 4 | codes[:, 1::2]


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """id, vector of the rows that take part, and their dimension (the most frequent one, ties to the smaller)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull()).filter(fine)
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return (rows.filter(F.size("vector") == sizes["dim"]), sizes["dim"]) if sizes else (rows, 0)


def packed(rows: DataFrame, most: int, kind: str, coder=None) -> DataFrame:
    """ids, vectors and, with a coder, codes: the rows (id, vector) in chunks of at most `most`, each value the chunk's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), most):
                part = batch.slice(a, most)
                vectors = matrix(part.column(1), len(part.column(1)[0]))
                values = [part.column(0).to_numpy().tobytes(), vectors.astype(kind).tobytes()]
                if coder is not None:
                    values.append(pack_codes(coder.value.encode(vectors)).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], ["ids", "vectors", "codes"][: len(values)])

    return rows.mapInArrow(run, "ids binary, vectors binary" + (", codes binary" if coder is not None else ""))


def nearest(
    spark: SparkSession, vectors: DataFrame, *, k: int = 20, query_every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    fit_rows: int = 16_384, query_block: int = 1024, scan_rows: int = 16_384, rerank: int = 256, threshold: float = 0.2, chunk_bytes: int = 8_000_000,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k nearest found: largest inner product, ties to smaller ids.

    Queries are the rows whose id is divisible by `query_every`, candidates all rows of another id; fewer than k
    candidates give as many rows. Rows whose vector is null, zero, of another length than most, or holds a null or
    non-finite component take no part, nor do rows without an id. A repeated candidate row is as many candidates; of a
    repeated query id the smallest vector asks. No queries or an empty table: an empty result. Other columns aren't read.
    """
    rows, dim = valid_vectors(vectors, id_col, vector_col)
    work = Workspace(spark, "nearest")
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    total = rows.count()
    share = min(1.0, fit_rows / total)
    sample = rows.filter(F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1_000_000)) < F.lit(share * 1_000_000)).select("vector").toArrow()
    sample = sample if len(sample) else rows.limit(1).select("vector").toArrow()
    coder = spark.sparkContext.broadcast(Quantiser.fit(matrix(sample["vector"].combine_chunks(), dim), threshold))

    kind = "<f4" if isinstance(rows.schema["vector"].dataType.elementType, FloatType) else "<f8"
    most = max(1, chunk_bytes // (8 * dim))
    index = work.write(packed(rows, min(scan_rows, most), kind, coder), "index")
    asked = rows.filter(F.col("id") % query_every == 0).groupBy("id").agg(F.min("vector").alias("vector"))
    asked = work.write(packed(asked, min(query_block, most), kind).toDF("query_ids", "queries"), "queries")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)]  # query, id, score
        for batch in batches:
            for ids, vectors, codes, query_ids, queries in zip(*(batch.column(c) for c in range(5)), strict=True):
                ids, query_ids = (np.frombuffer(x.as_buffer(), dtype=np.int64) for x in (ids, query_ids))
                vectors, queries = (np.frombuffer(x.as_buffer(), dtype=kind).astype(np.float64).reshape(-1, dim) for x in (vectors, queries))
                codes = np.frombuffer(codes.as_buffer(), dtype=np.uint8).reshape(len(ids), -1)
                for b in range(0, len(query_ids), 128):
                    query, vec, score = _best(ids, vectors, codes, query_ids[b : b + 128], queries[b : b + 128], coder.value, k, rerank)
                    held = [np.concatenate(pair) for pair in zip(held, (query_ids[query + b], vec, score), strict=True)]
                held = _top(*held, k)
                if len(held[0]) > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["query_id", "vec_id", "score"])
                    held = [x[:0] for x in held]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["query_id", "vec_id", "score"])

    found = index.crossJoin(asked).mapInArrow(scan, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(ids, vectors, codes, query_ids, queries, coder, k, rerank):
    """(query, id, score) of the best k of these rows for each query; rows that tie at the cut are all reranked."""
    tables = coder.tables(queries)
    near = np.concatenate([_summed(tables, codes[a : a + 2048]) for a in range(0, len(codes), 2048)])
    near[ids[:, None] == query_ids[None, :]] = -np.inf
    cut = np.partition(near, len(near) - rerank, axis=0)[len(near) - rerank] if len(near) > rerank else np.full(len(queries), -np.inf)
    row, query = np.nonzero((near >= cut) & np.isfinite(near))
    score = np.concatenate([np.einsum("ij,ij->i", vectors[row[a : a + 65536]], queries[query[a : a + 65536]]) for a in range(0, len(row), 65536)] or [np.zeros(0)])
    return _top(query, ids[row], score, k)


def _summed(tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
    total = tables[0][codes[:, 0]]
    for s in range(1, len(tables)):
        total += tables[s][codes[:, s]]
    return total


def _top(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> list[np.ndarray]:
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    begins = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(query)) - np.repeat(begins, np.diff(np.concatenate([begins, [len(query)]])))
    return [query[rank < k], ids[rank < k], score[rank < k]]
