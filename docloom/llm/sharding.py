"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their stratum (source); a row's fractional rank is
(2 * rank - 1) / (2 * stratum size). Sorting all rows by fractional rank interleaves the strata in proportion, so any
contiguous cut of that order holds the corpus mixture: of a stratum with share f, among s strata, a shard has its share
to within about 1 + s * f rows.

Neither ranking puts a stratum, or all rows, into one task. Hashes and fractional ranks fall into equal buckets, of which
there are at most `most_buckets`; ranks are counted within a bucket, and each bucket starts where the ones before it end.
For the hashes these starts are running totals of at most `most_buckets` counts per stratum. For the fractional ranks
they follow from the stratum sizes alone, since a stratum's ranks are known to be 1 to its size; at most `most_buckets`
numbers are added up by the driver and broadcast.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

HASH_BITS = 60
MADE = ("shard", "slot")


def seeded_hash(key: Column, seed: int) -> Column:
    """60 bits of md5('seed:key'): the same order in every SQL engine that has md5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary")), 1, 15), 16, 10).cast("long")


def fraction_starts(sizes: DataFrame, bits: int) -> DataFrame:
    """_bucket, _first: how many rows of all strata together have a fractional rank below each bucket.

    `sizes` has one row (_stratum, _size) per stratum. Of r = 1 .. size those below bucket c of C are the ones with
    (2r - 1) * C < 2 * size * c. A stratum smaller than C names the buckets of its ranks, a larger one all C.
    """
    n = 1 << bits
    below = lambda c: F.expr(f"(2 * _size * ({c}) + {3 * n - 1}L) div {2 * n}L - 1")
    each = sizes.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.least("_size", F.lit(n)))))
    few = F.col("_size") < n
    bucket = F.when(few, F.expr(f"((2 * _k - 1) * {n}L) div (2 * _size)")).otherwise(F.col("_k") - 1)
    each = each.select(bucket.alias("_bucket"), F.when(few, F.lit(1)).otherwise(below("_k") - below("_k - 1")).alias("_n"))
    counted = sorted(each.groupBy("_bucket").agg(F.sum("_n").alias("_n")).collect())  # at most most_buckets rows
    starts = accumulate((r["_n"] for r in counted), initial=0)
    return sizes.sparkSession.createDataFrame([(r["_bucket"], at) for r, at in zip(counted, starts, strict=False)], "_bucket long, _first long")


def interleave(
    rows: DataFrame, n_shards: int, *, id_col: str = "doc_id", stratum_col: str = "source", seed: int = 17, bucket_rows: int = 1000, most_buckets: int = 1 << 16
) -> DataFrame:
    """All columns of `rows` plus shard int and slot long (gapless from 0 within the shard); columns of those names are replaced.

    Shard sizes differ by one row at most. A null stratum counts as the empty one, a null id as the empty id. Rows with
    one id are told apart by a hash of all columns (but maps); rows that this leaves alike are interchangeable. Any
    other column names may come. An empty table gives an empty result. About `bucket_rows` rows are sorted together, more
    once there are `most_buckets` (a power of two) buckets.
    """
    carried = [c for c in rows.columns if c not in MADE]
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit(""))
    sizes = rows.groupBy(stratum.alias("_stratum")).agg(F.count("*").alias("_size"))
    n_rows = sizes.agg(F.sum("_size")).first()[0] or 0
    bits = min(most_buckets.bit_length() - 1, max(0, (n_rows // bucket_rows).bit_length() - 1))
    starts = fraction_starts(sizes, bits)

    told_apart = [F.col(f.name) for f in rows.schema if not isinstance(f.dataType, MapType)]
    base = rows.select(
        F.struct(*carried).alias("_row"),
        stratum.alias("_stratum"),
        seeded_hash(F.coalesce(F.col(id_col).cast("string"), F.lit("")), seed).alias("_hash"),
        F.xxhash64(*told_apart).alias("_tie"),
    ).withColumn("_cell", F.shiftright("_hash", HASH_BITS - bits))
    by_stratum = Window.partitionBy("_stratum").orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = base.groupBy("_stratum", "_cell").agg(F.count("*").alias("_n"))  # at most most_buckets of a stratum
    cells = cells.select("_stratum", "_cell", (F.sum("_n").over(by_stratum) - F.col("_n")).alias("_start"), F.sum("_n").over(Window.partitionBy("_stratum")).alias("_size"))
    in_cell = Window.partitionBy("_stratum", "_cell").orderBy("_hash", "_tie")
    ranked = base.withColumn("_in", F.row_number().over(in_cell)).join(cells, ["_stratum", "_cell"])
    ranked = ranked.select("_row", "_stratum", "_size", (2 * (F.col("_start") + F.col("_in")) - 1).alias("_twice"))

    placed = ranked.withColumn("_bucket", F.expr(f"(_twice * {1 << bits}L) div (2 * _size)")).withColumn("_fraction", F.col("_twice") / (2.0 * F.col("_size")))
    in_bucket = Window.partitionBy("_bucket").orderBy("_fraction", "_stratum")
    placed = placed.withColumn("_in", F.row_number().over(in_bucket) - 1).join(F.broadcast(starts), "_bucket")
    n = max(1, n_rows)
    placed = placed.withColumn("_at", F.col("_first") + F.col("_in"))
    placed = placed.withColumn("_shard", F.expr(f"(_at * {n_shards}L) div {n}L"))
    slot = F.col("_at") - F.expr(f"(_shard * {n}L + {n_shards - 1}L) div {n_shards}L")
    return placed.select("_row.*", F.col("_shard").cast("int").alias("shard"), slot.alias("slot"))


def shard_documents(documents: DataFrame, n_shards: int = 40, seed: int = 17) -> DataFrame:
    """doc_id, size long, text_crc32 long, law, shard int, slot long, grown_shard int of every document.

    Law `rows`. Size is the text's UTF-8 bytes plus 16; a null text counts as empty (crc32 0). Only these numbers are
    shuffled, never the texts. Copies (equal texts) need no group of their own: each is a row like any other, so a
    group of copies, however large, spreads over all shards.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    slim = documents.select(
        F.col("doc_id"),
        F.col("source"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    out = interleave(slim, n_shards, seed=seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
