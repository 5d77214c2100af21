"""How five document filters interact: what each removes, repeats or alone finds, in every order of applying them.

Four conditions follow from a document's text alone; the fifth (an identical text at a smaller doc_id) needs all
documents. Texts are routed by their xxhash: every partition first drops its own copies, then one row per text and
partition goes to the partition of its fingerprint, where rows come sorted by it. The rows of one fingerprint form a
chain of full texts with the smallest doc_id of each, so a collision never joins two texts, and a group of copies costs
one row per partition, however large it is. A document's failures are a mask of five bits; 32 counts per part (each with its good and
toxic ones) are all that the 120 orders need.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import groupby, permutations

import numpy as np
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
UPPER = bytes(range(0x41, 0x5B))
MARKS = re.compile(rb"[#$%&*|]")
#: Bytes of text that a task holds while it drops its own copies, and that one partition of the routed texts gets at most on average.
HELD_BYTES, ROUTED_BYTES = 24_000_000, 64_000_000

MASKS = "doc_id long, part string, mask int, n long"
AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def own_mask(text: bytes, n_chars: int, least_words: int = 200, least_distinct: int = 50, most_upper: int = 3) -> int:
    """Bits of A to D: few words, few distinct ones in percent, many capitals in percent, a mark."""
    words = text.split()  # bytes: at [\x20\x09-\x0D] alone
    few = len(words) < least_words
    poor = 100 * len(set(words)) < least_distinct * len(words)
    loud = 100 * (len(text) - len(text.translate(None, UPPER))) > most_upper * n_chars
    return few | poor << 1 | loud << 2 | bool(MARKS.search(text)) << 3


class Chains:
    """Texts by fingerprint, each with its smallest doc_id, that document's rows by part, and the mask of A to D.

    add() gives the rows that a smaller doc_id has overtaken: they are copies, whatever else is found later.
    """

    def __init__(self) -> None:
        self.chains: dict[int, list[list]] = {}
        self.held = 0

    def add(self, key: int, text: bytes, doc_id: int, rows: dict[str, int], mask: int) -> Iterator[tuple]:
        chain = self.chains.setdefault(key, [])
        link = next((x for x in chain if x[0] == text), None)
        if link is None:
            chain.append([text, doc_id, dict(rows), mask])
            self.held += len(text) + 500
        elif doc_id == link[1]:
            for part, n in rows.items():
                link[2][part] = link[2].get(part, 0) + n
        elif doc_id > link[1]:
            yield from copies(doc_id, rows, mask)
        else:
            yield from copies(link[1], link[2], mask)
            link[1:3] = doc_id, dict(rows)

    def links(self) -> Iterator[tuple[int, list]]:
        return ((key, link) for key, chain in self.chains.items() for link in chain)


def copies(doc_id: int, rows: dict[str, int], mask: int) -> Iterator[tuple]:
    return ((doc_id, part, mask | COPY, n) for part, n in rows.items())


def _settled(row: tuple) -> tuple:
    """A row of MASKS as a message; it only passes through, so it goes to any partition."""
    return xxhash.xxh3_64_intdigest(repr(row[0])), row


def route(documents: Iterable[tuple[int | None, str | None, str | None]], held_bytes: int = HELD_BYTES) -> Iterator[tuple[int, tuple]]:
    """Messages (fingerprint, link or settled row) of one partition's (doc_id, lang, text) rows."""
    found = Chains()
    for doc_id, lang, text in documents:
        body = (text or "").encode("utf-8", "surrogatepass")
        mask, part = own_mask(body, len(text or "")), lang or ""
        if doc_id is None:
            yield _settled((None, part, mask, 1))
            continue
        yield from map(_settled, found.add(xxhash.xxh3_64_intdigest(body), body, doc_id, {part: 1}, mask))
        if found.held > held_bytes:
            yield from ((key, tuple(link)) for key, link in found.links())
            found = Chains()
    yield from ((key, tuple(link)) for key, link in found.links())


def settle(messages: Iterable[tuple[int, tuple]]) -> Iterator[tuple]:
    """Rows of MASKS from one partition's messages, sorted by fingerprint: a chain lives as long as its fingerprint."""
    for key, group in groupby(messages, lambda m: m[0]):
        chains = Chains()
        for _, value in group:
            if isinstance(value[0], bytes):
                yield from chains.add(key, *value)
            else:
                yield value
        for _, (_, doc_id, rows, mask) in chains.links():
            yield from ((doc_id, part, mask, n) for part, n in rows.items())


def document_masks(documents: DataFrame) -> DataFrame:
    """doc_id, part, mask (bit i: the i-th of FILTERS fails), n: rows of a document in a part, repeated ones counted.

    A null text is empty, a null lang the empty part. A row without a doc_id is no copy and makes none; rows that
    repeat a doc_id and text are no copies of each other. Other columns are not read.
    """
    session = documents.sparkSession
    rows: RDD = documents.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text")).rdd
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(session.conf.get("spark.sql.shuffle.partitions")), size // ROUTED_BYTES + 1)
    routed = rows.mapPartitions(route).repartitionAndSortWithinPartitions(n, lambda key: key % n)
    return session.createDataFrame(routed.mapPartitions(settle), MASKS, verifySchema=False)


def mask_counts(masks: DataFrame, labels: DataFrame) -> RDD:
    """(part, counts[32 masks][all, quality 1, toxic 1]); a document of several labels counts as one if any says so."""
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    flagged = masks.join(said, "doc_id", "left").select("part", "mask", "n", F.coalesce("good", F.lit(False)), F.coalesce("toxic", F.lit(False)))

    def add(counts: np.ndarray, row: tuple) -> np.ndarray:
        mask, n, good, toxic = row
        counts[mask] += (n, n * good, n * toxic)
        return counts

    pairs = flagged.rdd.map(lambda r: (r[0], tuple(r[1:])))
    return pairs.combineByKey(lambda row: add(np.zeros((1 << len(FILTERS), 3), dtype=np.int64), row), add, lambda a, b: a + b)


def interactions(counts: np.ndarray) -> Iterator[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders."""
    masks = np.arange(len(counts))
    total, found = counts[:, 0].sum(), []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, i in enumerate(order, 1):
            fails, gone = masks >> i & 1 == 1, masks & before != 0
            removed, before = counts[fails & ~gone].sum(axis=0), before | 1 << i
            kept = total - counts[masks & before != 0, 0].sum()
            found.append(("".join(FILTERS[k] for k in order), step, kept, removed[0], counts[fails & gone, 0].sum(), counts[1 << i, 0], *removed[1:]))
    shapley = dict.fromkeys(FILTERS, 0)
    for order, step, _, removed, *_ in found:
        shapley[order[step - 1]] += removed
    for order, step, *figures in found:
        yield order, step, *map(int, (*figures, shapley[order[step - 1]]))


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (a value of lang), order of the five filters and step, as AUDIT says; all counts are documents of the part.

    kept: left after the step; removed: by it; redundant: failing its filter but gone before; unique_fails: failing it
    alone; good_lost, toxic_lost: removed ones labelled so; shapley: removed by this filter over all orders. An empty
    table gives no rows.
    """
    session: SparkSession = documents.sparkSession
    counted = mask_counts(document_masks(documents), labels)
    return session.createDataFrame(counted.flatMap(lambda x: ((x[0], *row) for row in interactions(x[1]))), AUDIT, verifySchema=False)
