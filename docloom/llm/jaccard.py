"""Jaccard self-join of documents' word shingles with count-vector R-trees.

A document's shingles are hashed into groups; the counts per group are a point. For two documents the sum of the
coordinates' minima bounds their overlap from above, and for a document and a box of points so does the sum with the
box's upper corner. An R-tree over the points is searched with every point, branches whose bound is below the overlap
that the threshold asks for are cut, and the pairs that survive are verified on the shingles themselves.

One tree can't hold a corpus, so points are first dealt to trees, without losing a pair. Linked documents of sizes up to
U differ in at most D = 2 * U * (100 - t) / (100 + t) shingles. With more than D groups some have the same content in both.
So a document names its groups' contents (`keys`), and only documents that share a key can be linked. Sizes are cut into
levels, each with its own number of groups; a document near a level's upper end names groups of the next level too.

Documents with equal sets are one class from the start and only its smallest doc_id goes on. The smallest holder of a key
is its leader, and a document's first leader is the smallest of its keys' leaders. Trees are built in two steps:

1. Each document goes to the tree of its first leader, once. A leader with too many documents for one task has several
   trees, each with the leader in it. Most families are done with that: all holders of their keys met in one tree.
2. What is left are keys whose holders didn't all meet, and aren't in one component by what was found. Where a leader's are
   more than a block takes, they are keyed anew, by the rarest of their own shingles (`rare_stars`), which near copies that
   just don't link seldom share. For each leader of such keys, the holders outside the most frequent component meet all
   holders, in blocks of bounded size. Components known so far aren't verified again. No step follows candidates of candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.graph import components
from docloom.llm.shared import Workspace
from docloom.llm.words import BETWEEN_BLANKS, mix, shingle_sets, text_chunks, words_of

WIDTH, PERCENT = 4, 85
LEAF = 32


class Levels:
    """Sizes up to top[k] (and above top[k - 1]) are level k, with groups[k] groups of which at most apart[k] may differ.

    The levels go on as far as a set of the size `largest` may link, whatever the sizes of the sets beside it.
    """

    def __init__(self, percent: int, largest: int, ratio: float = 1.25):
        self.percent = percent
        self.top = [1]
        while percent * (self.top[-1] + 1) <= 100 * largest:
            self.top.append(max(self.top[-1] + 1, int(self.top[-1] * ratio)))
        self.apart = [2 * top * (100 - percent) // (100 + percent) for top in self.top]
        self.groups = [d + 2 + d // 4 for d in self.apart]

    def of(self, sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each level and which of the sets take part in it."""
        own = np.searchsorted(self.top, sizes)
        for k in range(len(self.top)):
            below = self.top[k - 1] if k else 0
            # Up to `below` + 1 documents of the level may link with smaller ones at the end of the level before.
            takes = (own == k) | ((sizes <= below) & (100 * sizes >= self.percent * (below + 1)))
            if self.apart[k] and (takes := np.flatnonzero(takes & (sizes > 0))).size:
                yield k, takes


def group_keys(hashes: np.ndarray, first: np.ndarray, percent: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set, key) of every group content that a set names, ordered by set.

    With g groups of which d may differ, linked sets agree in at least g - d. A set leaves out its groups of least score,
    as many whole scores as come to fewer than g - d groups; a score depends on the content alone, so some group that two
    linked sets agree in is left out by neither. The score is the number of shingles outside `common`: groups without
    shingles, or with nothing but widespread ones, would make candidates of documents that share a stock phrase.
    """
    sizes = np.diff(first)
    levels = Levels(percent, int(sizes.max(initial=1)))
    content = mix(hashes + np.uint64(0x632BE59BD9B4E019))
    rare = np.ones(len(hashes), dtype=np.int64)
    if len(common):
        rare -= common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] == hashes
    owners, keys = [], []
    for k, takes in levels.of(sizes):
        m, spare = levels.groups[k], levels.groups[k] - levels.apart[k]
        owner = np.repeat(np.arange(len(takes)), sizes[takes])
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes[takes]) - sizes[takes], sizes[takes]) + first[takes][owner]
        cell = owner * m + ((hashes[at] >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        begins = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        score, sums = np.zeros(len(takes) * m, dtype=np.int64), np.zeros(len(takes) * m, dtype=np.uint64)
        score[cell[begins]] = np.minimum(np.add.reduceat(rare[at], begins), 15)
        sums[cell[begins]] = np.add.reduceat(content[at], begins)
        by_score = np.bincount(np.repeat(np.arange(len(takes)), m) * 16 + score, minlength=16 * len(takes)).reshape(-1, 16)
        least = (np.cumsum(by_score, axis=1) < spare).sum(axis=1)  # the lowest score that isn't left out
        named = np.flatnonzero(score >= np.repeat(least, m))
        owners.append(takes[named // m])
        keys.append(mix(sums[named] ^ mix((named % m + (k << 40)).astype(np.uint64))))
    if not owners:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    owner, key = np.concatenate(owners), np.concatenate(keys)
    order = np.argsort(owner, kind="stable")
    return owner[order], key[order]


def common_shingles(documents: DataFrame, width: int, sample_docs: int, least: int) -> np.ndarray:
    """Sorted hashes of the shingles in at least `least` of about `sample_docs` documents.

    They only order a set's groups, so which ones are found changes the work, never the result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, _ = shingle_sets(words_of([t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()], BETWEEN_BLANKS), width)
            found, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], ["shingle", "n"])

    share = min(1.0, sample_docs / max(1, documents.count()))
    # By id and text, so that rows without an id, or all with the same one, are sampled too.
    sample = documents.filter(F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(1_000_000)) < F.lit(share * 1_000_000)).select("text")
    counted = sample.distinct().mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return np.sort(counted.select("shingle").toArrow()["shingle"].to_numpy().astype(np.int64).view(np.uint64))


def set_table(documents: DataFrame, width: int, percent: int, common) -> DataFrame:
    """doc_id, n, a, b (a 128-bit hash of the set) and keys (only at a set's first document in each partition)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for p, q in text_chunks(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()):
                rows = batch.slice(p, q - p)
                hashes, first = shingle_sets(words_of([t or b"" for t in rows.column(1).cast(pa.binary()).to_pylist()], BETWEEN_BLANKS), width)
                a, b = set_hashes(hashes, first)
                new = np.zeros(len(rows), dtype=bool)
                for i, pair in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
                    new[i] = pair not in seen and rows.column(0)[i].is_valid
                    if new[i]:
                        seen.add(pair)
                which = np.flatnonzero(new)
                part = np.concatenate([hashes[first[i] : first[i + 1]] for i in which] or [hashes[:0]])
                starts = np.concatenate([[0], np.cumsum(np.diff(first)[which])])
                owner, key = group_keys(part, starts, percent, common.value)
                counts = np.zeros(len(rows), dtype=np.int64)
                counts[which] = np.bincount(owner, minlength=len(which))
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(key.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(first), pa.int64()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), lists, pa.array(new)],
                    ["doc_id", "n", "a", "b", "keys", "new"],
                )

    return documents.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, n long, a long, b long, keys array<long>, new boolean")


def set_hashes(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for salt in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93):
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt)))])
        out.append(mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64)))
    return out[0], out[1]


def leader_stars(work: Workspace, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """key, u, v: for each key that several classes hold, its leader u and every holder v (u itself too); written.

    Holders are counted before anything moves, so a key that many hold is no group of one task; only rows of keys with
    several holders go on, found by a bitmap of fixed size, then by a join that Spark can split.
    """
    held = sets.filter("new").select(F.explode("keys").alias("key"), F.col("doc_id").alias("doc"))
    shared = work.write(held.groupBy("key").count().filter("count > 1").select("key"), "keys")
    several = probably_in(held, shared, "key").join(shared, "key")  # inner: a semi join would be moved below the bitmap
    named = sets.filter("new").select("doc_id", "a", "b").join(classes.select("a", "b", "rep"), ["a", "b"]).select(F.col("doc_id").alias("doc"), F.col("rep").alias("v"))
    held = work.write(several.join(named, "doc").select("key", "v").distinct(), "held")
    leaders = held.groupBy("key").agg(F.min("v").alias("u"), F.max("v").alias("last")).filter("u < last").select("key", "u")
    return work.write(held.join(leaders, "key").select("key", "u", "v"), "stars")


class RTree:
    """Points packed into leaves by splitting at the median of the coordinate that spreads most; boxes keep their upper corner."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        parts, self.children, leaves = [np.arange(len(points))], [], []
        boxes, least = [], []
        while parts:  # breadth first; children of a node stand together
            following = []
            for part in parts:
                boxes.append(points[part].max(axis=0))
                least.append(sizes[part].min())
                if len(part) <= LEAF:
                    self.children.append(None)
                    leaves.append((len(boxes) - 1, part))
                    continue
                axis = int(np.argmax(points[part].max(axis=0).astype(np.int64) - points[part].min(axis=0)))
                order = part[np.argsort(points[part, axis], kind="stable")]
                cuts = [order[len(order) * i // 4 : len(order) * (i + 1) // 4] for i in range(4)]
                self.children.append([len(following) + i for i in range(4)])
                following += cuts
            base = len(boxes)
            self.children[base - len(parts) :] = [c and [base + i for i in c] for c in self.children[base - len(parts) :]]
            parts = following
        self.boxes, self.least, self.leaves = np.array(boxes), np.array(least), dict(leaves)

    def candidates(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j), i < j, whose summed coordinate minima reach the overlap the threshold asks for."""
        frontier = [(0, np.arange(len(self.points)))]
        while frontier:
            node, queries = frontier.pop()
            queries = queries[self._bound(queries, self.boxes[node], self.least[node], percent)]
            if not len(queries):
                continue
            if self.children[node] is not None:
                frontier += [(c, queries) for c in self.children[node]]
                continue
            for j in self.leaves[node]:
                i = queries[queries < j]
                i = i[self._bound(i, self.points[j], self.sizes[j], percent)]
                yield i, np.full(len(i), j)

    def _bound(self, queries: np.ndarray, corner: np.ndarray, size: int, percent: int) -> np.ndarray:
        overlap = np.minimum(self.points[queries], corner).sum(axis=1, dtype=np.int64)
        # overlap / union >= p / 100 with union = sizes - overlap
        return (100 + percent) * overlap >= percent * (self.sizes[queries] + size)


def join_group(hashes: np.ndarray, first: np.ndarray, known: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (i, j) between the sets of a group that join components not joined before; `known` labels such components."""
    n, sizes = len(first) - 1, np.diff(first)
    if n < 2 or not len(hashes):
        return []
    bits = min(8, max(4, int(np.median(sizes) / 8).bit_length()))
    owner = np.repeat(np.arange(n), sizes)
    cell = owner * (1 << bits) + (hashes & np.uint64((1 << bits) - 1)).astype(np.int64)
    points = np.bincount(cell, minlength=n << bits).reshape(n, 1 << bits).astype(np.int32)
    _, ids = np.unique(hashes, return_inverse=True)
    marked = np.zeros(int(ids.max()) + 1, dtype=bool)
    label = np.unique(known, return_inverse=True)[1]
    pairs = list(RTree(points, sizes).candidates(percent))
    i, j = np.concatenate([p[0] for p in pairs] or [[]]).astype(np.int64), np.concatenate([p[1] for p in pairs] or [[]]).astype(np.int64)
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    bounds = np.searchsorted(i, np.arange(n + 1))
    links = []
    for q in np.flatnonzero(np.diff(bounds)):
        others = j[bounds[q] : bounds[q + 1]]
        others = others[label[others] != label[q]]
        if not len(others):
            continue
        marked[ids[first[q] : first[q + 1]]] = True
        at = np.concatenate([ids[first[o] : first[o + 1]] for o in others])
        overlap = np.add.reduceat(marked[at].astype(np.int64), np.concatenate([[0], np.cumsum(sizes[others])[:-1]]))
        marked[ids[first[q] : first[q + 1]]] = False
        for o in others[100 * overlap >= percent * (sizes[q] + sizes[others] - overlap)]:
            if label[o] != label[q]:
                label[label == label[o]] = label[q]
                links.append((int(q), int(o)))
    return links


def tree_links(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """u, v from rows (group, doc_id, a, b, known, text): each group's links between components not known as one.

    Rows whose text hasn't the set (a, b), as repeated doc_ids may have, are passed over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            for p, q in text_chunks(pc.binary_length(batch.column(5)).to_pylist()):
                rows = batch.slice(p, q - p)
                hashes, first = shingle_sets(words_of(rows.column(5).cast(pa.binary()).to_pylist(), BETWEEN_BLANKS), width)
                a, b = set_hashes(hashes, first)
                own = (a.view(np.int64) == rows.column(2).to_numpy()) & (b.view(np.int64) == rows.column(3).to_numpy())
                groups, docs, known = (rows.column(k).to_numpy() for k in (0, 1, 4))
                for i in np.flatnonzero(own).tolist():
                    if groups[i] != group:
                        yield from linked(held)
                        group, held = groups[i], []
                    held.append((docs[i], known[i], hashes[first[i] : first[i + 1]].copy()))
        yield from linked(held)

    def linked(held: list) -> Iterator[pa.RecordBatch]:
        if len(held) < 2:
            return
        docs = np.array([x[0] for x in held], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum([len(x[2]) for x in held])])
        links = join_group(np.concatenate([x[2] for x in held]), first, np.array([x[1] for x in held]), percent)
        if links:
            pairs = docs[np.array(links)]
            yield pa.RecordBatch.from_arrays([pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], ["u", "v"])

    dealt = rows.select("group", "doc_id", "a", "b", "known", "text").repartition("group").sortWithinPartitions("group", "doc_id")
    return dealt.mapInArrow(run, "u long, v long")


def shingle_rows(rows: DataFrame, width: int) -> DataFrame:
    """a, b, doc_id, known, n, shingle from rows (doc_id, a, b, known, text): each shingle of a set (a, b) once.

    Rows whose text hasn't the set are passed over, as are further texts with it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for p, q in text_chunks(pc.binary_length(batch.column(4)).to_pylist()):
                rows = batch.slice(p, q - p)
                hashes, first = shingle_sets(words_of(rows.column(4).cast(pa.binary()).to_pylist(), BETWEEN_BLANKS), width)
                sets = [x.view(np.int64) for x in set_hashes(hashes, first)]
                own = (sets[0] == rows.column(1).to_numpy()) & (sets[1] == rows.column(2).to_numpy())
                for i in np.flatnonzero(own).tolist():
                    own[i], last = (sets[0][i], sets[1][i]) != last, (sets[0][i], sets[1][i])
                sizes = np.diff(first)
                named = [np.repeat(x[own], sizes[own]) for x in (*sets, rows.column(0).to_numpy(), rows.column(3).to_numpy(), sizes)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*named, hashes[np.repeat(own, sizes)].view(np.int64))], ["a", "b", "doc_id", "known", "n", "shingle"])

    dealt = rows.select("doc_id", "a", "b", "known", "text").repartition("a", "b").sortWithinPartitions("a", "b")
    return dealt.mapInArrow(run, "a long, b long, doc_id long, known long, n long, shingle long")


def rare_stars(work: Workspace, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """u, v, label from rows (doc_id, a, b, known, text): the holders v, of components `label`, of the keys with leader u.

    Keys are shingles. All shingles are put in one order: those of a single component first, then from rare to frequent.
    Sets of n and m >= n shingles that link have 2 * n * t / (100 + t) in common at least, and m * t / 100. So the first one they
    share stands so early in both that this many still follow, itself included. A shingle is a key if it stands so early in a
    set as in the smaller of two, and in sets of another component as in the larger. One of a single component links no two.
    """
    each = work.write(shingle_rows(rows, width), "shingles")
    spread = each.groupBy("shingle").agg(F.count("*").alias("sets"), F.min("known").alias("k0"), F.max("known").alias("k1")).filter("k0 < k1")
    of_set = Window.partitionBy("a", "b")
    alone = F.col("n") - F.count("*").over(of_set)
    placed = each.join(spread.select("shingle", "sets"), "shingle").withColumn("place", alone + F.row_number().over(of_set.orderBy("sets", "shingle")))
    upto = lambda share, whole: F.expr(f"n - ({share} * n + {whole - 1}) div {whole} + 1")
    early = placed.filter(F.col("place") <= upto(percent, 100)).select("shingle", "doc_id", "known", (F.col("place") <= upto(2 * percent, 100 + percent)).alias("smaller"))
    early = work.write(early, "early")
    keys = early.groupBy("shingle").agg(F.min("doc_id").alias("u"), F.min("known").alias("k0"), F.max("known").alias("k1"), F.max("smaller").alias("smaller"))
    keys = keys.filter("k0 < k1 and smaller").select("shingle", "u")
    return early.join(keys, "shingle").select("u", F.col("doc_id").alias("v"), F.col("known").alias("label")).distinct()


def jaccard_components(
    spark: SparkSession, documents: DataFrame, *, width: int = WIDTH, percent: int = PERCENT, group_rows: int = 256, group_shingles: int = 2_000_000,
    sample_docs: int = 4000,
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `documents` (doc_id, text).

    Two documents link when 100 * overlap >= percent * union of their distinct shingles; component_id is the smallest
    doc_id reachable. Null, empty and blank texts have no shingles and are components of their own; rows without a
    doc_id get their count and a null component. Rows that repeat a doc_id are one node, linked by each of their texts.
    An empty table gives an empty result. Other columns are not read.
    """
    work = Workspace(spark, "jaccard")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    common = spark.sparkContext.broadcast(common_shingles(docs, width, sample_docs, least=4))  # of a bounded sample
    sets = work.write(set_table(docs, width, percent, common), "sets")
    classes = work.write(sets.filter("n > 0 and doc_id is not null").groupBy("a", "b").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n")), "classes")

    stars = leader_stars(work, sets, classes)
    firsts = work.write(stars.filter("u <> v").groupBy("v").agg(F.min("u").alias("leader")), "firsts")
    members = firsts.unionByName(firsts.select(F.col("leader").alias("v"), "leader").distinct())
    members = members.join(classes.select(F.col("rep").alias("v"), "a", "b", "n"), "v")
    sizes = members.groupBy("leader").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles"))
    sizes = work.write(sizes.select("leader", F.ceil(F.greatest(F.col("docs") / group_rows, F.col("shingles") / group_shingles)).cast("int").alias("chunks")), "sizes")
    own = F.array(F.pmod(F.xxhash64("v"), F.col("chunks")).cast("int"))
    every = F.when(F.col("v") == F.col("leader"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(own)
    placed = members.join(sizes, "leader").withColumn("chunk", F.explode(every))
    placed = work.write(placed.select(F.xxhash64("leader", "chunk").alias("group"), F.col("v").alias("doc_id"), "a", "b", F.col("v").alias("known")), "placed")
    links = work.write(tree_links(_texts(docs, placed), width, percent), "links")
    labels = components(work, links, "found")

    left = work.write(_unmet(stars, firsts, sizes, labels), "unmet")
    if not left.isEmpty():
        named = classes.select(F.col("rep").alias("doc_id"), "a", "b")
        # Holders that one block takes meet there; only of larger stars the shingles are worth a shuffle.
        large = work.write(left.groupBy("u").count().filter(F.col("count") > group_rows).select("u"), "large")
        if not large.isEmpty():
            again = left.join(large, "u", "left_semi").select(F.col("v").alias("doc_id"), F.col("label").alias("known")).distinct()
            again = work.write(again.join(named, "doc_id"), "again")
            rare = rare_stars(work, _texts(docs, again), width, percent)
            left = work.write(left.join(large, "u", "left_anti").unionByName(rare).distinct(), "rare")
            work.drop("again", "shingles", "early")
        blocks = work.write(_blocks(left, group_rows).join(named, "doc_id"), "blocks")
        links = links.unionByName(work.write(tree_links(_texts(docs, blocks), width, percent), "more-links"))
        labels = components(work, links, "all")
    work.drop("keys", "held", "stars", "firsts", "sizes", "placed", "unmet", "large", "rare", "blocks")

    named = _with_label(classes.select("a", "b", F.col("rep").alias("doc_id")), labels).select("a", "b", F.col("doc_id").alias("rep"), "label")
    out = sets.drop("keys", "new").join(named, ["a", "b"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("label"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _texts(documents: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.join(probably_in(documents, rows, "doc_id"), "doc_id").filter(F.col("text").isNotNull())


def _unmet(stars: DataFrame, firsts: DataFrame, sizes: DataFrame, labels: DataFrame) -> DataFrame:
    """u, v, label: the holders, by leader, of the keys of several components whose holders weren't all in one tree."""
    known = stars.join(firsts, "v", "left").join(labels.select(F.col("node").alias("v"), "label"), "v", "left").withColumn("label", F.coalesce("label", "v"))
    others, own = F.when(F.col("u") != F.col("v"), F.col("leader")), F.when(F.col("u") == F.col("v"), F.col("leader"))
    ends = [f(x).alias(n) for x, names in ((F.col("label"), ("l0", "l1")), (others, ("p0", "p1"))) for f, n in zip((F.min, F.max), names, strict=True)]
    keys = known.groupBy("key", "u").agg(*ends, F.max(own).alias("p")).filter("l0 < l1")
    # All holders were in the trees of one leader, the key's own one too: as that leader, or as one of its documents.
    met = (F.col("p0") == F.col("p1")) & ((F.col("u") == F.col("p0")) | (F.coalesce("p", F.lit(-1)) == F.col("p0")))
    keys = keys.withColumn("tree", F.when(met, F.col("p0"))).join(sizes.select(F.col("leader").alias("tree"), "chunks"), "tree", "left").filter("tree IS NULL OR chunks > 1")
    return known.select("key", "u", "v", "label").join(keys.select("key"), "key", "left_semi").select("u", "v", "label").distinct()


def _blocks(left: DataFrame, group_rows: int) -> DataFrame:
    """group, doc_id, known: of each leader's documents those outside the main component meet all, block by block.

    A document names one row or column of the grid of (outside) blocks and (all documents') chunks, an outside one both.
    """
    counted = left.groupBy("u", "label").agg(F.count("*").alias("docs"))
    main = counted.groupBy("u").agg(F.max(F.struct("docs", "label"))["label"].alias("main"), F.sum("docs").alias("all"), (F.sum("docs") - F.max("docs")).alias("outside"))
    main = main.select("u", "main", F.ceil(F.col("outside") / group_rows).cast("int").alias("blocks"), F.ceil(F.col("all") / group_rows).cast("int").alias("chunks"))
    cells = left.join(main, "u").withColumns(
        {"chunk": F.pmod(F.xxhash64("v"), F.col("chunks")).cast("int"), "block": F.pmod(F.xxhash64("v", F.lit("block")), F.col("blocks")).cast("int"), "outside": F.col("label") != F.col("main")}
    )
    column = cells.select("u", "v", "label", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("r"), F.col("chunk").alias("c"))
    row = cells.filter("outside").withColumn("c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).filter("c <> chunk").select("u", "v", "label", F.col("block").alias("r"), "c")
    both = column.unionByName(row)
    return both.select(F.xxhash64("u", "r", "c", F.lit("outside")).alias("group"), F.col("v").alias("doc_id"), F.col("label").alias("known"))


def probably_in(rows: DataFrame, wanted: DataFrame, column: str, bits: int = 1 << 24) -> DataFrame:
    """The rows whose `column` is among `wanted`'s, and few others: a bitmap of fixed size is broadcast, at most bits / 64 rows."""
    slot = F.pmod(F.xxhash64(column), F.lit(bits))
    words = wanted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("_set"))
    hashed = rows.withColumn("_slot", slot).withColumn("_word", F.shiftright("_slot", 6))
    kept = hashed.join(F.broadcast(words), "_word").filter(F.expr("_set & shiftleft(1L, cast(_slot & 63 as int)) <> 0"))
    return kept.select(*rows.columns)


def _with_label(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """label: the document's component, itself where it has no link."""
    return rows.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
