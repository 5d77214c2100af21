"""Benchmark decontamination with suffix arrays over the training words.

Documents are dealt with where they lie: each shard of whole documents (about `shard_bytes` of text) gets a suffix array
over its words, sorted by prefix doubling as deep as the longest test item. Every suffix of every test item is then
binary-searched in it, word by word and for all suffixes at once. Where at least a window's words agree, all places in
the found interval are matches; runs of them on one diagonal are joined into maximal verbatim matches. Nothing of the
documents is shuffled. A word stands as a 64-bit hash.

Who needs no places in the items asks for hits instead: equal windows of all items are one interval, so a phrase that stands r
times in a document and in m items costs r + m there, not r * m.

The test items go to the tasks in blocks of at most `block_words` words. Further blocks are further passes, whose input
is the written result of the pass before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.shared import Workspace
from docloom.llm.words import ALPHANUMERIC, Words, text_chunks, words_of

WINDOW = 10
MATCHES = {"matches": "array<struct<item_id: string, item_start: long, start: long, length: long>>"}
HITS = {"spans": "array<struct<start: long, length: long>>", "items": "array<string>"}
#: Pairs of texts and items that are looked at together.
TOGETHER = 4_000_000


class Items:
    """A block of test items: word hashes end to end; item k has words first[k] to first[k + 1]."""

    def __init__(self, names: list[str], hashes: list[np.ndarray], window: int):
        self.names = names
        self.first = np.concatenate([[0], np.cumsum([len(h) for h in hashes], dtype=np.int64)])
        self.hashes = np.concatenate([*hashes, np.zeros(0, dtype=np.uint64)])
        lengths = np.diff(self.first)
        self.longest = int(lengths.max(initial=0))
        at = np.arange(len(self.hashes))
        self.item = np.repeat(np.arange(len(names)), lengths)
        wide = np.minimum(window, lengths)[self.item]
        self.left = self.first[1:][self.item] - at
        keep = self.left >= wide
        self.suffix, self.window = at[keep], wide[keep]


class SuffixArray:
    """The word suffixes of some whole texts in sorted order, to a depth of at least `depth` words.

    Each text ends with a mark of its own, so no suffix runs on into the next text.
    """

    def __init__(self, words: Words, depth: int):
        n_texts = len(words.first) - 1
        self.vocabulary, ids = np.unique(words.hashes, return_inverse=True)
        text = np.repeat(np.arange(n_texts), np.diff(words.first))
        self.n = n = len(ids) + n_texts
        self.ids = np.empty(n, dtype=np.int64)
        self.ids[np.arange(len(ids)) + text] = ids + n_texts
        ends = words.first[1:] + np.arange(n_texts)
        self.ids[ends] = np.arange(n_texts)
        self.text_start = np.concatenate([[0], ends + 1])
        self.n_texts = n_texts
        self.order = self._sorted(depth)

    def _sorted(self, depth: int) -> np.ndarray:
        n, bits = self.n, max(1, int(len(self.vocabulary) + self.n_texts).bit_length())
        reach = max(1, 63 // bits)
        padded = np.concatenate([self.ids, np.zeros(reach, dtype=np.int64)])
        key = padded[:n].copy()
        for k in range(1, reach):
            key <<= bits
            key |= padded[k : n + k]
        order = np.argsort(key)
        rank, tied, order = self._regroup(order, key[order], np.arange(n), np.empty(n + 1, dtype=np.int64), order)
        rank[n] = -1
        while reach < depth and len(tied):
            # Only suffixes that still share their first `reach` words are sorted again, by what follows these.
            held = order[tied]
            key = (rank[held] << 32) + rank[np.minimum(held + reach, n)] + 1
            again = np.argsort(key)
            order[tied] = held[again]
            rank, tied, order = self._regroup(order[tied], key[again], tied, rank, order)
            reach *= 2
        return order

    @staticmethod
    def _regroup(held: np.ndarray, key: np.ndarray, places: np.ndarray, rank: np.ndarray, order: np.ndarray):
        """Ranks of the suffixes `held` at `places` (the place where their group begins), and which places are tied."""
        if not len(held):
            return rank, places, order
        begins = np.concatenate([[True], key[1:] != key[:-1]])
        rank[held] = np.maximum.accumulate(np.where(begins, places, 0))
        alone = begins & np.concatenate([begins[1:], [True]])
        return rank, places[~alone], order

    def search(self, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of items.suffix occur for at least their window, and their interval of this array."""
        place = np.searchsorted(self.vocabulary, items.hashes)
        place[place == len(self.vocabulary)] = 0
        known = self.vocabulary[place] == items.hashes if len(self.vocabulary) else np.zeros(len(place), dtype=bool)
        wanted = np.where(known, place + self.n_texts, -1)
        live = np.flatnonzero(wanted[items.suffix] >= 0)
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.ids, minlength=self.n_texts + len(self.vocabulary)))])
        first = wanted[items.suffix[live]]
        low, high = starts[first], starts[first + 1]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        depth = 1
        while len(live):
            done = items.window[live] <= depth
            found.append((live[done], low[done], high[done]))
            live, low, high = live[~done], low[~done], high[~done]
            word = wanted[items.suffix[live] + depth]
            low, high = self._bound(word, low, high, depth, 0), self._bound(word, low, high, depth, 1)
            keep = low < high
            live, low, high = live[keep], low[keep], high[keep]
            depth += 1
        parts = [np.concatenate([f[k] for f in found] or [np.zeros(0, dtype=np.int64)]) for k in range(3)]
        return parts[0], parts[1], parts[2]

    def _bound(self, word: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, after: int) -> np.ndarray:
        """The first place in [low, high) whose word at `depth` is not below `word` (after=1: is above it)."""
        low, high = low.copy(), high.copy()
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) >> 1
            here = self.ids[np.minimum(self.order[middle] + depth, self.n - 1)]
            less = here < word[open_] + after
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
        return low


def expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval its number and every place in it."""
    sizes = high - low
    owner = np.repeat(np.arange(len(low)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[owner]


def shard_matches(texts: list[bytes], items: Items) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words of each text; and the maximal matches (text, item, item_start, start, length), by text, item and start."""
    words = words_of(texts, ALPHANUMERIC)
    counts = np.diff(words.first)
    if not len(words.hashes) or not len(items.suffix):
        return counts, [np.zeros(0, dtype=np.int64)] * 5
    array = SuffixArray(words, items.longest)
    which, low, high = array.search(items)
    owner, place = expand(low, high)
    suffix, at = which[owner], array.order[place]
    word = items.suffix[suffix]
    item = items.item[word]
    order = np.lexsort((at, at - word, item))
    at, word, item, wide = at[order], word[order], item[order], items.window[suffix[order]]
    begins = np.ones(len(at), dtype=bool)
    begins[1:] = (item[1:] != item[:-1]) | (at[1:] != at[:-1] + 1) | (word[1:] != word[:-1] + 1)
    runs = np.flatnonzero(begins)
    ends = np.concatenate([runs[1:], [len(at)]])[: len(runs)] - 1
    text = np.searchsorted(array.text_start, at[runs], side="right") - 1
    out = [text, item[runs], word[runs] - items.first[item[runs]], at[runs] - array.text_start[text], ends - runs + wide[runs]]
    by = np.lexsort((out[3], out[1], out[0]))
    return counts, [x[by] for x in out]


def unique_pairs(first: np.ndarray, second: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, by first and second (below n)."""
    return np.divmod(np.unique(first * n + second), max(1, n))


def shard_hits(texts: list[bytes], items: Items, together: int = TOGETHER) -> tuple[np.ndarray, list[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Words of each text; the longest spans (text, start, length) of words in any occurrence of a window, by text and start; and
    each (text, item) once of which a window of the item occurs in the text."""
    words = words_of(texts, ALPHANUMERIC)
    counts = np.diff(words.first)
    none = np.zeros(0, dtype=np.int64)
    if not len(words.hashes) or not len(items.suffix):
        return counts, [none] * 3, (none, none)
    array = SuffixArray(words, items.longest)
    which, low, high = array.search(items)
    wide = items.window[which]
    _, one, of = np.unique(low * (items.longest + 1) + wide, return_index=True, return_inverse=True)  # where it begins and its width tell an interval
    low, high, wide = low[one], high[one], wide[one]
    ends = np.cumsum(high - low)
    change, within = np.zeros(array.n + 1, dtype=np.int64), [none]
    for part in np.split(np.arange(len(low)), np.searchsorted(ends, np.arange(together, ends[-1] if len(ends) else 0, together))):
        owner, place = expand(low[part], high[part])
        at = array.order[place]
        change += np.bincount(at, minlength=array.n + 1) - np.bincount(at + wide[part][owner], minlength=array.n + 1)
        within.append(np.unique(part[owner] * len(texts) + np.searchsorted(array.text_start, at, side="right") - 1))
    edges = np.flatnonzero(np.diff((np.cumsum(change) > 0).astype(np.int8), prepend=0, append=0))
    starts, stops = edges[::2], edges[1::2]
    text = np.searchsorted(array.text_start, starts, side="right") - 1
    spans = [text, starts - array.text_start[text], stops - starts]
    t_interval, t_text = np.divmod(np.unique(np.concatenate(within)), len(texts))
    i_interval, i_item = unique_pairs(of, items.item[items.suffix[which]], len(items.names))
    t_first, i_first = (np.searchsorted(x, np.arange(len(low) + 1)) for x in (t_interval, i_interval))
    n_items = np.diff(i_first)
    ends = np.cumsum(np.diff(t_first) * n_items)
    found = none
    for part in np.split(np.arange(len(low)), np.searchsorted(ends, np.arange(together, ends[-1] if len(ends) else 0, together))):
        sizes = np.diff(t_first)[part] * n_items[part]
        owner, k = expand(np.zeros(len(part), dtype=np.int64), sizes)
        own = part[owner]
        pairs = t_text[t_first[own] + k // n_items[own]] * len(items.names) + i_item[i_first[own] + k % n_items[own]]
        found = np.union1d(found, pairs)
    return counts, spans, np.divmod(found, max(1, len(items.names)))


def item_blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[Items]:
    """The items with words, in blocks of at most `block_words` words (a longer item is a block of its own)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = words_of([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()], ALPHANUMERIC)
            parts = [words.hashes[a:b].tobytes() for a, b in zip(words.first, words.first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.binary())], ["item_id", "words"])

    rows = benchmark.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string"), "text")
    names, hashes, held = [], [], 0
    for row in rows.mapInArrow(hashed, "item_id string, words binary").toLocalIterator():
        part = np.frombuffer(row["words"], dtype=np.uint64)
        if held and held + len(part) > block_words:
            yield Items(names, hashes, window)
            names, hashes, held = [], [], 0
        if len(part):
            names.append(row["item_id"])
            hashes.append(part)
            held += len(part)
    yield Items(names, hashes, window)


def find_matches(
    spark: SparkSession, documents: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, carry: list[str] | None = None,
    shard_bytes: int = 2_000_000, block_words: int = 2_000_000,
) -> DataFrame:
    """The carried columns (all, if not given) plus n_words long and matches, one row per row of `documents`.

    matches has every maximal verbatim run of at least `window` words (or of a whole shorter item) that the document
    shares with an item: item_id, first word in the item, first word in the document, words. Null and empty texts have
    no words; items without words or item_id match nothing; items of equal item_id count as one in the digest. Repeated
    rows are each matched. Columns named n_words or matches are replaced. Empty tables give no rows or no matches.
    """

    def matches(texts: list[bytes], items: Items) -> tuple[np.ndarray, list[pa.Array]]:
        counts, (text, item, item_start, start, length) = shard_matches(texts, items)
        fields = [pa.array(items.names, pa.string()).take(pa.array(item)), *[pa.array(x, pa.int64()) for x in (item_start, start, length)]]
        return counts, [lists(text, len(texts), pa.StructArray.from_arrays(fields, ["item_id", "item_start", "start", "length"]))]

    return _searched(spark, documents, benchmark, MATCHES, matches, window, carry, shard_bytes, block_words)


def find_hits(
    spark: SparkSession, documents: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, carry: list[str] | None = None,
    shard_bytes: int = 2_000_000, block_words: int = 2_000_000,
) -> DataFrame:
    """The carried columns (all, if not given) plus n_words long, spans and items, one row per row of `documents`.

    spans are the document's words (start, length) in any occurrence of an item's window, of one block of items without overlaps;
    items the item_ids with such a window. Else as find_matches, with spans and items in the place of matches.
    """

    def hits(texts: list[bytes], items: Items) -> tuple[np.ndarray, list[pa.Array]]:
        counts, (text, start, length), (owner, item) = shard_hits(texts, items)
        spans = pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(length, pa.int64())], ["start", "length"])
        return counts, [lists(text, len(texts), spans), lists(owner, len(texts), pa.array(items.names, pa.string()).take(pa.array(item)))]

    return _searched(spark, documents, benchmark, HITS, hits, window, carry, shard_bytes, block_words)


def lists(owner: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    """The values of each of n owners; `owner` is in order."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), values)


def _searched(spark, documents, benchmark, columns: dict[str, str], search: Callable, window, carry, shard_bytes, block_words) -> DataFrame:
    """The carried columns, n_words and what `search` gives for the texts of a shard, the lists of all blocks of items end to end."""
    carried = [c for c in (carry if carry is not None else documents.columns) if c not in ("n_words", *columns)]
    state = documents.select(F.struct(*carried).alias("_row"), F.col("text"), F.lit(0).cast("long").alias("n_words"), *[F.lit(None).cast(t).alias(c) for c, t in columns.items()])
    work = None
    for k, items in enumerate(item_blocks(benchmark, window, block_words)):
        if k:
            work = work or Workspace(spark, "decontamination")
            state = work.write(state, f"pass-{k}")
            work.drop(f"pass-{k - 1}")
        state = _annotated(spark, state, items, search, shard_bytes)
    return state.select("_row.*", "n_words", *columns)


def _annotated(spark: SparkSession, state: DataFrame, items: Items, search: Callable, shard_bytes: int) -> DataFrame:
    sent = spark.sparkContext.broadcast(items)  # at most block_words words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        for batch in batches:
            for a, b in text_chunks([t.as_py() for t in pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0)], shard_bytes):
                rows = batch.slice(a, b - a)
                counts, found = search([t or b"" for t in rows.column(1).cast(pa.binary()).to_pylist()], items)
                for k, old in enumerate(rows.columns[3:]):
                    if old.null_count < len(rows):
                        found[k] = pa.array([(x or []) + y for x, y in zip(old.to_pylist(), found[k].to_pylist(), strict=True)], old.type)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(counts, pa.int64()), *found], batch.schema.names)

    return state.mapInArrow(run, state.schema)


def hit_words(matches: str = "matches"):
    """Words inside any match: matches are sorted by start and the overlaps of their spans counted once."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("a"), (m["start"] + m["length"]).alias("b"))))
    zero = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end"))
    folded = F.aggregate(
        spans,
        zero,
        lambda acc, s: F.struct((acc["hit"] + F.greatest(s["b"] - F.greatest(s["a"], acc["end"]), F.lit(0))).alias("hit"), F.greatest(acc["end"], s["b"]).alias("end")),
    )
    return folded["hit"]


def contamination_digest(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    found = find_hits(spark, documents, benchmark, window=window, carry=["doc_id"])
    out = found.withColumn("_items", F.array_sort(F.array_distinct("items")))
    return out.select(
        "doc_id",
        "n_words",
        hit_words("spans").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("_items") > 0).alias("contaminated"),
    )


def decontaminate(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `documents` that share no window with any item, all columns kept."""
    carried = documents.select(F.struct(*documents.columns).alias("_whole"), "text")
    found = find_hits(spark, carried, benchmark, window=window, carry=["_whole"])
    return found.filter(F.size("items") == 0).select("_whole.*")
