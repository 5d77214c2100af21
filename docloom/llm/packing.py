"""Order-preserving packing by dynamic programming over window cuts.

The tokens of consecutive documents form one stream; cuts divide it into windows of at most `size` tokens. A cut is
free at a document's end, costs `sentence_cost` after a sentence's end and `word_cost` anywhere else; a window shorter
than `size` costs its padding. With positions p and f(j) the least cost of cutting at p[j],

    f(j) = cost(j) + size - p[j] + min over i with p[j] - p[i] <= size of (f(i) + p[i]),

a sliding-window minimum, so a monotone queue gives all f in linear time. A window whose length is a power of two needs
no padding; such windows are used for the rest of a stream, where one padded window would waste the most.

Streams are runs of whole documents in the order in which a partition holds them, at least `stream_tokens` long where
the partition is: nothing is shuffled, memory is bounded by one stream plus one document, and the partition's number
and a count in it number the sequences.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 4096
#: Letters that need no normalising but lower case.
LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]*")
#: Marks that stand alone after such letters.
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"
SENTENCE_MARKS = (".", "!", "?")


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte: itself, or the next one from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class WordTokenizer:
    """Ids of whole texts, the same as the tokenizer's own, from a bounded cache of what stands between two blanks.

    The vocabulary's pre-tokenizer drops white space and never joins across it, so the pieces between blanks and line
    feeds can be encoded one by one. A piece of plain letters and marks goes to the model directly, any other through
    the whole tokenizer.
    """

    def __init__(self, path: str, cache_bytes: int = 64_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        letters = byte_letters()
        self.letters = {c: "".join(letters[b] for b in chr(c).lower().encode()) for c in range(33, 256)}
        self.words = _Words(self, cache_bytes)
        ends = [i for t, i in self.tokenizer.get_vocab().items() if t.removesuffix("</w>")[-1:] in SENTENCE_MARKS]
        self.sentence_end = np.zeros(max(self.tokenizer.get_vocab_size(), 3), dtype=bool)
        self.sentence_end[ends] = True

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker: what a task has learned of the corpus's words serves the next one too."""
    return WordTokenizer(path)


class _Words(dict):
    """Two generations of pieces: when the young one is full, it becomes the old one, and what is used again stays.

    A generation is full at `limit` bytes, counted as what Python takes for a piece, its ids and their place.
    """

    def __init__(self, owner: WordTokenizer, limit: int):
        super().__init__({"": b""})
        self.old: dict[str, bytes] = {}
        self.limit, self.held, self.letters = limit, 0, owner.letters
        self.tokenize, self.whole = owner.tokenizer.model.tokenize, owner.tokenizer.encode

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            stem = piece.rstrip(MARKS)
            marks = piece[len(stem) :]
            plain = stem.lower() if stem.isascii() else stem
            if stem and (marks or plain != stem):  # what it is made of may be known
                found = self[plain] + self[marks] if LETTERS.fullmatch(plain) else None
            elif not stem:
                found = array("I", [t.id for t in self.tokenize(marks)]).tobytes()
            elif LETTERS.fullmatch(stem):
                found = array("I", [t.id for t in self.tokenize(stem if stem.isascii() else stem.translate(self.letters))]).tobytes()
            if found is None:
                found = array("I", self.whole(piece, add_special_tokens=False).ids).tobytes()
        if len(piece) <= 64:  # long junk isn't worth its memory
            self.held += 200 + 2 * len(piece) + len(found)
            if self.held >= self.limit:
                self.old, self.held = dict(self), 0
                self.clear()
                self[""] = b""
            self[piece] = found
        return found


def cut_stream(doc_ends: np.ndarray, sentence_ends: np.ndarray, size: int = SIZE, sentence_cost: float = 8.0, word_cost: float = 24.0) -> np.ndarray:
    """Cut positions of a stream of doc_ends[-1] tokens, ascending, without 0 and with the stream's end.

    doc_ends: ascending ends of the documents. sentence_ends: positions right after a sentence's last token. Where two
    such positions are over size / 4 tokens apart, places in between are offered too, so that a cut always exists.
    """
    total = int(doc_ends[-1]) if len(doc_ends) else 0
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    places = np.union1d(np.concatenate([[0], doc_ends]), sentence_ends[(sentence_ends > 0) & (sentence_ends < total)])
    wide = np.flatnonzero(np.diff(places) > size // 4)
    step = max(1, size // 16)
    if len(wide):
        places = np.union1d(places, np.concatenate([np.arange(places[i] + step, places[i + 1], step) for i in wide]))
    cost = np.full(len(places), word_cost)
    cost[np.isin(places, sentence_ends)] = sentence_cost
    cost[np.isin(places, doc_ends)] = 0.0

    # score[j] = f(j) + p[j]. The queue holds the places that may still be the best start of a later window, by
    # ascending position and score; those out of reach leave at the head, those a later place beats at the tail.
    p, c = places.tolist(), (cost + size).tolist()
    score, back = [0.0], [0]
    queue, head, first, reach = [0], 0, 0, size
    for at, value in zip(p[1:], c[1:], strict=True):
        while reach < at:
            head += 1
            first = queue[head]
            reach = p[first] + size
        back.append(first)
        value += score[first]
        while len(queue) > head and score[queue[-1]] >= value:
            queue.pop()
        queue.append(len(score))
        score.append(value)
        if len(queue) == head + 1:
            first, reach = queue[head], at + size
    best = [v - at for v, at in zip(score, p, strict=True)]

    # The rest of the stream after any cut may instead be windows of powers of two, each cut in it at word_cost.
    end, choice = best[-1], None
    for i in range(len(p) - 2, -1, -1):
        rest = total - p[i]
        if rest > size:
            break
        if (whole := best[i] + word_cost * (rest.bit_count() - 1)) < end:
            end, choice = whole, i
    cuts, j = [], len(p) - 1
    if choice is not None:
        at, rest = total, total - p[choice]
        for bit in range(rest.bit_length()):
            if rest >> bit & 1:
                cuts.append(at)
                at -= 1 << bit
        j = choice
    while j:
        cuts.append(p[j])
        j = back[j]
    return np.array(cuts[::-1], dtype=np.int64)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    documents: DataFrame, tokenizer_path: str, *, end_id: int = 2, size: int = SIZE, sentence_cost: float = 8.0, word_cost: float = 24.0,
    stream_tokens: int = 2_000_000, with_ids: bool = False,
) -> DataFrame:
    """Packs every document's ids (and `end_id` after them); one row per piece, with its ids if asked for.

    A null or empty text is `end_id` alone. Repeated rows are packed as often as they come, null doc_ids stay null.
    An empty table gives no pieces. Other columns are not read.
    """
    columns = PIECES + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last = word_tokenizer(tokenizer_path), end_id.to_bytes(4, "little")
        next_sequence = TaskContext.get().partitionId() << 40
        ids: list[bytes] = []
        names: list[int | None] = []
        held = 0
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(words.encode(text.as_py() or "") + last)
                names.append(name)
                held += len(ids[-1]) // 4
                if held >= stream_tokens:
                    out, next_sequence = pieces(names, ids, words.sentence_end, next_sequence)
                    yield out
                    ids, names, held = [], [], 0
        if ids:
            yield pieces(names, ids, words.sentence_end, next_sequence)[0]

    def pieces(names: list, docs: list[bytes], sentence_end: np.ndarray, sequence: int) -> tuple[pa.RecordBatch, int]:
        stream = np.frombuffer(b"".join(docs), dtype="<u4")
        lengths = np.array([len(d) for d in docs]) // 4
        ends = np.cumsum(lengths)
        marks = sentence_end[stream]
        after = np.flatnonzero(marks[:-1] & ~marks[1:]) + 1
        cuts = cut_stream(ends, after, size, sentence_cost, word_cost)
        stops = np.union1d(cuts, ends)
        starts = np.concatenate([[0], stops[:-1]])
        doc = np.searchsorted(ends, starts, side="right")
        window = np.searchsorted(cuts, starts, side="right")
        window_start = np.concatenate([[0], cuts])[window]
        values = stream.view(np.uint8)
        crc = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(starts, stops, strict=True)]
        named = pa.array(names, pa.int64()).take(pa.array(doc))
        arrays = [named, starts - (ends - lengths)[doc], stops - starts, crc, lengths[doc], sequence + window, starts - window_start]
        arrays = [a if isinstance(a, pa.Array) else pa.array(a, pa.int64()) for a in arrays]
        fields = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if with_ids:
            arrays.append(pa.ListArray.from_arrays(pa.array(np.concatenate([starts, stops[-1:]]), pa.int32()), pa.array(stream.astype(np.int32))))
            fields.append("ids")
        return pa.RecordBatch.from_arrays(arrays, fields), sequence + len(cuts)

    return documents.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, columns)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


