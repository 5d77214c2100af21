"""Encoding and decoding with a merge-type SentencePiece vocabulary.

A text's symbols are its characters; the agenda holds the rank of every adjacent pair that is a piece, best score first, ties to
the left, and the best one is merged until none is left. What is no piece then becomes its UTF-8 bytes. No piece of such a
vocabulary has a blank after another character, and in most none has letters beside other marks: a text falls there into
units (blanks, then letters or other characters) that no merge can cross. Units that a worker meets for the first time are merged all at once, a
row of numbers each, and kept in a bounded cache; long ones have a heap of their own, so a unit of any length takes n log n.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.words import text_chunks

#: How the vocabulary writes a blank, and a character that stands in no piece.
BLANK, APART = "▁", "\n"
#: Letters; in a vocabulary split by scripts they share no piece with any other character but blanks before them.
LETTERS, OTHERS = r"[^\W\d_²]", rf"(?:(?!{BLANK})[\W\d_²])"
NO_PIECE = 1 << 31
#: Units of more symbols have a heap; longer ones than LONGEST_KNOWN aren't cached. Long texts are taken in slices of about so many characters.
SHORT, LONGEST_KNOWN, SLICE = 32, 64, 1_000_000
#: Bytes that a known unit takes beside its characters and ids.
COST = 200

codecs.register_error("docloom_each_byte", lambda e: ("\ufffd", e.start + 1))


class Pairs:
    """Which two symbols make a piece: a hash table over (left, right), linear probing, as numpy arrays."""

    def __init__(self, found: dict[tuple[int, int], tuple[int, int]]):
        self.bits = max(4, (4 * len(found)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, NO_PIECE, dtype=np.int64)
        self.made = np.full(1 << self.bits, -1, dtype=np.int64)
        for (a, b), (rank, symbol) in found.items():
            slot = int(self._slots(np.array([a << 32 | b]))[0])
            while self.keys[slot] >= 0:
                slot = (slot + 1) & (len(self.keys) - 1)
            self.keys[slot], self.ranks[slot], self.made[slot] = a << 32 | b, rank, symbol

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def slots(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where each pair stands; an empty slot (rank NO_PIECE) if it is no piece. Symbols below 0 pair with nothing."""
        keys = left << 32 | right
        keys[(left < 0) | (right < 0)] = -2
        slots = self._slots(keys)
        other = np.flatnonzero((self.keys[slots] != keys) & (self.keys[slots] != -1))
        while len(other):
            slots[other] = (slots[other] + 1) & (len(self.keys) - 1)
            there = self.keys[slots[other]]
            other = other[(there != keys[other]) & (there != -1)]
        return slots


def slices(text: str) -> Iterator[str]:
    """The text in parts of about SLICE characters, cut in front of blanks that follow another character; without any it stays whole."""
    start = 0
    while (cut := text.find(BLANK, start + SLICE)) > 0:
        while 0 < cut and text[cut - 1] == BLANK:
            cut = text.find(BLANK, cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


class PieceCoder:
    """Ids of texts and texts of ids, the same as the library's own.

    Refuses models whose pieces aren't merged by score, that normalise characters or whose pieces hold inner blanks.
    """

    def __init__(self, path: str, cache_bytes: int = 64_000_000):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.library = SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto.FromString(self.library.serialized_model_proto())
        trainer, normalizer = model.trainer_spec, model.normalizer_spec
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        own = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or normalizer.precompiled_charsmap or normalizer.remove_extra_whitespaces or trainer.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: only merge-type vocabularies with byte fallback that leave characters and blanks as they are")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces) or any(BLANK in p.lstrip(BLANK) or APART in p for p in own):
            raise ValueError(f"{path}: pieces of the user, unused ones, line feeds and blanks inside pieces are not supported")
        # Where no piece reaches across, a text may be cut: in front of blanks, and between letters and other characters if all pieces allow it.
        self.unit = re.compile(f"{BLANK}*{LETTERS}+|{BLANK}*{OTHERS}+|{BLANK}+")
        if any(len(self.unit.findall(p)) > 1 for p in own):
            self.unit = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        # A symbol's number is its piece's id; characters that only stand in longer pieces have further numbers.
        self.symbols = own | {c: len(model.pieces) + k for k, c in enumerate(sorted({c for p in own for c in p} - own.keys()))}
        self.pieceless = {k: c for c, k in self.symbols.items() if k >= len(model.pieces)}
        by_score = {score: r for r, score in enumerate(sorted({model.pieces[i].score for i in own.values()}, reverse=True))}
        self.n_pieces, self.dummy = len(model.pieces), BLANK if normalizer.add_dummy_prefix else ""
        splits = ((p[:k], p[k:], i) for p, i in own.items() for k in range(1, len(p)))
        self.found = {(self.symbols[a], self.symbols[b]): (by_score[model.pieces[i].score], i) for a, b, i in splits if a in self.symbols and b in self.symbols}
        self.pairs = Pairs(self.found)
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        surface = {kinds.CONTROL: lambda p: b"", kinds.BYTE: lambda p: bytes([int(p.piece[3:5], 16)]), kinds.UNKNOWN: lambda p: trainer.unk_surface.encode()}
        self.surfaces = [surface.get(p.type, lambda p: p.piece.replace(BLANK, " ").encode())(p) for p in model.pieces]
        self.blank_first = frozenset(i for p, i in own.items() if self.dummy and p[0] == BLANK)
        self.silent = frozenset(i for i, p in enumerate(model.pieces) if p.type == kinds.CONTROL)
        normalizer.add_dummy_prefix = False
        self.bare = SentencePieceProcessor(model_proto=model.SerializeToString())  # the library on units as they are
        self.units: dict[str, bytes] = {}
        self.held, self.cache_bytes = 0, cache_bytes
        # Whether the library has given any unit's ids, or any id's text, otherwise.
        self.differs = self.bare.decode([[i] for i in range(self.n_pieces)]) != [x.decode("utf-8", "docloom_each_byte") for x in self.surfaces]

    def _merged(self, units: list[str]) -> list[bytes]:
        """Each unit's ids (int32) once no adjacent pair of its symbols is a piece any more; characters of no piece are -1 minus their code point till then."""
        out = [b""] * len(units)
        lengths = np.array([len(u) for u in units])
        codes = np.frombuffer("".join(units).encode("utf-32-le"), dtype="<u4")
        chars, place = np.unique(codes, return_inverse=True)
        flat = np.array([self.symbols.get(chr(c), -1 - c) for c in chars.tolist()], dtype=np.int64)[place]
        first = np.cumsum(lengths) - lengths
        for least, most in ((1, 6), (7, 12), (13, SHORT)):
            rows = np.flatnonzero((lengths >= least) & (lengths <= most))
            if len(rows):
                at = first[rows, None] + np.arange(most)
                table = np.where(np.arange(most) < lengths[rows, None], flat[np.minimum(at, len(flat) - 1)], -1)
                table, left = self._merged_rows(table, lengths[rows])
                plain = (((table >= 0) & (table < self.n_pieces)) | (np.arange(most) >= left[:, None])).all(axis=1).tolist()
                raw = table.astype("<i4").tobytes()
                for k, (row, n) in enumerate(zip(rows.tolist(), left.tolist(), strict=True)):
                    out[row] = raw[4 * most * k : 4 * (most * k + n)] if plain[k] else self._with_bytes(table[k, :n].tolist())
        for row in np.flatnonzero(lengths > SHORT).tolist():
            out[row] = self._with_bytes(self._merged_long(flat[first[row] : first[row] + lengths[row]].tolist()))
        return out

    def _merged_rows(self, table: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units as rows of symbols (`left` of them, then -1): every round merges each row's best pair, until no row has any."""
        width, left = table.shape[1], left.copy()
        if width < 2:
            return table, left
        slots = self.pairs.slots(table[:, :-1].ravel(), table[:, 1:].ravel()).reshape(len(table), width - 1)
        agenda, places = self.pairs.ranks[slots], np.arange(width)
        active, best = np.arange(len(table)), agenda.argmin(axis=1)
        while True:
            go = agenda[active, best] < NO_PIECE
            active, i = active[go], best[go]
            if not len(active):
                return table, left
            row, offers = table[active], agenda[active]
            each = np.arange(len(active))
            row[each, i] = self.pairs.made[self.pairs.slots(row[each, i], row[each, i + 1])]
            # What stands behind the pair moves up by one.
            row = np.take_along_axis(row, np.minimum(places + (places > i[:, None]), width - 1), axis=1)
            row[:, -1] = -1
            offers = np.take_along_axis(offers, np.minimum(places[:-1] + (places[:-1] > i[:, None]), width - 2), axis=1)
            offers[:, -1] = NO_PIECE
            follows = np.where(i + 1 < width, row[each, np.minimum(i + 1, width - 1)], -1)
            at = np.minimum(i, width - 2)
            offers[each, at] = np.where(i < width - 1, self.pairs.ranks[self.pairs.slots(row[each, i], follows)], offers[each, at])
            some = np.flatnonzero(i > 0)
            offers[some, i[some] - 1] = self.pairs.ranks[self.pairs.slots(row[some, i[some] - 1], row[some, i[some]])]
            table[active], agenda[active] = row, offers
            left[active] -= 1
            best = offers.argmin(axis=1)

    def _merged_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap; an entry (rank, place) that isn't the rank of the pair at its place any more is void."""
        n, nothing = len(symbols), (NO_PIECE, -1)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        now = [self.found.get(pair, nothing)[0] for pair in zip(symbols, symbols[1:], strict=False)] + [NO_PIECE]
        agenda = [r << 32 | i for i, r in enumerate(now) if r != NO_PIECE]
        heapify(agenda)
        gone = bytearray(n)
        while agenda:
            entry = heappop(agenda)
            i = entry & 0xFFFFFFFF
            if now[i] != entry >> 32:
                continue
            j = right[i]
            k = right[i] = right[j]
            symbols[i] = self.found[symbols[i], symbols[j]][1]
            gone[j], now[j], now[i] = 1, NO_PIECE, NO_PIECE
            if k < n:
                left[k] = i
            for a, b in ((i, k), (left[i], i)):
                if a >= 0 and b < n:
                    r = now[a] = self.found.get((symbols[a], symbols[b]), nothing)[0]
                    if r != NO_PIECE:
                        heappush(agenda, r << 32 | a)
        return [s for s, g in zip(symbols, gone, strict=True) if not g]

    def _with_bytes(self, symbols: list[int]) -> bytes:
        ids = array("i")
        for s in symbols:
            if 0 <= s < self.n_pieces:
                ids.append(s)
            else:
                ids.extend([self.byte_ids[b] for b in (chr(-1 - s) if s < 0 else self.pieceless[s]).encode()])
        return ids.tobytes()

    def _learn(self, fresh: list[str]) -> dict[str, bytes]:
        """Ids of units that aren't known: merged, and held against the library, in one go."""
        made = self._merged(fresh)
        apart = array("i", [self.byte_ids[b] for b in APART.encode()]).tobytes()
        ids = self.bare.encode(APART.join(fresh).replace(BLANK, " "), num_threads=1)
        self.differs |= apart.join(made) != array("i", ids).tobytes()
        return dict(zip(fresh, made, strict=True))

    def _ids(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that begin and end with a unit."""
        whole, known = list(map(self.unit.findall, texts)), self.units
        fresh = list({u for units in whole for u in units if u not in known})
        if not fresh:
            return [b"".join(map(known.__getitem__, units)) for units in whole]
        learned = self._learn(fresh)
        self.held += sum(map(len, fresh)) * 3 + COST * len(fresh)
        if self.held > self.cache_bytes:  # what these texts need stays
            known = self.units = {u: known[u] for units in whole for u in units if u in known}
            self.held = sum(map(len, known)) * 3 + COST * len(known)
        known |= learned
        out = [b"".join(map(known.__getitem__, units)) for units in whole]
        for u in fresh:
            if len(u) > LONGEST_KNOWN:
                self.held -= len(u) * 3 + COST
                del known[u]
        return out

    def encode_all(self, texts: list[str], end_id: int | None = None) -> list[np.ndarray]:
        """int32 ids of each whole text, `end_id` after them if given; an empty text has no other."""
        marked = [self.dummy + t.replace(" ", BLANK) if t else "" for t in texts]
        if sum(map(len, marked)) <= 2 * SLICE:
            found = self._ids(marked)
        else:
            found = [b"".join(self._ids([part])[0] for part in slices(t)) for t in marked]
        end = b"" if end_id is None else array("i", [end_id]).tobytes()
        return [np.frombuffer(ids + end, dtype=np.int32) for ids in found]

    def encode(self, text: str, end_id: int | None = None) -> np.ndarray:
        return self.encode_all([text], end_id)[0]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: a piece's blank in front goes if encoding adds one, control ids are silent, each byte that is no UTF-8 becomes U+FFFD."""
        text, start, bare = "", 0, False
        for stop in [i for i, x in enumerate(ids) if x in self.silent] + [len(ids)]:  # bytes on both sides of a control id are no character
            raw = b"".join(map(self.surfaces.__getitem__, ids[start:stop]))
            if not text and not bare and raw and ids[start] in self.blank_first:
                raw, bare = raw[1:], True
            text, start = text + raw.decode("utf-8", "docloom_each_byte"), stop + 1
        return text


@lru_cache(maxsize=1)
def piece_coder(path: str) -> PieceCoder:
    """One per Python worker, with what its tasks have learned."""
    return PieceCoder(path)


def encode_texts(documents: DataFrame, model_path: str, *, end_id: int = 2, whole_check: bool = False) -> DataFrame:
    """doc_id, ids array<int>, decoded string, agrees boolean: every whole text's ids, the text they give back, and whether the library gives the same.

    The library is asked about every unit that a worker meets, in the Arrow batch that brings it, and first about the text of every id; once
    one differs, the worker says so of all that follows. `whole_check` asks it about every whole text instead, which takes longer than the encoding.
    A null or empty text is `end_id` alone and gives back the empty text. Rows are taken one by one: repeated rows and
    null doc_ids stay. Other columns are not read; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(model_path)
        for batch in batches:
            sizes = [len(x.as_buffer()) for x in batch.column(1).fill_null("").cast(pa.large_binary())]
            for a, b in text_chunks(sizes):
                texts = [x or "" for x in batch.column(1).slice(a, b - a).to_pylist()]
                ids = coder.encode_all(texts, end_id)
                decoded = [coder.decode(x.tolist()) for x in ids]
                agrees = [not coder.differs] * len(ids)
                if whole_check:
                    theirs = coder.library.encode(texts, num_threads=1)
                    agrees = [np.array_equal(own[:-1], other) and coder.library.decode([*other, end_id]) == text for own, other, text in zip(ids, theirs, decoded, strict=True)]
                stops = np.cumsum([0, *map(len, ids)])
                lists = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists, pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())], ["doc_id", "ids", "decoded", "agrees"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, ids array<int>, decoded string, agrees boolean")
