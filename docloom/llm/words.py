"""Words of whole texts as numpy arrays: many texts are one byte buffer, and every step runs over all of it at once.

UTF-8 keeps ASCII bytes apart from all others, so the word classes used here (ranges of ASCII, and everything beyond
it) can be decided byte by byte. A word's hash is a polynomial of its bytes modulo 2**64, then
mixed. Callers cut long batches into chunks (`text_chunks`), which bounds what a worker holds beside one text.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


def byte_table(is_word: Iterable[int]) -> np.ndarray:
    """For each byte the lower-cased byte, or 0 if it stands between words."""
    table = np.zeros(256, dtype=np.uint8)
    for b in is_word:
        table[b] = b + 32 if 65 <= b <= 90 else b
    return table


#: [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z: digits, letters and all beyond ASCII.
ALPHANUMERIC = byte_table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: [^\x20\x09-\x0D] after lower-casing A-Z (byte 0 is a word's byte too; it stands as 0xFF, which UTF-8 never has).
BETWEEN_BLANKS = byte_table([b for b in range(256) if b not in (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)])
BETWEEN_BLANKS[0] = 0xFF


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64, by doubling."""
    out = np.ones(n, dtype=np.uint64)
    done, step = 1, base & MASK
    while done < n:
        m = min(done, n - done)
        out[done : done + m] = out[:m] * np.uint64(step)
        done, step = done + m, step * step & MASK
    return out


#: Words of up to STEP bytes need the first table alone; both are of fixed size, whatever the texts.
STEP = 1 << 14
_LOW = _powers(BASE, STEP)
_STEP_POWER = pow(BASE, STEP, 1 << 64)


def _weights(position: np.ndarray) -> np.ndarray:
    """BASE**position modulo 2**64, where position counts a word's bytes from 0."""
    out = _LOW[position & (STEP - 1)]
    long = np.flatnonzero(position >= STEP)
    if len(long):
        steps = position[long] // STEP
        out[long] *= _powers(_STEP_POWER, int(steps.max()) + 1)[steps]
    return out


@dataclass
class Words:
    """hashes of all texts' words in order; text t has words first[t] to first[t + 1]; starts and ends are byte positions in data."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def words_of(texts: list[bytes], table: np.ndarray) -> Words:
    raw = b"\n".join([*texts, b""])
    data = table[np.frombuffer(raw, dtype=np.uint8)]
    inside = data != 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(data) and inside[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[0::2], edges[1::2]
    lengths = ends - starts
    hashes = np.zeros(len(starts), dtype=np.uint64)
    if len(starts):
        before = np.cumsum(lengths) - lengths  # bytes of earlier words
        position = np.arange(int(lengths.sum())) - np.repeat(before, lengths)
        hashes = np.add.reduceat(_weights(position) * data[inside], before)
        hashes = mix(hashes + lengths.astype(np.uint64))
    text_starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    return Words(hashes, np.searchsorted(starts, text_starts), starts, ends, data)


def text_chunks(sizes: list[int], limit: int = 1_000_000) -> list[tuple[int, int]]:
    """Ranges of texts of about `limit` bytes together, by the texts' sizes; a longer text has a range of its own."""
    out, start, size = [], 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > limit:
            out.append((start, i))
            start, size = i, 0
        size += n + 1
    if start < len(sizes):
        out.append((start, len(sizes)))
    return out


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of `width` consecutive words, text after text, and where each text's begin.

    A text with fewer words, but not none, has one shingle: all its words.
    """
    n_texts = len(words.first) - 1
    counts = np.diff(words.first)
    full = np.maximum(counts - width + 1, np.minimum(counts, 1))
    h, base = words.hashes, np.uint64(BASE)
    rolled = np.zeros(len(h), dtype=np.uint64)
    for k in range(width):
        rolled *= base
        rolled[: len(h) - k] += h[k:]
    for t in np.flatnonzero((counts < width) & (counts > 0)):
        value = int(counts[t])
        for x in h[words.first[t] : words.first[t + 1]].tolist():
            value = (value * BASE + x) & MASK
        rolled[words.first[t]] = value
    first = np.concatenate([[0], np.cumsum(full)])
    text = np.repeat(np.arange(n_texts), full)
    hashes = mix(rolled[np.arange(len(text)) - first[text] + words.first[text]])
    for t in np.flatnonzero(full > 1):
        hashes[first[t] : first[t + 1]].sort()
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[fresh], np.searchsorted(text[fresh], np.arange(n_texts + 1))
