"""Text measures as columns, without a shuffle. Lengths and offsets count code points."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache
from string import ascii_letters, digits

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the characters that count as broken.
BROKEN = "[□■○●◆▲△▽◇☆★�]"


#: White space as str.isspace() sees it.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(x: Column) -> Column:
    """Without white space at both ends, in the Unicode sense; linear, also in long runs of white space."""
    return F.btrim(x, F.lit(SPACES))


def estimated_tokens(text: Column, per_char: float = 0.5) -> Column:
    return F.ceil(F.length(F.coalesce(text, F.lit(""))) * per_char).cast("int")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole, 4)).otherwise(0.0)


MEASURES = (
    "broken_char_ratio", "excessive_space_ratio", "mixed_encoding_ratio", "avg_line_length", "empty_lines_ratio", "total_chars", "unique_chars", "hangul_ratio", "digit_ratio",
    "special_char_ratio",
)
#: What one pass over the characters counts; `solid` are those that aren't white space, `full` lines hold one.
COUNTS = ("n", "broken", "wide_spaces", "hangul", "latin", "digits", "solid", "words", "mixed", "lines", "full", "full_chars", "kinds")
#: Characters of the texts that are worked on together, and how many texts at most.
TOGETHER, MOST_TEXTS = 1_000_000, 4096


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """For each code point a bit per class: broken, Hangul, Latin, digit, white space; the last place is between texts."""
    table = np.zeros(0x110001, dtype=np.uint8)
    for bit, chars in enumerate((BROKEN.strip("[]"), "".join(map(chr, range(0xAC00, 0xD7A4))), ascii_letters, digits, SPACES)):
        table[[ord(c) for c in chars]] |= 1 << bit
    table[0x110000] = 1 << 4
    return table


def text_counts(texts: Sequence[str]) -> np.ndarray:
    """COUNTS of each text, a row each: all of them from one array of code points."""
    sizes, n = np.array([len(t) for t in texts]), len(texts)
    codes = np.full(int(sizes.sum()) + n + 1, 0x110000, dtype=np.int32)
    text_of = np.concatenate([[0], np.repeat(np.arange(n), sizes + 1)])  # the mark behind a text is its own
    inside = np.ones(len(codes), dtype=bool)
    inside[0] = inside[np.cumsum(sizes + 1)] = False
    codes[inside] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = _classes()[codes]

    def held(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether the parts that begin at the places hold any."""
        return np.logical_or.reduceat(mask, at) if len(at) else np.zeros(0, dtype=bool)

    def per_text(places: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(text_of[places], values, minlength=n).astype(np.int64)

    solid, space = kind & 16 == 0, codes == 32
    words = np.flatnonzero(solid[1:] & ~solid[:-1]) + 1
    mixed = held(kind & 2 != 0, words) & held(kind & 4 != 0, words)
    wide = space & (np.roll(space, 1) | np.roll(space, -1))
    # A line begins behind each mark and line feed; the last mark has none behind it.
    line = np.flatnonzero(((codes == 10) | ~inside)[:-1]) + 1
    full = held(solid, line)
    lengths = np.diff(np.append(line, len(codes))) - 1
    present = np.zeros(0x110001, dtype=bool)
    present[codes] = True
    seen = np.zeros((n, int(present.sum())), dtype=bool)
    seen[text_of[inside], (np.cumsum(present, dtype=np.int32) - 1)[codes[inside]]] = True
    classes = np.bincount(text_of << 5 | kind, minlength=n << 5).reshape(n, 32)  # how often each set of classes
    broken, hangul, latin, digit, white = (classes[:, np.arange(32) >> bit & 1 == 1].sum(axis=1) for bit in range(5))
    marks = 1 + (np.arange(n) == 0)
    return np.stack([sizes, broken, per_text(np.flatnonzero(wide)), hangul, latin, digit, sizes - white + marks, per_text(words), per_text(words[mixed]), per_text(line), per_text(line[full]), per_text(line[full], lengths[full]), seen.sum(axis=1)], axis=1)


def _counted(text: Column) -> Column:
    @F.arrow_udf(f"struct<{','.join(f'{c}:bigint' for c in COUNTS)}>")
    def counts(column: pa.Array) -> pa.Array:
        texts, rows, start, size = [t or "" for t in column.to_pylist()], [], 0, 0
        for stop, t in enumerate(texts, 1):
            size += len(t)
            if size >= TOGETHER or stop - start >= MOST_TEXTS or stop == len(texts):
                rows.append(text_counts(texts[start:stop]))
                start, size = stop, 0
        table = np.concatenate(rows) if rows else np.zeros((0, len(COUNTS)), dtype=np.int64)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in table.T], list(COUNTS))

    return counts(text)


def with_text_metrics(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the ten MEASURES; all zero for a null or empty text. Ratios have four decimals, the mean line length one.

    A text's characters are counted in one pass over their code points, many texts at a time; built-in functions would
    need a regular expression's pass per class and an array of all characters.
    """
    counted = rows.withColumn("_c", _counted(F.col(text_col)))
    n, c = F.col("_c.n"), lambda name: F.col(f"_c.{name}")
    other = F.greatest(F.lit(0), c("solid") - c("hangul") - c("digits") - c("latin"))
    values = (
        _share(c("broken"), n), _share(c("wide_spaces"), n), _share(c("mixed"), c("words")), F.when(c("full") > 0, F.round(c("full_chars") / c("full"), 1)).otherwise(0.0),
        F.when(n > 0, _share(c("lines") - c("full"), c("lines"))).otherwise(0.0), n.cast("int"), c("kinds").cast("int"), _share(c("hangul"), n), _share(c("digits"), n), _share(other, n),
    )
    made = dict(zip(MEASURES, values, strict=True))
    return counted.select(*[F.col(f"`{x}`") for x in rows.columns if x not in made], *[x.alias(name) for name, x in made.items()])
