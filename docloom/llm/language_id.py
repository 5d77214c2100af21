"""Language identification by multilingual mixture inference.

Each language has smoothed probabilities of the letter trigrams of its lower-cased words (a word is a run of ASCII
letters and bytes beyond ASCII, with a mark at both ends; trigrams are of UTF-8 bytes, hashed to 2**16 cells). A text is
a sequence of units of up to `unit_words` consecutive words, each from one language; a unit's likelihood under a language
is the product over its trigrams. Expectation-maximisation estimates the text's proportions of the languages. Starting
from all of them, the language with the least share is dropped as long as the log-likelihood doesn't fall by more than
a language's penalty, half the logarithm of the number of units, plus `language_cost`.

Trigrams are counted by Spark over a sample of the labelled rows, bounded by `fit_rows` rows and dealt evenly to the
languages; the model is at most 2**16 counts per language. Whole texts are judged in their partition, nothing is
shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from docloom.llm.words import byte_table, text_chunks, words_of

CELLS = 1 << 16
UNKNOWN = "und"
#: Texts are judged in chunks of about so many bytes; a worker holds some 40 times as much meanwhile.
CHUNK_BYTES = 256_000
SHARES = ArrayType(StructType().add("lang", "string").add("share", "double"))
#: Letters: ASCII and all bytes beyond.
LETTER_BYTES = byte_table([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])


def trigram_cells(data: np.ndarray) -> np.ndarray:
    """The cell of the trigram around each byte of a lower-cased buffer with 0 between words."""
    wide = np.zeros(len(data) + 2, dtype=np.uint32)
    wide[1:-1] = data
    code = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(16)


@dataclass
class LanguageModel:
    """languages in order; scores[l] the log-probability of each cell under languages[l]."""

    languages: list[str]
    scores: np.ndarray
    unit_words: int
    language_cost: float


def fit_languages(
    labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", key: Column | None = None, fit_rows: int = 20_000,
    smoothing: float = 0.5, unit_words: int = 4, language_cost: float = 2.0,
) -> LanguageModel:
    """Fits on rows with text and language: at most about `fit_rows` of them, the same bound for each language.

    `key` decides by hash which rows are taken (the text, if not given). No labelled rows: a model without languages.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), (key if key is not None else F.col(text_col)).alias("key"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((0, CELLS), dtype=np.float32), unit_words, language_cost)
    share = F.lit(0.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, min(1.0, fit_rows / len(languages) / counts[lang])).otherwise(share)
    picked = rows.filter(F.pmod(F.xxhash64("key", F.lit("fit")), F.lit(1_000_000)) < share * 1_000_000).select("text", "lang")
    place = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((len(place), CELLS), dtype=np.int64)
        for batch in batches:
            for text, lang in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = words_of([text], LETTER_BYTES).data
                found[place[lang]] += np.bincount(trigram_cells(data)[data != 0], minlength=CELLS)
        lang, cell = np.nonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(cell, pa.int32()), pa.array(found[lang, cell], pa.int64())], ["lang", "cell", "n"])

    summed = picked.mapInArrow(count, "lang int, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.full((len(languages), CELLS), smoothing)
    table[summed["lang"].to_numpy(), summed["cell"].to_numpy()] += summed["n"].to_numpy()
    scores = np.log(table / table.sum(axis=1, keepdims=True))
    return LanguageModel(languages, scores.astype(np.float32), unit_words, language_cost)


def mixtures(texts: list[bytes], model: LanguageModel, rounds: int = 6) -> np.ndarray:
    """proportions[text, language] of every text over the languages selected for it; zeros for a text without words."""
    words = words_of(texts, LETTER_BYTES)
    n_langs, n_texts = len(model.languages), len(texts)
    out = np.zeros((n_texts, n_langs), dtype=np.float32)
    counts = np.diff(words.first)
    if not len(words.hashes) or not n_langs:
        return out
    # Units: every unit_words-th word of a text begins one.
    text_of_word = np.repeat(np.arange(n_texts), counts)
    begins = (np.arange(len(words.hashes)) - words.first[text_of_word]) % model.unit_words == 0
    unit_text = text_of_word[begins]
    starts = words.starts[begins]
    cells = trigram_cells(words.data)
    inside = words.data != 0
    likelihood = np.empty((n_langs, len(starts)), dtype=np.float32)
    for k in range(n_langs):
        likelihood[k] = np.add.reduceat(np.where(inside, model.scores[k][cells], np.float32(0)), starts)
    best = likelihood.max(axis=0)
    likelihood = np.exp(likelihood - best)

    has = np.flatnonzero(counts > 0)
    row_of_text = np.zeros(n_texts, dtype=np.int64)
    row_of_text[has] = np.arange(len(has))
    row = row_of_text[unit_text]
    first = np.searchsorted(row, np.arange(len(has)))
    units = np.bincount(row).astype(np.float32)
    penalty = 0.5 * np.log(units) + model.language_cost

    share = np.full((n_langs, len(has)), 1 / n_langs, dtype=np.float32)
    share, fit = _em(likelihood, row, first, units, share, rounds)
    live = np.arange(len(has))  # texts for which dropping a language is still tried
    for _ in range(n_langs - 1):
        trial = share[:, live].copy()
        filled = np.where(trial > 0, trial, np.inf)
        least = filled.argmin(axis=0)
        several = (trial > 0).sum(axis=0) > 1
        live, trial, least = live[several], trial[:, several], least[several]
        if not len(live):
            break
        trial[least, np.arange(len(live))] = 0
        trial /= np.maximum(trial.sum(axis=0), np.float32(1e-30))
        picked = np.zeros(len(has), dtype=bool)
        picked[live] = True
        where = np.flatnonzero(picked[row])
        part_row = np.cumsum(picked)[row[where]] - 1
        trial, less = _em(likelihood[:, where], part_row, np.searchsorted(part_row, np.arange(len(live))), units[live], trial, 3)
        better = less >= fit[live] - penalty[live]
        live = live[better]
        share[:, live], fit[live] = trial[:, better], less[better]
    out[has] = share.T
    return out


def _em(likelihood, row, first, units, share, rounds):
    """The proportions after `rounds` steps, and the log-likelihood (relative to each unit's best language) before the last."""
    total = None
    for _ in range(rounds):
        joint = likelihood * share[:, row]
        total = joint.sum(axis=0)
        np.maximum(total, np.float32(1e-30), out=total)
        joint /= total
        share = np.add.reduceat(joint, first, axis=1) / units
    return share, np.add.reduceat(np.log(total), first)


def identify(spark: SparkSession, documents: DataFrame, model: LanguageModel, *, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all, if not given) plus lang_pred string, score double and languages array<struct>.

    lang_pred is the language with the largest proportion, score that proportion (0 to 1), languages all selected ones
    with their proportions, largest first. A null text or one without a letter is `und` with score 0; so is every text
    if the model has no language. Ties go to the language first in order. Columns named lang_pred, score or languages
    are replaced. Rows are judged one by one, repeated ones alike; an empty table gives an empty result.
    """
    carried = [c for c in (carry if carry is not None else documents.columns) if c not in ("lang_pred", "score", "languages")]
    sent = spark.sparkContext.broadcast(model)  # at most 2**16 numbers per language

    @F.arrow_udf(StructType().add("lang_pred", "string").add("score", "double").add("languages", SHARES))
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        for batch in batches:
            for p, q in text_chunks(pc.fill_null(pc.binary_length(batch), 0).to_pylist(), CHUNK_BYTES):
                texts = [t or b"" for t in batch.slice(p, q - p).cast(pa.binary()).to_pylist()]
                shares = mixtures(texts, model)
                best = shares.argmax(axis=1) if len(model.languages) else np.zeros(len(texts), dtype=np.int64)
                names, scores, lists = [], [], []
                for text, share, k in zip(texts, shares, best.tolist(), strict=True):
                    if not len(share) or share[k] == 0 or not has_letter(text):
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        lists.append([])
                        continue
                    names.append(model.languages[k])
                    scores.append(min(1.0, float(share[k])))
                    lists.append([{"lang": model.languages[i], "share": float(share[i])} for i in np.argsort(-share, kind="stable") if share[i] > 0])
                kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
                yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(lists, kind)], ["lang_pred", "score", "languages"])

    # Only texts go to Python, and only what is said of them comes back; the rows stay with Spark.
    rows = documents.select(F.struct(*carried).alias("_row"), judged(F.col(text_col)).alias("_said"))
    return rows.select("_row.*", "_said.*")


def has_letter(text: bytes) -> bool:
    """Whether any code point is a letter; ASCII ones are looked for first."""
    if LETTER_BYTES[np.frombuffer(text[:200], dtype=np.uint8)].any() and any(c.isalpha() for c in text[:200].decode("utf-8", "ignore")):
        return True
    return any(c.isalpha() for c in text.decode("utf-8", "ignore"))


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 4, is 2: these rows are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def language_report(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages of every document, by a model of the rows not held out."""
    model = fit_languages(documents.filter(~is_held_out(F.col("doc_id"))), key=F.col("doc_id"))
    judged = identify(spark, documents, model, carry=["doc_id"])
    return judged.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "languages")


def known_language(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """The rows of `documents` for which a language was found; those of `und` go."""
    model = fit_languages(documents.filter(~is_held_out(F.col("doc_id"))), key=F.col("doc_id"))
    return identify(spark, documents, model).filter(F.col("lang_pred") != UNKNOWN).select(*documents.columns)
