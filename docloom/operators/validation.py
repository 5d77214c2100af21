"""Checks of parsed questions (chunk_id, pos, id, text, options) and of how they differ from the text they come from.

A check is a column: the array of issues that it finds in its row. A question's checks are concatenated and exploded once,
so they are one projection whatever their number, and so are those of a chunk against its original; only what needs a
chunk's questions together (repeated and missing ids, sums against the original) shuffles, by chunk. All issues share a
schema.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.batches import slices
from docloom.functions.matching import similarities
from docloom.functions.text import SPACES, strip
from docloom.operators.dictionary import SHIPPED, Terms, absent_words, term_issues
from docloom.operators.responses import SAME

LEAST_LENGTH_SHARE, LEAST_SIMILARITY, LEAST_OPTION_SHARE, MOST_LOST, SHORT_OPTION, LEAST_MEAN_LENGTH = 0.5, 0.5, 0.8, 0.3, 0.3, 10
# Option marks counted in an original text, and what a keyword is.
OPTION_MARKS = ("[①②③④⑤⑥⑦⑧⑨⑩]", "(?<![가-힣])[ㄱㄴㄷㄹㅁ](?![가-힣])", r"(?:^|\s)(\d{1,2})[.)]\s")
KEYWORD = "[가-힣A-Za-z0-9]{3,}"
#: Missing numbers that one row names.
GAP_BLOCK = 10_000


def _issue(source: str, kind: str, severity: str, detail: Column, *, question: Column | None = None, pos: Column | None = None, option: Column | None = None) -> Column:
    no_option = F.lit("") if option is None else F.coalesce(option, F.lit(""))
    return F.struct(
        F.lit(source).alias("source"), F.lit(kind).alias("issue_type"), F.lit(severity).alias("severity"), (F.col("id") if question is None else question).cast("long").alias("question_id"),
        (F.col("pos") if pos is None else pos).cast("int").alias("pos"), no_option.alias("option_num"), detail.cast("string").alias("detail"),
    )


def _if(found: Column, issue: Column) -> Column:
    return F.array_compact(F.array(F.when(found, issue)))


def issues(rows: DataFrame, *checks: Column) -> DataFrame:
    """A row per issue that the checks find in the rows (chunk_id, ...)."""
    # A projection of its own, where Spark works out what checks have in common once.
    found = rows.select("chunk_id", F.concat(*checks).alias("found"))
    # An inner explode would have the whole array worked out a second time, for a filter of empty ones before it.
    each = found.select("chunk_id", F.explode_outer("found").alias("i")).filter("i is not null")
    return each.select(
        "chunk_id", "i.source", "i.issue_type", "i.severity", "i.question_id", "i.pos", F.lit("").alias("location"), "i.option_num", F.lit("").alias("term"), F.lit("").alias("suggestion"), "i.detail",
    )


def _options() -> Column:
    return F.coalesce("options", F.expr("array()"))


def _blank(x: Column) -> Column:
    return F.ltrim(F.coalesce(x, F.lit("")), F.lit(SPACES)) == ""


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """The array use(value), the value worked out once however often it is used; empty for a null value."""
    return F.flatten(F.transform(F.array_compact(F.array(value)), use))


def dealt(questions: DataFrame) -> DataFrame:
    """The same rows, dealt by chunk: whatever checks and sheets read them, they are made and shuffled once, and what goes by chunk_id then needs no further shuffle."""
    # As one column, since Spark would shuffle them once for each choice of columns.
    rest = F.struct(*[c for c in questions.columns if c != "chunk_id"])
    packed = questions.select("chunk_id", F.array(rest).alias("q")).repartition("chunk_id")
    return packed.select("chunk_id", F.inline_outer("q")).select(*questions.columns)


def repeated_ids() -> Column:
    """Over rows (id, n, gap_from): an id that a chunk has several times; told once, with the first block of the gap behind it."""
    first = F.col("gap_from").isNull() | (F.col("gap_from") == F.col("id") + 1)
    return _if((F.col("n") > 1) & first, _issue("structure", "DUPLICATE_QUESTION", "ERROR", F.col("n"), pos=F.lit(None)))


def missing_ids() -> Column:
    """Over rows (following, gap_from): the numbers of one block of the gap between neighbouring ids of a chunk; none before the first or after the last."""
    block = F.sequence("gap_from", F.least(F.col("gap_from") + GAP_BLOCK, F.col("following")) - 1)
    each = F.when(F.col("gap_from").isNotNull(), block).otherwise(F.expr("cast(array() as array<bigint>)"))
    return F.transform(each, lambda k: _issue("structure", "MISSING_QUESTION", "ERROR", k, question=k, pos=F.lit(None)))


def option_counts(expected: Column) -> Column:
    n = F.size(_options())
    return _if((expected > 0) & (n != expected), _issue("structure", "OPTION_COUNT_INCONSISTENT", "WARNING", n))


def repeated_option_texts() -> Column:
    """One issue per text that several options of a question share; empty ones and `동일` aside."""
    texts = F.sort_array(F.transform(_options(), lambda o: strip(F.coalesce(o["text"], F.lit("")))))
    # In a sorted list a text's second place follows its first.
    again = _with(texts, lambda s: F.filter(s, lambda t, i: (i > 0) & (t == F.get(s, i - 1)) & (t != "") & (t != SAME)))
    return F.transform(F.array_distinct(again), lambda t: _issue("structure", "TEXT_DUPLICATED", "WARNING", F.substring(t, 1, 30)))


def answer_values(raw: str = "correct") -> Column:
    """Options whose `correct` (as text) is neither true nor false."""
    value = lambda o: F.coalesce(o[raw].cast("string"), F.lit(""))
    bad = F.filter(_options(), lambda o: ~value(o).isin("true", "false"))
    return F.transform(bad, lambda o: _issue("structure", "INVALID_CORRECT_VALUE", "ERROR", value(o), option=o["num"]))


def answer_counts() -> Column:
    values = _options()["correct"].cast("array<string>")
    right = F.size(values) - F.size(F.array_remove(values, "true"))
    none, many = _issue("structure", "NO_CORRECT_ANSWER", "ERROR", F.lit(0)), _issue("structure", "MULTIPLE_CORRECT_ANSWERS", "WARNING", right)
    return F.array_compact(F.array(F.when(right == 0, none).when(right > 1, many)))


def empty_fields() -> Column:
    bare = lambda kind: _issue("structure", kind, "ERROR", F.lit(""))
    own = F.array_compact(F.array(F.when(_blank(F.col("text")), bare("EMPTY_QUESTION_TEXT")), F.when(F.size(_options()) == 0, bare("EMPTY_OPTIONS"))))
    blank = lambda field, kind: F.transform(F.filter(_options(), lambda o: _blank(o[field])), lambda o: _issue("structure", kind, "ERROR", F.lit(""), option=o["num"]))
    return F.concat(own, blank("num", "EMPTY_OPTION_NUM"), blank("text", "EMPTY_OPTION_TEXT"))


def question_checks(expected: Column | None = None) -> list[Column]:
    """The structure checks of a question by itself; `expected` is the number of options asked for, none if not given."""
    return [option_counts(F.lit(0) if expected is None else expected), repeated_option_texts(), answer_values(), answer_counts(), empty_fields()]


def numbering_issues(questions: DataFrame) -> DataFrame:
    """Repeated and missing ids of each chunk."""
    counted = questions.groupBy("chunk_id", F.col("id").cast("long").alias("id")).agg(F.count("*").alias("n"))
    numbered = counted.withColumn("following", F.lead("id").over(Window.partitionBy("chunk_id").orderBy("id")))
    # A wide gap is a row per block, so no array holds it whole.
    blocks = F.when(F.col("following") - F.col("id") > 1, F.sequence(F.col("id") + 1, F.col("following") - 1, F.lit(GAP_BLOCK).cast("long")))
    return issues(numbered.withColumn("gap_from", F.explode_outer(blocks)), repeated_ids(), missing_ids())


def structure_issues(questions: DataFrame, expected: Column | None = None) -> DataFrame:
    """All structure checks."""
    return issues(questions, *question_checks(expected)).unionByName(numbering_issues(questions))


def result_text() -> Column:
    """A question's text, option texts and explanations, without the empty ones, one blank between."""
    full = lambda x: F.nullif(x, F.lit(""))
    options = F.transform(_options(), lambda o: full(F.concat_ws(" ", full(o["text"]), full(o["explanation"]))))
    return F.array_join(F.concat(F.array(full(F.col("text"))), options), " ")


def compared(questions: DataFrame, originals: DataFrame) -> DataFrame:
    """chunk_id, original, result, n_options: one row per original (chunk_id, original); a chunk has few questions."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", result_text().alias("t"))))
    made = questions.groupBy("chunk_id").agg(ordered.alias("parts"), F.sum(F.size(_options())).alias("n_options"))
    joined = originals.join(made, "chunk_id", "left")
    result = F.array_join(F.filter(F.transform("parts", lambda p: p["t"]), lambda x: x != ""), " ")
    return joined.select("chunk_id", F.coalesce("original", F.lit("")).alias("original"), F.coalesce(result, F.lit("")).alias("result"), F.coalesce("n_options", F.lit(0)).alias("n_options"))


def similarity(pairs: DataFrame, autojunk: bool = True) -> DataFrame:
    """Adds similarity: the share of characters in common blocks of original and result, see functions.matching; null texts are empty."""

    @F.arrow_udf("double")
    def ratio(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in slices(batches):
            yield pa.array(similarities([x or "" for x in a], [x or "" for x in b], autojunk), pa.float64())

    return pairs.withColumn("similarity", ratio("original", "result"))


def _whole(found: Column, kind: str, severity: str, detail: Column) -> Column:
    return _if(found, _issue("diff", kind, severity, detail, question=F.lit(0), pos=F.lit(None)))


def truncations() -> Column:
    share = F.length("result") / F.length("original")
    return _whole((F.length("original") > 0) & (share < LEAST_LENGTH_SHARE), "TRUNCATION", "ERROR", F.length("result"))


def hallucinations() -> Column:
    return _whole(F.col("similarity") < LEAST_SIMILARITY, "HALLUCINATION", "ERROR", F.round("similarity", 2))


def missing_options() -> Column:
    marks = F.greatest(*[F.regexp_count("original", F.lit(rx)) for rx in OPTION_MARKS])
    few = (marks > 0) & (F.col("n_options") / marks < LEAST_OPTION_SHARE)
    return _whole(few, "OPTION_MISSING", "ERROR", F.format_string("%d of %d", F.col("n_options").cast("int"), marks))


def lost_keywords() -> Column:
    """Distinct keywords of the original that the result nowhere holds; the detail names the first ten in order."""
    keywords = lambda c: F.array_distinct(F.regexp_extract_all(c, F.lit(KEYWORD), F.lit(0)))
    words = keywords("original")
    # Most stand in the result as keywords of its own; only the others may be parts of longer ones.
    lost = absent_words(F.array_except(words, keywords("result")), F.col("result"))
    many = (F.size(words) > 0) & (F.size(lost) / F.size(words) > MOST_LOST)
    return _whole(many, "KEYWORD_LOSS", "WARNING", F.array_join(F.slice(F.sort_array(lost), 1, 10), ", "))


def odd_lengths() -> Column:
    """Options far shorter than the mean of their question's (two options and a mean of ten characters at least)."""
    length = lambda o: F.length(F.coalesce(o["text"], F.lit("")))
    n, total = F.size(_options()), F.length(F.array_join(_options()["text"], ""))
    mean = F.when((n >= 2) & (total / n >= LEAST_MEAN_LENGTH), total / n)
    short = _with(mean, lambda m: F.filter(_options(), lambda o: length(o) < SHORT_OPTION * m))
    return F.transform(short, lambda o: _issue("diff", "LENGTH_ANOMALY", "WARNING", length(o), option=o["num"]))


def pair_checks(alike: bool = True) -> list[Column]:
    """The checks of a chunk's result against its original; `alike` takes the column of similarity() in."""
    return [truncations(), *([hallucinations()] if alike else []), missing_options(), lost_keywords()]


def diff_issues(questions: DataFrame, originals: DataFrame, autojunk: bool = True) -> DataFrame:
    """All checks against the originals, similarity included."""
    pairs = similarity(compared(questions, originals), autojunk)
    return issues(pairs, *pair_checks()).unionByName(issues(questions, odd_lengths()))


def all_issues(questions: DataFrame, originals: DataFrame, terms: Terms = SHIPPED, expected: Column | None = None, alike: bool = True) -> DataFrame:
    """Every issue of the structure, diff and term checks, each kind of row read once; `alike=False` leaves out similarity."""
    pairs = compared(questions, originals)
    found = issues(questions, *question_checks(expected), odd_lengths()).unionByName(numbering_issues(questions))
    found = found.unionByName(issues(similarity(pairs) if alike else pairs, *pair_checks(alike)))
    return found.unionByName(term_issues(questions, terms))
