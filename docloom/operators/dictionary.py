"""Dictionary terms: which misspellings a text holds, where, and what it reads with them replaced.

A dictionary is a list of (canonical, pattern) pairs of bounded length. To scan texts it becomes an Aho-Corasick automaton that
goes to the workers with the function; to look terms up it becomes a relation and is joined. Longer patterns win over shorter
ones they overlap, ties in the dictionary's order, whatever stands further left. A pattern matches inside longer words too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.batches import slices

# The shipped pairs.
LEGAL_TERMS = (
    ("계약", "게약"), ("계약", "계락"), ("청약", "청악"), ("승낙", "승락"), ("물권", "뭴권"), ("물권", "물구권"), ("채권", "채김"), ("채권", "채완"),
    ("담보권", "담배권"), ("유언", "유원"), ("유언", "유안"), ("상속", "상촉"), ("대리", "대며"), ("법인", "법임"), ("법인", "법운"),
    ("채무불이행", "채무미이행"), ("손해배상", "손해배송"), ("동산", "동삼"),
)
#: The shipped canonical terms; some have no misspelling.
CANONICAL_TERMS = tuple(
    "계약 청약 승낙 물권 채권 담보권 저당권 질권 유언 상속 대리 법인 채무불이행 불법행위 손해배상 특수한물권 점유권 유치권 동산 부동산 선의 악의 표현행위 도급 용역 임차 임대".split()
)
LEAST_LENGTH = 2
MOST_TERMS = 10_000
#: Up to so many patterns are looked for by built-in functions, and so many terms validated in an expression.
FEW, MOST_INLINE = 32, 200


@dataclass(frozen=True)
class Dictionary:
    """Canonical names, and the (canonical, pattern) pairs of their misspellings."""

    names: tuple[str, ...]
    pairs: tuple[tuple[str, str], ...]


SHIPPED = Dictionary(CANONICAL_TERMS, LEGAL_TERMS)
#: What operators take: a dictionary, or pairs alone, whose canonical sides are then the names.
Terms = Dictionary | Sequence[tuple[str, str]]


def dictionary_of(rows: DataFrame) -> Dictionary:
    """The dictionary of a table (canonical, pattern) as read_dictionary() gives it; it goes to every worker, so it is bounded."""
    found = [(r["canonical"], r["pattern"]) for r in rows.select("canonical", "pattern").limit(MOST_TERMS + 1).collect()]
    if len(found) > MOST_TERMS:
        raise ValueError(f"a dictionary of more than {MOST_TERMS} patterns is too large to scan for; validate_terms() takes tables of any size")
    return Dictionary(tuple(dict.fromkeys(c for c, _ in found if c)), tuple((c, p) for c, p in found if c and p))


def pairs_of(terms: Terms) -> Sequence[tuple[str, str]]:
    return terms.pairs if isinstance(terms, Dictionary) else terms


def names_of(terms: Terms) -> list[str]:
    return sorted(terms.names if isinstance(terms, Dictionary) else {c for c, _ in terms})


def is_obvious_typo(canonical: str, pattern: str) -> bool:
    """One character differs at equal length, or the lengths differ by one."""
    if len(canonical) == len(pattern):
        return sum(a != b for a, b in zip(canonical, pattern, strict=True)) == 1
    return abs(len(canonical) - len(pattern)) == 1


def pattern_index(terms: Terms, obvious_only: bool = True) -> list[tuple[str, str]]:
    """The usable pairs, longest pattern first, else in their own order."""
    kept = [(c, p) for c, p in pairs_of(terms) if p != c and len(p) >= LEAST_LENGTH and (not obvious_only or is_obvious_typo(c, p))]
    return sorted(kept, key=lambda pair: -len(pair[1]))


def confidence(canonical: str, pattern: str) -> str:
    return "high" if len(canonical) == len(pattern) else "medium"


class Scanner:
    """Finds all patterns of a dictionary in one pass over a text, and keeps the hits that no better pattern overlaps."""

    def __init__(self, index: Sequence[tuple[str, str]]):
        self.index, self.automaton = list(index), ahocorasick.Automaton()
        for k in range(len(self.index) - 1, -1, -1):  # of equal patterns the first stays
            self.automaton.add_word(self.index[k][1], k)
        if self.index:
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, int]]:
        """(start, stop, place in the index) by start: patterns in the index's order, each left to right without overlapping itself."""
        if not self.index:
            return []
        found = [(k, end + 1) for end, k in self.automaton.iter(text)]
        if len(found) == 1:
            k, stop = found[0]
            return [(stop - len(self.index[k][1]), stop, k)]
        found.sort()
        taken, kept, pattern, free = bytearray(len(text)) if found else b"", [], -1, 0
        for k, stop in found:
            n = len(self.index[k][1])
            if k != pattern:
                pattern, free = k, 0
            if stop - n < free:
                continue
            free = stop
            if taken.find(1, stop - n, stop) < 0:
                taken[stop - n : stop] = b"\x01" * n
                kept.append((stop - n, stop, k))
        return sorted(kept)

    def corrected(self, text: str, hits: Sequence[tuple[int, int, int]]) -> str:
        """The text with every hit replaced in one pass."""
        parts, at = [], 0
        for start, stop, k in hits:
            parts += (text[at:start], self.index[k][0])
            at = stop
        return "".join([*parts, text[at:]])


@lru_cache(maxsize=8)
def scanner(index: tuple[tuple[str, str], ...]) -> Scanner:
    """One per worker and dictionary."""
    return Scanner(index)


HITS = "array<struct<start:int,stop:int,original:string,canonical:string,confidence:string>>"


def _hit_arrays(index: tuple[tuple[str, str], ...], found: list[list[tuple[int, int, int]]]) -> pa.ListArray:
    """The texts' hits as one array of HITS."""
    flat = [h for hits in found for h in hits]
    which = pa.array([k for *_, k in flat], pa.int32())
    named = [pa.array([x[side] for x in index], pa.string()).take(which) for side in (1, 0)]
    sure = pa.array([confidence(c, p) for c, p in index], pa.string()).take(which)
    places = [pa.array([h[i] for h in flat], pa.int32()) for i in (0, 1)]
    each = pa.StructArray.from_arrays([*places, *named, sure], ["start", "stop", "original", "canonical", "confidence"])
    return pa.ListArray.from_arrays(pa.array(list(accumulate(map(len, found), initial=0)), pa.int32()), each)


def scan(text: Column, index: Sequence[tuple[str, str]]) -> Column:
    """HITS by start. The dictionary is one automaton, however many patterns it has: time is linear in the text and its hits."""
    fixed = tuple(index)

    @F.arrow_udf(HITS)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        s = scanner(fixed)
        for (texts,) in slices((t,) for t in batches):
            yield _hit_arrays(fixed, [s.hits(t) if t else [] for t in texts])

    return found(text) if fixed else F.expr(f"cast(array() as {HITS})")


def pre_correct(rows: DataFrame, terms: Terms = SHIPPED, enabled: bool = True, text_col: str = "text") -> DataFrame:
    """Adds corrected_text and corrections (offsets before replacement); null texts are empty."""
    fixed = tuple(pattern_index(terms) if enabled else ())
    text = F.coalesce(F.col(text_col), F.lit(""))

    @F.arrow_udf(f"struct<corrections:{HITS},text:string>")
    def fix(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        s = scanner(fixed)
        for (texts,) in slices((t,) for t in batches):
            hits = [s.hits(t) for t in texts]
            done = pa.array([s.corrected(t, h) if h else t for t, h in zip(texts, hits, strict=True)], pa.string())
            yield pa.StructArray.from_arrays([_hit_arrays(fixed, hits), done], ["corrections", "text"])

    if not fixed:
        return rows.withColumns({"corrections": F.expr(f"cast(array() as {HITS})"), "corrected_text": text})
    return rows.withColumn("_fixed", fix(text)).withColumns({"corrections": F.col("_fixed.corrections"), "corrected_text": F.col("_fixed.text")}).drop("_fixed")


def absent_words(words: Column, text: Column) -> Column:
    """Those of a row's words that its text nowhere holds, in order; all words of a row are looked for in one pass."""

    @F.arrow_udf("array<string>")
    def absent(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for lists, texts in slices(batches):
            out = []
            for row, body in zip(lists, texts, strict=True):
                if row and body:
                    automaton = ahocorasick.Automaton()
                    for w in row:
                        automaton.add_word(w, w)
                    automaton.make_automaton()
                    held = {w for _, w in automaton.iter(body)}
                    row = [w for w in row if w not in held]
                out.append(row)
            yield pa.array(out, pa.list_(pa.string()))

    return absent(words, text)


def correction_log(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per correction of pre_correct(), with its location as text."""
    # An inner explode would have the texts scanned a second time, for a filter of those without corrections before it.
    each = rows.select(*keys, F.explode_outer("corrections").alias("c")).filter("c is not null")
    where = F.format_string("offset %d-%d", "c.start", "c.stop")
    return each.select(*keys, "c.original", F.col("c.canonical").alias("corrected"), where.alias("location"), "c.confidence")


def canonical_terms(text: Column, terms: Terms = SHIPPED) -> Column:
    """Sorted distinct canonical terms in the text; many are looked for in one pass, as in scan()."""
    names = tuple(names_of(terms))
    if len(names) <= FEW:
        return F.array_sort(F.filter(F.array(*[F.lit(c) for c in names]), lambda c: F.contains(text, c)))

    @F.arrow_udf("array<string>")
    def held(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = scanner(tuple((n, n) for n in names if n)).automaton
        always = {k for k, n in enumerate(names) if not n}
        spots = [k for k, n in enumerate(names) if n]
        for (texts,) in slices((t,) for t in batches):
            yield pa.array([None if t is None else [names[k] for k in sorted({spots[i] for _, i in automaton.iter(t)} | always)] for t in texts], pa.list_(pa.string()))

    return held(text)


_VERDICT = "struct<valid:boolean,suggestion:string,confidence:string>"


def _verdicts(terms: Terms) -> list[tuple[str, bool, str, str]]:
    """(term, valid, suggestion, confidence) of every term that the dictionary knows, each once: canonical ones, then misspellings in its order."""
    known = {c: (c, True, "", "high") for c in names_of(terms)}
    for c, p in pattern_index(terms, obvious_only=False):
        known.setdefault(p, (p, False, c, confidence(c, p)))
    return list(known.values())


def validate_term(term: Column, terms: Terms = SHIPPED) -> Column:
    """struct<valid, suggestion, confidence>: canonical, a known misspelling, or unknown (valid, low).

    The dictionary stands in the expression, so it is for few terms; validate_terms() takes any number.
    """
    known = _verdicts(terms)
    if len(known) > MOST_INLINE:
        raise ValueError(f"{len(known)} terms: more than {MOST_INLINE} don't fit into an expression, see validate_terms()")
    verdict = lambda ok, to, how: F.struct(F.lit(ok).alias("valid"), F.lit(to).alias("suggestion"), F.lit(how).alias("confidence"))
    out = verdict(True, "", "low")
    for name, *x in known:
        out = F.when(term == name, verdict(*x)).otherwise(out)
    return out


def term_table(spark: SparkSession, terms: Terms | DataFrame) -> DataFrame:
    """_term, _verdict: each known term once. Terms may be a table (canonical, pattern) as read_dictionary() gives it, of any size; of a pattern's several canonical terms the smallest is suggested."""
    if not isinstance(terms, DataFrame):
        rows = [(name, (ok, to, how)) for name, ok, to, how in _verdicts(terms)]
        return spark.createDataFrame(rows, f"_term string, _verdict {_VERDICT}")
    verdict = lambda ok, to, how: F.struct(F.lit(ok).alias("valid"), to.alias("suggestion"), how.alias("confidence"))
    names = terms.select(F.col("canonical").alias("_term"), verdict(True, F.lit(""), F.lit("high")).alias("_verdict")).filter("_term <> ''")
    usable = terms.filter((F.col("canonical") != "") & (F.col("pattern") != F.col("canonical")) & (F.length("pattern") >= LEAST_LENGTH))
    sure = F.when(F.length("canonical") == F.length("pattern"), "high").otherwise("medium")
    slips = usable.select(F.col("pattern").alias("_term"), verdict(False, F.col("canonical"), sure).alias("_verdict"))
    # Of a term's verdicts a valid one comes first.
    return names.unionByName(slips).groupBy("_term").agg(F.min_by("_verdict", F.struct(~F.col("_verdict.valid"), F.col("_verdict.suggestion"))).alias("_verdict"))


def validate_terms(rows: DataFrame, terms: Terms | DataFrame = SHIPPED, term_col: str = "term") -> DataFrame:
    """Adds valid, suggestion, confidence to each row, as validate_term() gives them.

    The dictionary is joined, so plan and time don't grow with it; Spark broadcasts it only where its size allows. A
    null term is unknown.
    """
    known = term_table(rows.sparkSession, terms)
    unknown = F.struct(F.lit(True).alias("valid"), F.lit("").alias("suggestion"), F.lit("low").alias("confidence"))
    joined = rows.join(known, rows[term_col] == known["_term"], "left").withColumn("_verdict", F.coalesce(known["_verdict"], unknown))
    return joined.select(*[rows[c] for c in rows.columns if c not in ("valid", "suggestion", "confidence")], "_verdict.*")


def question_fields(questions: DataFrame, wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """chunk_id, pos, id, field, value: a question's text, then each option's text and explanation; of these the values wanted (all, if not given)."""
    each = questions.select("chunk_id", "pos", "id", "text", F.posexplode_outer("options").alias("k", "o"))
    # Exploded before anything is looked at, so that Spark compiles it all; with its first option comes the question's own text.
    field = lambda num, kind, there, value: F.struct(num.alias("num"), F.lit(kind).alias("kind"), F.when(there, F.coalesce(value, F.lit(""))).alias("value"))
    own = field(F.lit(None).cast("string"), "text", F.coalesce("k", F.lit(0)) == 0, F.col("text"))
    parts = [field(F.coalesce(F.col("o.num").cast("string"), F.lit("")), kind, F.col("k").isNotNull(), F.col(f"o.{kind}")) for kind in ("text", "explanation")]
    each = each.select("chunk_id", "pos", "id", F.explode(F.array(own, *parts)).alias("f")).filter("f.value is not null")
    if wanted is not None:
        each = each.filter(wanted(F.col("f.value")))
    name = F.when(F.col("f.num").isNull(), F.col("f.kind")).otherwise(F.concat(F.lit("option_"), F.col("f.num"), F.lit("_"), F.col("f.kind")))
    return each.select("chunk_id", "pos", "id", name.alias("field"), "f.value")


def _field_hits(questions: DataFrame, index: Sequence[tuple[str, str]]) -> DataFrame:
    """question_fields() with each hit h. Where few patterns are looked for, only fields that hold one go to the scan."""
    held = lambda value: reduce(lambda any_, x: any_ | F.contains(value, F.lit(x[1])), index, F.lit(False))
    fields = question_fields(questions, held if len(index) <= FEW else None)
    return fields.withColumn("h", F.explode(scan(F.col("value"), index)))


def post_verify(questions: DataFrame, terms: Terms = SHIPPED) -> DataFrame:
    """chunk_id, pos, question_id, field, found, expected, severity: what a result still holds of the misspellings that pre_correct() mends."""
    fields = _field_hits(questions, pattern_index(terms))
    severity = F.when(F.col("h.confidence") == "high", "high").otherwise("medium")
    return fields.select("chunk_id", "pos", F.col("id").alias("question_id"), "field", F.col("h.original").alias("found"), F.col("h.canonical").alias("expected"), severity.alias("severity"))


def term_issues(questions: DataFrame, terms: Terms = SHIPPED) -> DataFrame:
    """One issue per misspelling in a result: ERROR where the length is the canonical one, else WARNING."""
    fields = _field_hits(questions, pattern_index(terms, obvious_only=False))
    return fields.select(
        "chunk_id", F.lit("term").alias("source"), F.lit("TYPO_REGRESSION").alias("issue_type"),
        F.when(F.col("h.confidence") == "high", "ERROR").otherwise("WARNING").alias("severity"), F.col("id").alias("question_id"), "pos",
        F.concat(F.lit("question_"), F.col("id").cast("string"), F.lit(", "), F.col("field")).alias("location"), F.lit("").alias("option_num"),
        F.col("h.original").alias("term"), F.col("h.canonical").alias("suggestion"), F.col("h.original").alias("detail"),
    )
