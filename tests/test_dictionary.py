"""Scanning with and looking up in dictionaries of any size, against plain search."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from docloom.operators import dictionary, validation
from docloom.operators.dictionary import Dictionary, Scanner


def plain_hits(text, index):
    """Pattern after pattern, left to right, whatever overlaps an earlier hit left out."""
    used, out = [], []
    for canonical, pattern in index:
        at = text.find(pattern)
        while at >= 0:
            stop = at + len(pattern)
            if not any(a < stop and at < b for a, b in used):
                used.append((at, stop))
                out.append((at, stop, pattern, canonical))
            at = text.find(pattern, stop)
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_random_dictionaries_scan_as_plain_search_does(seed):
    r = random.Random(seed)
    letters = ["ab", "abc", "가나다 ", "😀a\n"][seed]
    word = lambda most: "".join(r.choice(letters) for _ in range(r.randrange(2, most)))
    for _ in range(300):
        pairs = [(word(6), word(6)) for _ in range(r.randrange(1, 12))]
        index = dictionary.pattern_index(pairs, obvious_only=False)
        s, text = Scanner(index), "".join(r.choice(letters) for _ in range(r.randrange(80)))
        found = s.hits(text)
        assert [(a, b, s.index[k][1], s.index[k][0]) for a, b, k in found] == plain_hits(text, index)
        expected, at = "", 0
        for a, b, _, canonical in plain_hits(text, index):
            expected, at = expected + text[at:a] + canonical, b
        assert s.corrected(text, found) == expected + text[at:]


def large_dictionary(n):
    r = random.Random(n)
    words = set()
    while len(words) < n:
        words.add("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(4, 12))))
    return Dictionary(tuple(f"C{w}" for w in sorted(words)), tuple((f"C{w}", w) for w in sorted(words)))


def test_ten_thousand_patterns_over_documents(spark):
    terms = large_dictionary(10_000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fixed = dictionary.pre_correct(docs, terms)
    rows = fixed.select("text", "corrected_text", F.size("corrections").alias("n")).collect()
    assert fixed.columns == [*docs.columns, "corrections", "corrected_text"] and sum(r["n"] for r in rows) > 100
    index = dictionary.pattern_index(terms)
    row = min((r for r in rows if r["n"]), key=lambda r: len(r["text"]))
    assert row["n"] == len(plain_hits(row["text"], index))
    began = time.time()
    s = Scanner(index)
    s.hits(max((r["text"] or "" for r in rows), key=len) * 20)
    assert time.time() - began < 20


def test_a_text_full_of_hits_takes_linear_time():
    s = Scanner(dictionary.pattern_index([("ba", "ab"), ("bc", "cb")], obvious_only=False))
    began = time.time()
    assert len(s.hits("ab" * 300_000)) == 300_000
    assert time.time() - began < 5


def test_ten_thousand_terms_are_looked_up(spark):
    terms = large_dictionary(10_000)
    some = [terms.names[5], terms.pairs[7][1], "neither", None, ""]
    rows = spark.createDataFrame([(t, 1) for t in some], "term string, verdict int")
    expected = {(some[0], True, "", "high"), (some[1], False, terms.pairs[7][0], "medium"), ("neither", True, "", "low"), (None, True, "", "low"), ("", True, "", "low")}
    for known in (terms, spark.createDataFrame(list(terms.pairs), "canonical string, pattern string")):
        got = dictionary.validate_terms(rows, known)
        assert got.columns == ["term", "verdict", "valid", "suggestion", "confidence"]
        assert {(r["term"], r["valid"], r["suggestion"], r["confidence"]) for r in got.collect()} == expected
    with pytest.raises(ValueError):
        dictionary.validate_term(F.col("term"), terms)
    text = spark.createDataFrame([(" ".join(terms.names[:50]),), (None,), ("",)], "t string")
    held = [r[0] for r in text.select(dictionary.canonical_terms(F.col("t"), terms)).collect()]
    assert set(terms.names[:50]) <= set(held[0]) == {n for n in terms.names if n in " ".join(terms.names[:50])} and held[0] == sorted(held[0]) and held[1] is None and held[2] == []


def test_expression_and_join_give_the_same_verdicts(spark):
    words = [c for pair in dictionary.LEGAL_TERMS for c in pair] + list(dictionary.CANONICAL_TERMS) + ["모름"]
    rows = spark.createDataFrame([(w,) for w in sorted(set(words))], "term string")
    inline = rows.select("term", dictionary.validate_term(F.col("term")).alias("v")).select("term", "v.*")
    assert sorted(map(tuple, inline.collect())) == sorted(map(tuple, dictionary.validate_terms(rows).collect()))


def test_a_table_with_several_canonical_terms_of_a_pattern(spark):
    table = spark.createDataFrame([("b", "xx"), ("a", "xx"), ("xx", "yy"), ("c", None), (None, "zz"), ("d", "q")], "canonical string, pattern string")
    got = {r["term"]: (r["valid"], r["suggestion"]) for r in dictionary.validate_terms(spark.createDataFrame([(t,) for t in ("xx", "yy", "c", "zz", "q")], "term string"), table).collect()}
    assert got == {"xx": (True, ""), "yy": (False, "xx"), "c": (True, ""), "zz": (True, ""), "q": (True, "")}


def test_many_patterns_in_results(spark):
    terms = large_dictionary(200)
    questions = spark.createDataFrame([("k", 0, 1, f"has {terms.pairs[3][1]} here", None), ("k", 1, 2, None, None)], "chunk_id string, pos int, id long, text string, options array<struct<num:string,text:string,correct:boolean,explanation:string>>")
    found = dictionary.post_verify(questions, terms).collect()
    assert (found[0]["found"], found[0]["expected"], found[0]["field"]) == (terms.pairs[3][1], terms.pairs[3][0], "text") and dictionary.term_issues(questions, terms).count() == len(found)


def test_lost_keywords_in_one_pass(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("ab가1") for _ in range(r.randrange(1, 6)))
    rows = [(" ".join(word() for _ in range(30)), " ".join(word() for _ in range(20)), 0) for _ in range(60)] + [("abc abd", "", 0), ("", "x", 0), ("a b", "c", 0)]
    pairs = spark.createDataFrame(rows, "original string, result string, n_options long").withColumn("chunk_id", F.monotonically_increasing_id())
    got = {x["chunk_id"]: x["detail"] for x in validation.issues(pairs, validation.lost_keywords()).collect()}
    for row in pairs.collect():
        words = list(dict.fromkeys(re.findall(validation.KEYWORD, row["original"])))
        lost = [w for w in words if w not in row["result"]]
        expected = ", ".join(sorted(lost)[:10]) if words and len(lost) / len(words) > validation.MOST_LOST else None
        assert got.get(row["chunk_id"]) == expected
    # 60,000 keywords that are only parts of one long word, and none of 60,000 others.
    many = [f"w{i:06d}" for i in range(60_000)]
    large = spark.createDataFrame([(1, " ".join(many + [f"v{i:06d}" for i in range(60_000)]), "x".join(many), 0)], "chunk_id long, original string, result string, n_options long")
    began = time.time()
    assert [x["detail"] for x in validation.issues(large, validation.lost_keywords()).collect()] == [", ".join(f"v{i:06d}" for i in range(10))]
    assert time.time() - began < 30
