"""What workers hold and what plans repeat: neither grows faster than the input."""

import os
import random
import re
import time
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.functions.batches import slices
from docloom.functions.matching import similarities
from docloom.llm.language_id import known_language
from docloom.operators import chunks, dictionary, responses, scoring, validation
from docloom.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan_of(spark, frame):
    """The physical plan with exchanges that are used again marked as such."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return re.sub(r"#\d+L?", "", frame._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_many_pairs_take_the_memory_of_few():
    r = random.Random(3)
    text = lambda n: " ".join(r.choice(["part", "option", "longer", "returned", "5-LOW"]) for _ in range(n))
    firsts, seconds = [text(70) for _ in range(1500)], [text(200) for _ in range(1500)]
    tracemalloc.start()
    similarities(firsts, seconds)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6


def test_slices_of_batches():
    texts, lists = ["x" * 40_000] * 100 + [None, "", "y" * 500_000], [["ab", None], None, []] + [["c" * 30_000]] * 100
    parts = list(slices([(pa.array(texts), pa.array(lists, pa.list_(pa.string()))), (pa.array([], pa.string()), pa.array([], pa.list_(pa.string())))], 200_000))
    assert [t for part, _ in parts for t in part] == texts and [x for _, part in parts for x in part] == lists
    assert all(len(a) == 1 or sum(len(t or "") for t in a) + sum(len(w or "") for x in b for w in x or ()) <= 200_000 for a, b in parts)
    some = pa.array(lists, pa.list_(pa.string())).slice(2, 5)
    assert [x for (part,) in slices([(some,)], 50_000) for x in part] == lists[2:7]


def test_udfs_over_batches_of_several_slices(spark):
    rows = spark.range(3000).select("id", F.concat(F.repeat(F.lit("inou thre "), (F.col("id") % 200).cast("int")), F.col("id").cast("string")).alias("text")).coalesce(1)
    fixed = dictionary.pre_correct(rows, (("there", "thre"), ("inyou", "inou")))
    wrong = (F.size("corrections") != 2 * (F.col("id") % 200)) | (F.col("corrected_text") != F.replace(F.replace("text", F.lit("thre "), F.lit("there ")), F.lit("inou "), F.lit("inyou ")))
    assert fixed.filter(wrong).count() == 0 and fixed.count() == 3000
    words = F.array(F.lit("thre"), F.col("id").cast("string"), F.lit("none"))
    lost = rows.select("id", dictionary.absent_words(words, F.col("text")).alias("lost")).collect()
    assert all(r["lost"] == (["none"] if r["id"] % 200 else ["thre", "none"]) for r in lost)
    pairs = rows.select("id", F.col("text").alias("original"), F.col("text").alias("result"))
    assert validation.similarity(pairs).filter("similarity <> 1").count() == 0


def test_counted_issues_score_like_the_issues(spark):
    r = random.Random(4)
    kinds = [("structure", "A", "ERROR"), ("structure", "B", "WARNING"), ("diff", "C", "ERROR"), ("term", "D", "WARNING")]
    issues = spark.createDataFrame([(r.choice([1, 2, 3, None]), *r.choice(kinds)) for _ in range(60)], "chunk_id long, source string, issue_type string, severity string")
    ids = spark.createDataFrame([(1,), (2,), (3,), (9,)], "chunk_id long")
    show = lambda x: sorted(map(tuple, x.collect()))
    assert show(scoring.confidence(ids, scoring.counted(issues))) == show(scoring.confidence(ids, issues))
    assert show(scoring.error_breakdown(scoring.counted(issues))) == show(scoring.error_breakdown(issues)) == show(issues.groupBy("issue_type").count())


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", ["x4_statistics_rows", "x4_whole_statistics_rows"])
def test_scores_and_breakdown_share_one_run_of_the_checks(spark, name):
    assert re.search(r"ReusedExchange \[chunk_id, source, issue_type, severity", plan_of(spark, QUERIES[name](spark, SF)))


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the driver's tables")
@pytest.mark.parametrize(("name", "times"), [("x1_option_rows", 1), ("x1_whole_option_rows", 1), ("x3_whole_review_rows", 1), ("k2_whole_deductions", 2)])
def test_questions_are_made_once_for_all_checks_and_rows(spark, name, times):
    """Orders meet their lines once, or twice where issues of null chunks are asked for, which the join with the originals leaves out; further readers take the shuffle by chunk."""
    frame = QUERIES[name](spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = frame.select("*")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(re.findall(r"Left keys \[1\]: \[o_orderkey#", plan)) == times


def test_chunks_without_a_name_are_no_chunk_zero(spark):
    ids = spark.createDataFrame([(0,), (None,)], "chunk_id long")
    issues = spark.createDataFrame([(0, "diff", "ERROR"), (None, "diff", "ERROR")], "chunk_id long, source string, severity string")
    scores = sorted(tuple(r) for r in scoring.confidence(ids, issues).filter("chunk_id is not null").select("chunk_id", "score").collect())
    assert scores == [(0, 0.7)] and scoring.confidence(ids, issues).count() == 2


def test_odd_lengths_of_very_many_options(spark):
    n = 20_000
    rows = spark.range(1).select(F.lit("c").alias("chunk_id"), F.lit(0).alias("pos"), F.lit(1).alias("id"), F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.struct(k.cast("string").alias("num"), F.when(k % 1000 > 0, F.lit("twelve chars")).otherwise("ab").alias("text"))).alias("options"))
    began = time.time()
    assert sorted(int(r["option_num"]) for r in validation.issues(rows, validation.odd_lengths()).collect()) == list(range(1000, n + 1, 1000))
    assert time.time() - began < 10


def test_checks_by_plain_python(spark):
    """Random questions with nulls, blanks and repetitions, dealt by chunk or not."""
    r = random.Random(6)
    texts = [None, "", " ", "\u3000", "a", " a", "RF", "동일", "an optoin of part", "a longer option of part 7", "art"]
    option = lambda: (r.choice([None, "", "\t", "1", "2"]), r.choice(texts), r.choice([None, "true", "false", "O"]), r.choice([None, "", "x", "RF art"]))
    rows = [(r.choice([1, 2, None]), i, r.randrange(9), r.choice(texts), r.choice([None, [], [option() for _ in range(r.randrange(7))]])) for i in range(300)]
    made = spark.createDataFrame(rows, "chunk_id long, pos int, id long, text string, options array<struct<num: string, text: string, correct: string, explanation: string>>")
    want, results = Counter(), {}
    for chunk, pos, _, text, options in rows:
        options = options or []
        held, values = [(t or "").strip() for _, t, _, _ in options], [c or "" for _, _, c, _ in options]
        add = lambda kind, detail, num="": want.update([(chunk, pos, kind, str(detail), num or "")])  # noqa: B023, E731
        for t in {t for t in held if held.count(t) > 1 and t not in ("", "동일")}:
            add("TEXT_DUPLICATED", t)
        if values.count("true") != 1:
            add("MULTIPLE_CORRECT_ANSWERS" if "true" in values else "NO_CORRECT_ANSWER", values.count("true"))
        if not (text or "").strip():
            add("EMPTY_QUESTION_TEXT", "")
        if not options:
            add("EMPTY_OPTIONS", "")
        mean = sum(len(t or "") for _, t, _, _ in options) / len(options) if len(options) > 1 else 0
        for (num, t, _, _), value in zip(options, values, strict=True):
            if value not in ("true", "false"):
                add("INVALID_CORRECT_VALUE", value, num)
            if not (num or "").strip():
                add("EMPTY_OPTION_NUM", "", num)
            if not (t or "").strip():
                add("EMPTY_OPTION_TEXT", "", num)
            if mean >= 10 and len(t or "") < 0.3 * mean:
                add("LENGTH_ANOMALY", len(t or ""), num)
        results.setdefault(chunk, []).append((pos, " ".join(x for x in [text, *[y for o in options for y in (o[1], o[3])]] if x)))
    fields = Counter()
    for chunk, pos, _, text, options in rows:
        for name, value in [("text", text), *[(f"option_{o[0] or ''}_{kind}", o[k]) for o in options or [] for kind, k in (("text", 1), ("explanation", 3))]]:
            fields[chunk, pos, name, value or ""] += 1
    for questions in (made, validation.dealt(made)):
        found = validation.issues(questions, *validation.question_checks(), validation.odd_lengths()).collect()
        assert Counter((x["chunk_id"], x["pos"], x["issue_type"], x["detail"], x["option_num"]) for x in found) == want
        got = dictionary.question_fields(questions).collect()
        assert Counter((x["chunk_id"], x["pos"], x["field"], x["value"]) for x in got) == fields
        hits = dictionary.question_fields(questions, lambda v: F.contains(v, F.lit("art"))).collect()
        assert Counter((x["chunk_id"], x["pos"], x["field"], x["value"]) for x in hits) == Counter({k: n for k, n in fields.items() if "art" in k[3]})
        pairs = validation.compared(questions, spark.createDataFrame([(1, "o"), (2, "o"), (3, "o")], "chunk_id long, original string")).collect()
        assert {x["chunk_id"]: x["result"] for x in pairs} == {c: " ".join(t for _, t in sorted(results.get(c, [])) if t) for c in (1, 2, 3)}
        assert sorted(map(repr, questions.collect())) == sorted(map(repr, made.collect()))


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the driver's tables")
def test_texts_are_scanned_once_for_the_log(spark):
    assert plan_of(spark, QUERIES["d3_term_scan"](spark, SF)).count("ArrowEvalPython") == 1


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the driver's tables")
def test_languages_take_texts_alone_to_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = plan_of(spark, known_language(spark, docs))
    assert "MapInArrow" not in plan and plan.count("ArrowEvalPython [judged(text)]") == 1


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the driver's tables")
def test_prompts_shuffle_the_blocks_and_the_chunks_once(spark):
    plan = plan_of(spark, QUERIES["l1_prompts"](spark, SF))
    assert len(re.findall(r"[^d]Exchange hashpartitioning\(doc_id, \d+\)[^\n]*\n[^\n]*Project \[doc_id, block_id[^\n]* text", plan)) == 1
    assert re.search(r"ReusedExchange \[doc_id, text, chunk_id\]", plan)


def test_segments_window_holds_no_texts(spark):
    headers = spark.createDataFrame([(1, "f", 1, 0, "a", 0, 1), (1, "f", 2, 1, "b", 6, 7)], "doc_id long, format string, question_id int, page int, text string, char_start long, char_end long")
    cut = chunks.segments(spark.createDataFrame([(1, "1. ab\n2. cd\n\n")], "doc_id long, full_text string"), headers)
    assert [(r["ord"], r["text"]) for r in cut.orderBy("ord").collect()] == [(1, "1. ab"), (2, "2. cd")]
    plan = plan_of(spark, cut)
    assert plan.index("Join") < plan.index("Window")  # the join stands above


def test_truncation_as_a_fold_over_characters(spark):
    def folded(text):
        depth, quoted, escaped = 0, False, False
        for c in text:
            if not quoted:
                depth += (c in "{[") - (c in "}]")
            now = quoted and not escaped and c == "\\"
            quoted, escaped = quoted != (c == '"' and not escaped), now
        return depth != 0 or quoted or not re.search(r"[}\]]\Z", text.strip())

    r = random.Random(8)
    texts = ["".join(r.choice('{}[]"\\a\n😀') for _ in range(r.randrange(14))) for _ in range(4000)] + ['{"' + '\\"' * 200_000 + '"}', '{"' + '\\"' * 200_000 + "}"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", responses.is_truncated(F.col("t")).alias("cut")).collect()
    assert [x["t"] for x in got if x["cut"] != folded(x["t"])] == []
    assert spark.range(1).select(responses.is_truncated(F.lit(None).cast("string"))).first()[0] is None
