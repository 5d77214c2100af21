"""Blocks, headers, chunks, metrics, hints and dictionary terms against worked-out results."""

import math
import random

import pytest
from pyspark.sql import functions as F

from docloom.functions.text import MEASURES, estimated_tokens, with_text_metrics
from docloom.operators import blocks, chunks, dictionary, hints
from docloom.plans.queries import dry_run
from docloom.sources import readers, writers

#: Two pages of an exam text, with a misspelling in the first question.
EXAM = {
    "exam": [
        [
            "민법 기출문제", "문1. 다음 게약에 관한 설명으로 옳은 것은?", "① 청약은 철회할 수 있다.", "② 승낙은 청약과 일치해야 한다.", "③ 무효이다.", "④ 취소이다.", "[해설] 정답은 ②이다.",
            "문2. 물권에 관한 설명은?", "① 채권보다 우선한다.", "② 등기가 필요하다.", "③ 소멸한다.", "④ 이전한다.",
        ],
        ["문3. 채권의 목적은?", "① 금전", "② 행위", "③ 물건", "④ 권리", "문4. 상속의 순위는?", "① 직계비속", "② 배우자", "③ 형제", "④ 국가", "[해설] 정답은 ①이다."],
    ],
    "parens": [["(1) 다음 도시의 이름은?"], ["(2) 그 강의 길이는?"], ["(3) 산의 높이는?"]],
    "dots": [["1. 다음 도시의 이름은?"], ["2. 그 강의 길이는?"], ["3. 산의 높이는?"]],
    "bare": [["둘째 마당 3 나 무", "3 문41"], ["3 문42", "소나무의 잎에 대한 말로 맞는 것은?"], ["3 문43", "참나무의 열매는 무엇인가?"]],
    "prose": [["오늘 항구에서 배를 보았다.", "바람은 없었다."], ["길이 이어진다.", "집으로 돌아왔다."]],
}

CASES = {
    "prefix": ([["둘째 마당 3 나 무", "3 문41"], ["3 문42", "소나무의 잎에 대한 말로 맞는 것은?"], ["3 문43", "끝"]], [41, 42, 43], "문{N}."),
    "bare": ([["문1", "첫째"], ["문2", "둘째"], ["문3", "셋째"]], [1, 2, 3], "문{N}."),
    "suffix": ([["문1. 요건이 아닌 것은?"], ["문2) 차이는?"], ["문3. 사유는?"]], [1, 2, 3], "문{N}."),
    "paren": ([["(1) 다음 도시의 이름은?"], ["(2) 그 강의 길이는?"], ["(3) 산의 높이는?"]], [1, 2, 3], "({N})"),
    "dot": ([["1. 문제"], ["2. 문제"], ["3. 문제"]], [1, 2, 3], "{N}."),
    "bracket": ([["【1】 가", "【2】 나"]], [1, 2], "【{N}】"),
    "prose": ([["문항을 읽는다", "질문이 있다"], ["본문이다", "주문이다"]], [], None),
    "one": ([["문1. 하나"]], [], None),
    "tight": ([["문1.", "문2)x"]], [], None),
}


def test_headers(spark):
    placed = blocks.block_offsets(blocks.from_rows(spark, {k: v[0] for k, v in CASES.items()}))
    found = blocks.detect_headers(placed).orderBy("char_start").collect()
    for name, (pages, ids, form) in CASES.items():
        own = [r for r in found if r["doc_id"] == name]
        assert [r["question_id"] for r in own] == ids and {r["format"] for r in own} == ({form} if form else set())
        whole = "".join(x + "\n\n" for p in pages for x in p)
        for r in own:
            assert whole[r["char_start"] : r["char_end"]].strip() == r["text"]
            assert r["page"] == next(i for i, p in enumerate(pages) if r["text"].strip() in "\n".join(p))


@pytest.mark.parametrize(("numbers", "rising"), [([65, 66, 67, 68], True), ([65, 66, 64, 68], True), ([10, 3, 55, 2, 900, 1], False), ([5], False), ([501, 502], False), ([500, 501], True)])
def test_sequences(spark, numbers, rising):
    rows = spark.createDataFrame([("d", 0, n, i) for i, n in enumerate(numbers)], "doc_id string, priority int, question_id int, char_start long")
    assert blocks.is_rising(rows).first()["rising"] is rising


def test_pages_of_offsets(spark):
    placed = blocks.block_offsets(blocks.from_rows(spark, {"d": [["ab", "c"], ["def"]]}))
    asked = spark.createDataFrame([("d", i) for i in (0, 3, 4, 6, 7, 99)] + [("none", 5)], "doc_id string, offset long")
    got = {(r["doc_id"], r["offset"]): r["page"] for r in blocks.page_of_offset(asked, placed).collect()}
    assert got == {("d", 0): 0, ("d", 3): 0, ("d", 4): 0, ("d", 6): 0, ("d", 7): 1, ("d", 99): 1, ("none", 5): 0}


def test_packing(spark):
    rng = random.Random(3)
    cases = {"a": [3, 4, 5, 2], "b": [3, 9, 2, 2], "c": [9, 9], "d": [7, 1]} | {f"r{k}": [rng.randrange(1, 12) for _ in range(40)] for k in range(10)}
    rows = spark.createDataFrame([(d, i, t) for d, ts in cases.items() for i, t in enumerate(ts)], "doc_id string, ord int, tokens int")
    got = {(r["doc_id"], r["ord"]): r["chunk_no"] for r in chunks.pack_segments(rows, 7).collect()}
    for name, tokens in cases.items():
        made, open_ = [], []
        for i, t in enumerate(tokens):
            if t > 7:
                made += [open_] * bool(open_) + [[i]]
                open_ = []
            elif open_ and sum(tokens[k] for k in open_) + t > 7:
                made.append(open_)
                open_ = [i]
            else:
                open_.append(i)
        made += [open_] * bool(open_)
        assert {i: n for n, part in enumerate(made, 1) for i in part} == {i: got[name, i] for i in range(len(tokens))}


def test_packing_of_a_document_of_a_million_segments(spark):
    rows = spark.range(1_000_000).select(F.lit("long").alias("doc_id"), F.col("id").alias("ord"), F.when(F.col("id") % 1000 == 0, 50).otherwise(F.col("id") % 7).cast("int").alias("tokens"))
    rows = rows.unionByName(rows.limit(0)).unionByName(spark.createDataFrame([("other", 1, None), ("other", 2, 41), ("other", 3, 0), ("other", 4, 40)], "doc_id string, ord long, tokens int"))
    packed = chunks.pack_segments(rows, 40)
    made = packed.filter("doc_id = 'long'").groupBy("chunk_no").agg(F.sum("tokens").alias("t"), F.count("*").alias("n"), F.min("ord").alias("first")).orderBy("chunk_no").collect()
    assert [r["chunk_no"] for r in made] == list(range(1, len(made) + 1)) and sum(r["n"] for r in made) == 1_000_000
    assert all(r["t"] <= 40 or r["n"] == 1 for r in made)
    # Next-fit: what opens a chunk didn't fit into the one before.
    tokens = lambda i: 50 if i % 1000 == 0 else i % 7
    assert all(a["t"] + tokens(b["first"]) > 40 for a, b in zip(made, made[1:]))
    assert [r["chunk_no"] for r in packed.filter("doc_id = 'other'").orderBy("ord").collect()] == [1, 2, 3, 3]
    assert chunks.pack_segments(rows.limit(0)).count() == 0


def test_dry_run(spark):
    made, hinted = dry_run(blocks.block_offsets(blocks.from_rows(spark, EXAM)))
    exam = made.filter("doc_id = 'exam'").collect()
    assert len(exam) == 1 and (exam[0]["lo"], exam[0]["hi"], exam[0]["pages"], exam[0]["chunk_id"]) == (1, 4, [0, 1], "chunk_001")
    assert "민법 기출문제" not in exam[0]["text"]
    hint = hinted.filter("doc_id = 'exam'").first()
    assert (hint["symbol"], hint["marker"], hint["options_per_question"], hint["has_explanation"]) == ("circled", "[해설]", 4, True)
    assert [tuple(b) for b in hint["special_blocks"]] == [("multi_page", "questions_1-4")]
    fixed = dictionary.pre_correct(made.filter("doc_id = 'exam'")).first()
    assert [(c["original"], c["canonical"], c["confidence"]) for c in fixed["corrections"]] == [("게약", "계약", "high")]
    assert "계약" in fixed["corrected_text"] and "게약" not in fixed["corrected_text"]


def test_hints_are_read_as_they_were_written(spark, tmp_path):
    _, hinted = dry_run(blocks.block_offsets(blocks.from_rows(spark, EXAM)))
    writers.write_json(hinted.coalesce(1), str(tmp_path / "hints"))
    back = readers.read_hints(spark, str(tmp_path / "hints"))
    assert back.columns == hinted.columns and hinted.count() > 1
    show = lambda rows: sorted(repr(r.asDict(recursive=True)) for r in rows.collect())
    assert show(back) == show(hinted.withColumn("doc_id", F.col("doc_id").cast("string")))
    (tmp_path / "one.json").write_text('{\n "chunk_id": "chunk_001",\n "q_start": 3\n}')
    assert readers.read_hints(spark, str(tmp_path / "one.json"), lines=False).first()["q_start"] == 3
    for broken in ("{oops", '{"other": 1}'):
        (tmp_path / "bad.json").write_text(broken)
        with pytest.raises(Exception, match="no hint"):
            readers.read_hints(spark, str(tmp_path / "bad.json")).collect()


def test_manifest_ties(spark):
    rows = spark.createDataFrame([("d", 1, "chunk_001", 5, 1), ("d", 2, "chunk_002", 7, 2), ("d", 3, "chunk_003", 7, 1), ("d", 4, "chunk_004", 5, 1)], "doc_id string, chunk_no int, chunk_id string, tokens int, question_count int")
    r = chunks.manifest(rows).first()
    assert (r["max_chunk"], r["min_chunk"], r["avg_tokens"], r["total_questions"]) == ("chunk_002", "chunk_001", 6.0, 5)


def test_metrics(spark):
    text = "계약a  b\n\n 가나 12 □　끝"
    rows = with_text_metrics(spark.createDataFrame([(text,), ("",), (None,)], "t string").withColumn("tokens", estimated_tokens(F.col("t"))), "t").collect()
    n = len(text)
    r = rows[0]
    assert r["total_chars"] == n and r["unique_chars"] == len(set(text)) and r["tokens"] == math.ceil(n / 2)
    assert r["broken_char_ratio"] == round(1 / n, 4) and r["excessive_space_ratio"] == round(2 / n, 4) and r["mixed_encoding_ratio"] == round(1 / 6, 4)
    lines = [x for x in text.split("\n") if x.strip()]
    assert r["avg_line_length"] == round(sum(map(len, lines)) / len(lines), 1) and r["empty_lines_ratio"] == round(1 / 3, 4)
    for zero in rows[1:]:
        assert not any(zero[name] for name in MEASURES)


def test_hint_parts(spark):
    rows = [("① a\n② b\n③ c\n①d", "circled", 2, 2), ("① a\n② b\n③ c", "circled", 2, 2), ("ㄱ. a\nㄴ) b", "korean", 0, 0), ("x", "numeric", 3, 5), ("1. a\n2. b\n3. c\n4. d\n5. e", "numeric", 2, 2)]
    out = spark.createDataFrame(rows, "t string, s string, q int, want int").select("want", hints.options_per_question(F.col("t"), F.col("s"), F.col("q")).alias("got")).collect()
    assert [r["got"] for r in out] == [2, 2, 0, 5, 2]


def test_terms(spark):
    terms = (("abc", "abd"), ("xyz", "bdx"), ("long", "abdxq"), ("aaa", "aa"))
    rows = spark.createDataFrame([("abd abdx bdx abdxqz aaaaa",), (None,)], "text string")
    r, empty = dictionary.pre_correct(rows, terms).collect()
    # bdx differs from xyz in more than a character and isn't looked for; aa overlaps itself.
    assert [(c["start"], c["original"]) for c in r["corrections"]] == [(0, "abd"), (4, "abd"), (13, "abdxq"), (20, "aa"), (22, "aa")]
    assert r["corrected_text"] == "abc abcx bdx longz aaaaaaa" and empty["corrected_text"] == ""
    plain = dictionary.pre_correct(rows, terms[:3]).first()
    assert [(c["start"], c["original"]) for c in plain["corrections"]] == [(0, "abd"), (4, "abd"), (13, "abdxq")]
    assert plain["corrected_text"] == "abc abcx bdx longz aaaaa"
    assert dictionary.pre_correct(rows, terms, enabled=False).first()["corrected_text"] == "abd abdx bdx abdxqz aaaaa"
    assert len(dictionary.pattern_index(dictionary.LEGAL_TERMS)) == 18
    got = {r["t"]: tuple(r["v"]) for r in spark.createDataFrame([("계약",), ("물구권",), ("모름",)], "t string").select("t", dictionary.validate_term(F.col("t")).alias("v")).collect()}
    assert got == {"계약": (True, "", "high"), "물구권": (False, "물권", "medium"), "모름": (True, "", "low")}


def test_exam_is_used():
    assert set(EXAM) >= {"exam", "bare"}
