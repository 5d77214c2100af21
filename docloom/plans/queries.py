"""The registered queries of the document and data-quality operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import with_text_metrics
from docloom.operators import blocks, chunks, convert, dictionary, hints, responses, scoring, sheets, states, validation
from docloom.plans.adapters import event_log, exam_blocks, line_segments, order_answers, order_questions, table

Query = Callable[[SparkSession, str], DataFrame]
MAX_TOKENS = 200
WORDS = (("there", "thre"), ("inyou", "inou"), ("handed", "haned"))
TERMS = (("option", "optoin"), ("returned", "RF"), ("part", "art"))


def m0_text_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text_metrics(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def p1_block_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = blocks.block_offsets(blocks.line_blocks(table(spark, sf_dir, "documents")))
    return placed.select("doc_id", "block_id", "page", "char_start", "char_end")


def p2_full_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = blocks.full_text(blocks.line_blocks(table(spark, sf_dir, "documents")))
    return whole.select("doc_id", F.length("full_text").cast("long").alias("n_chars"), F.sha2(F.col("full_text").cast("binary"), 256).alias("sha256"))


def r3_page_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    placed = blocks.block_offsets(blocks.line_blocks(documents))
    offsets = documents.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.length(F.coalesce("text", F.lit(""))).cast("long"), F.lit(500).cast("long"))).alias("offset"))
    return blocks.page_of_offset(offsets, placed)


def _exam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.block_offsets(exam_blocks(table(spark, sf_dir, "documents")))


def r1_header_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.detect_headers(_exam(spark, sf_dir))


def r2_header_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.is_rising(blocks.header_candidates(_exam(spark, sf_dir)))


def r4_option_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.option_symbol_type(_exam(spark, sf_dir))


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.pack_segments(line_segments(table(spark, sf_dir, "documents")), MAX_TOKENS)


def c3_packed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir).select("doc_id", "ord", "tokens", "chunk_no")


def c4_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chunks.chunks(_packed(spark, sf_dir))
    return made.select("doc_id", "chunk_id", "lo", "hi", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), "tokens", "question_count", F.array_join("pages", ",").alias("pages"), "char_start", "char_end")


def c6_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.manifest(chunks.chunks(_packed(spark, sf_dir)))


def c7_headers_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = line_segments(table(spark, sf_dir, "documents"))
    made = chunks.chunks(chunks.pack_segments(parts, MAX_TOKENS))
    return chunks.headers_in_range(parts.select("doc_id", "question_id"), made).select("doc_id", "chunk_id", "question_id")


def dry_run(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks of the texts whose blocks these are, and their hints: the whole preparation without a converter."""
    headers = blocks.detect_headers(placed)
    made = chunks.chunks(chunks.pack_segments(chunks.segments(blocks.full_text(placed), headers)))
    return made, hints.hints(made, chunks.headers_in_range(headers, made), blocks.option_symbol_type(placed))


def c2_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _exam(spark, sf_dir)
    parts = chunks.segments(blocks.full_text(placed), blocks.detect_headers(placed))
    return parts.select("doc_id", "ord", "question_id", "page", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), "tokens", "char_start", "char_end")


def c5_without_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return chunks.without_headers(documents, blocks.detect_headers(blocks.block_offsets(exam_blocks(documents))))


def h1_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dry_run(_exam(spark, sf_dir))[1]
    special = F.array_join(F.transform("special_blocks", lambda b: F.concat(b["location"], F.lit(": "), b["type"])), ", ")
    return rows.withColumn("special_blocks", special).withColumn("pages", F.array_join("pages", ","))


def h3_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit(","), F.lit("|"))
    return table(spark, sf_dir, "documents").select("doc_id", hints.has_table(text).alias("has_table"))


def d2_pre_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = dictionary.pre_correct(table(spark, sf_dir, "documents"), WORDS)
    return fixed.select("doc_id", F.size("corrections").alias("n"), F.sha2(F.col("corrected_text").cast("binary"), 256).alias("sha256"))


def d3_term_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.correction_log(dictionary.pre_correct(table(spark, sf_dir, "documents"), WORDS), ["doc_id"])


def d6_post_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.post_verify(_questions(spark, sf_dir), TERMS)


def d7_canonical_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(dictionary.canonical_terms(F.coalesce(F.col("text"), F.lit("")), WORDS), ",").alias("terms"))


def d10_validate_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "[ \n]")).alias("term")).filter("term <> ''").distinct()
    return dictionary.validate_terms(words, WORDS)


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_answers(table(spark, sf_dir, "orders"))


def l9_classified_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, err = F.col("stdout"), F.col("stderr")
    kind = responses.classify_answer(out, err, F.col("exit_code"))
    return _answers(spark, sf_dir).select("chunk_id", kind.alias("kind"), responses.reset_epoch(out, err).alias("reset_at"), responses.unwrap(out).alias("result"))


def j1_extracted_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = responses.extract_json(F.col("stdout"))
    return _answers(spark, sf_dir).select("chunk_id", F.sha2(found.cast("binary"), 256).alias("sha256"), responses.is_truncated(found).alias("truncated"))


def j7_parsed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.array_join(F.transform("questions", lambda q: q["id"].cast("string")), ",")
    return responses.parse_answers(_answers(spark, sf_dir)).select("chunk_id", "ok", "recovered", F.col("error").isNotNull().alias("failed"), ids.alias("ids"))


def l1_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = convert.prompts(*dry_run(_exam(spark, sf_dir)))
    return rows.select("doc_id", "chunk_id", F.sha2(F.col("prompt").cast("binary"), 256).alias("sha256"))


def l5_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents from blocks to checked questions, by the deterministic converter."""
    made, hinted = dry_run(_exam(spark, sf_dir))
    fixed = dictionary.pre_correct(made, WORDS).drop("text").withColumnRenamed("corrected_text", "text")
    # Measured here, so that no task has this beside converter and parser.
    answers = convert.convert(convert.prompts(with_text_metrics(fixed), hinted), convert.marked_converter)
    keyed = answers.withColumn("key", F.concat_ws("/", "doc_id", "chunk_id"))
    parsed = responses.parse_answers(keyed, key="key")
    each = parsed.select(F.col("key").alias("chunk_id"), F.posexplode("questions").alias("pos", "q")).select("chunk_id", "pos", "q.*")
    return responses.normalise(each).select("chunk_id", "pos", "id", "text", F.to_json("options").alias("options"))


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_questions(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


def _typed(questions: DataFrame) -> DataFrame:
    answer = lambda o: F.struct(o["num"].alias("num"), o["text"].alias("text"), (o["correct"] == "true").alias("correct"), o["explanation"].alias("explanation"))
    return questions.withColumn("options", F.transform("options", answer))


def j6_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = responses.normalise(_typed(_questions(spark, sf_dir)))
    return rows.select("chunk_id", "pos", "text", F.array_join(F.transform("options", lambda o: F.concat_ws("/", o["num"], o["text"], o["explanation"])), ";").alias("options"))


def _structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.structure_issues(_questions(spark, sf_dir), F.lit(4))


def v0_structure_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _structure(spark, sf_dir).select("chunk_id", "issue_type", "severity", "question_id", "pos", "option_num", "detail")


def f7_odd_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.issues(_questions(spark, sf_dir), validation.odd_lengths()).select("chunk_id", "pos", "question_id", "option_num", "detail")


def _originals(questions: DataFrame) -> DataFrame:
    """What the orders' results are compared with: priorities and the chunk's name, three times."""
    return questions.groupBy("chunk_id").agg(F.concat_ws(" ", F.lit("① ② ③ Order chunk"), F.max("text"), F.lit("1) returned 2) options "), F.repeat(F.lit("part option "), 30)).alias("original"))


def f0_diff_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = _questions(spark, sf_dir)
    pairs = validation.compared(questions, _originals(questions))
    return validation.issues(pairs, *validation.pair_checks(alike=False)).select("chunk_id", "issue_type", "severity", "detail")


def f2_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    words = F.split(F.coalesce("text", F.lit("")), " ")
    pairs = documents.select(F.col("doc_id").alias("chunk_id"), F.coalesce("text", F.lit("")).alias("original"), F.array_join(F.filter(words, lambda w, i: i % 10 != 0), " ").alias("result"), F.lit(0).alias("n_options"))
    scored = validation.similarity(pairs)
    return scored.select("chunk_id", "similarity")


def t1_term_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = _questions(spark, sf_dir)
    return dictionary.term_issues(questions, TERMS).select("chunk_id", "pos", "question_id", "severity", "location", "term", "suggestion")


def _scores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Questions, all issues that SQL can express (every one but F4's) and the scores; _whole_scores has F4 too."""
    return _scored(_questions(spark, sf_dir), alike=False)


def _scored(questions: DataFrame, alike: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The questions dealt by chunk, their issues and scores; chunk names and originals need no options, so they don't wait for these."""
    each = validation.dealt(questions)
    found = validation.all_issues(each, _originals(questions), TERMS, F.lit(4), alike)
    return each, found, scoring.confidence(questions.select("chunk_id").distinct(), found)


def k1_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir)[2]


def k2_deductions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.deductions(_scores(spark, sf_dir)[1])


def k3_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.breakdown(_scores(spark, sf_dir)[1])


def e2_error_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.error_breakdown(_structure(spark, sf_dir))


def e4_run_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions, _, scores = _scores(spark, sf_dir)
    return scoring.run_statistics(scoring.flat_questions(questions, scores), _failed(spark, sf_dir), 42.0)


def _failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir).filter("state = 'FAILED'")


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions, _, scores = _scores(spark, sf_dir)
    return sheets.option_rows(scoring.flat_questions(questions, scores))


def x1_option_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.marks(_rows(spark, sf_dir))


def x3_review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.review_rows(_rows(spark, sf_dir)).select("chunk_id", "pos", "option_pos", "checked")


def _counted_scores(questions: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The issues counted, and the scores by these counts: the checks run once for both.

    Joins leave out null chunks, and Spark does so before it counts; told apart here, both uses share one shuffle.
    """
    counts = scoring.counted(found.filter("chunk_id is not null"))
    scores = scoring.confidence(questions.select("chunk_id").distinct(), counts)
    return counts.unionByName(scoring.counted(found.filter("chunk_id is null"))), scores


def x4_statistics_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions, found, _ = _scores(spark, sf_dir)
    counts, scores = _counted_scores(questions, found)
    run = scoring.run_statistics(scoring.flat_questions(questions, scores), _failed(spark, sf_dir), 42.0)
    return sheets.statistics_rows(run, scoring.error_breakdown(counts))


def _whole_diff(questions: DataFrame) -> DataFrame:
    return validation.diff_issues(questions, _originals(questions))


def f0_whole_diff_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 to F7 together; f0_diff_issues has what SQL can express of them."""
    return _whole_diff(_questions(spark, sf_dir)).select("chunk_id", "issue_type", "severity", "question_id", "pos", "option_num", "detail")


def _whole_scores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As _scores, with every issue of the structure, diff and term checks."""
    return _scored(_questions(spark, sf_dir))


def k1_whole_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole_scores(spark, sf_dir)[2]


def k2_whole_deductions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.breakdown(_whole_scores(spark, sf_dir)[1])


def e4_whole_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions, _, scores = _whole_scores(spark, sf_dir)
    return scoring.run_statistics(scoring.flat_questions(questions, scores))


def _whole_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions, _, scores = _whole_scores(spark, sf_dir)
    return sheets.option_rows(scoring.flat_questions(questions, scores))


def x1_whole_option_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.marks(_whole_rows(spark, sf_dir))


def x3_whole_review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.review_rows(_whole_rows(spark, sf_dir)).select("chunk_id", "pos", "option_pos", "checked")


def x4_whole_statistics_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions, found, _ = _whole_scores(spark, sf_dir)
    counts, scores = _counted_scores(questions, found)
    return sheets.statistics_rows(scoring.run_statistics(scoring.flat_questions(questions, scores)), scoring.error_breakdown(counts))


def x7_column_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.column_widths(_rows(spark, sf_dir), list(sheets.COLUMNS), cap=20, caps={"option": 16})


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(table(spark, sf_dir, "events"))


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.current_states(_log(spark, sf_dir), bucket=F.date_trunc("day", F.col("ts")), keep=["duration"])


def st2_forbidden_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = states.checked_log(_log(spark, sf_dir), bucket=F.date_trunc("day", F.col("ts")))
    return checked.filter(~F.col("allowed")).select("chunk_id", "event_id", "before", "state")


def st3_current_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir).select("chunk_id", "state", "changes", "rejected", "duration")


def st1_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("chunk_id"))
    return states.register(_states(spark, sf_dir), keys)


def st4_pauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit("2024-01-15 00:00:00").cast("timestamp")
    return table(spark, sf_dir, "events").select("event_id", states.resume_at(F.col("ts"), now).alias("resume_at"))


def st7_resumable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.resumable(_states(spark, sf_dir))


def st8_state_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.state_of(_states(spark, sf_dir), 7).select("chunk_id", "state")


def st9_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.progress(_states(spark, sf_dir), "duration")


def st9_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.state_counts(_states(spark, sf_dir))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        m0_text_metrics, p1_block_offsets, p2_full_text, r1_header_detect, r2_header_sequences, r3_page_asof, r4_option_symbol, c2_segments, c3_packed_segments, c4_chunks, c5_without_headers,
        c6_manifest, c7_headers_in_range, h1_hints, h3_tables, d2_pre_correct, d3_term_scan, d6_post_verify, d7_canonical_terms, d10_validate_term, l1_prompts, l5_converted, l9_classified_answers, j1_extracted_json,
        j6_normalised, j7_parsed_answers, v0_structure_issues, f0_diff_issues, f2_similarity, f7_odd_lengths, t1_term_issues, k1_confidence, k2_deductions, k3_breakdown, e2_error_breakdown,
        e4_run_statistics, x1_option_rows, x3_review_rows, x4_statistics_rows, x7_column_widths, st1_registered, st2_forbidden_steps, st3_current_states, st4_pauses, st7_resumable,
        st8_state_of, st9_progress, st9_state_counts, f0_whole_diff_issues, k1_whole_confidence, k2_whole_deductions, e4_whole_statistics, x1_whole_option_rows, x3_whole_review_rows, x4_whole_statistics_rows,
    )
}
