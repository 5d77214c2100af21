"""The external conversion of chunks: prompts as expressions, and attempts with retries inside the partitions.

A converter is any function from a prompt to (stdout, stderr, exit code). The one given here is deterministic: it reads
questions, options and explanations off the marks in the text, so a whole run can be tested without an outside service.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import with_text_metrics
from docloom.operators.responses import AUTH_PHRASES, CORRUPT_SHARE, FENCE, LIMIT_AT, LIMIT_PHRASES, SHORT_ANSWER, schema_error

# The places of a template, filled one after another in this order.
PLACES = (
    "question_range", "option_symbols", "options_per_question", "explanation_marker", "broken_char_ratio", "excessive_space_ratio", "total_chars", "special_blocks",
    "hint_json_pretty", "chunk_text",
)
TEMPLATE = "Questions {question_range}, options marked {option_symbols}, {options_per_question} each.\n{special_blocks}\n{hint_json_pretty}\n{chunk_text}"
NO_BLOCKS = "없음"
WAITS = (5.0, 15.0, 45.0)
#: Outcomes that another attempt can't change.
FINAL = ("OK", "RATE_LIMIT", "AUTH")

Converter = Callable[[str], tuple[str, str, int]]


def prompt(values: dict[str, Column], template: str = TEMPLATE) -> Column:
    """The template with its places filled; a value that itself holds a later place is filled too."""
    out = F.lit(template)
    for place in PLACES:
        if place in values:
            out = F.replace(out, F.lit("{" + place + "}"), values[place])
    return out


def prompts(made: DataFrame, hinted: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """doc_id, chunk_id, prompt of every chunk; its text is measured unless `made` has the measures."""
    measured = "broken_char_ratio" in made.columns
    # Measured after the join, and the columns in made's order: so the texts' shuffle is the one that hints() has too.
    used = ("doc_id", "chunk_id", "text", *(("broken_char_ratio", "excessive_space_ratio") if measured else ()))
    rows = made.select(*[c for c in made.columns if c in used]).join(hinted, ["doc_id", "chunk_id"])
    rows = rows if measured else with_text_metrics(rows)
    percent = lambda c: F.round(F.col(c) * 100, 1).cast("string")
    special = F.array_join(F.transform("special_blocks", lambda b: F.concat(b["location"], F.lit(": "), b["type"])), ", ")
    described = F.to_json(F.struct("q_start", "q_end", "pattern", "symbol", "options_per_question", "marker", "special_blocks", "pages"), {"pretty": "true"})
    values = {
        "question_range": F.format_string("%d~%d", "q_start", "q_end"), "option_symbols": F.col("symbol"), "options_per_question": F.col("options_per_question").cast("string"),
        "explanation_marker": F.col("marker"), "broken_char_ratio": percent("broken_char_ratio"), "excessive_space_ratio": percent("excessive_space_ratio"), "total_chars": F.length("text").cast("string"), "special_blocks": F.when(special == "", NO_BLOCKS).otherwise(special),
        "hint_json_pretty": described, "chunk_text": F.col("text"),
    }
    return rows.select("doc_id", "chunk_id", prompt(values, template).alias("prompt"))


def retry_notice(error: str) -> str:
    return f"The answer before could not be read: {error}\nAnswer with JSON alone.\n\n"


def marked_converter(text: str) -> tuple[str, str, int]:
    """Questions from lines beginning with 문N, options from circled numbers, the answer from what follows `정답은`."""
    questions: list[dict] = []
    for line in text.split("\n"):
        line = line.strip()
        if head := re.match(r"문\s?(\d{1,3})\s*[.)]?\s*(.*)", line):
            questions.append({"id": int(head[1]), "text": head[2], "options": []})
        elif questions and line[:1] in tuple("①②③④⑤⑥⑦⑧⑨⑩"):
            questions[-1]["options"].append({"num": line[0], "text": line[1:].strip(), "correct": False})
        elif questions and (said := re.search(r"정답은\s*(.)", line)):
            for option in questions[-1]["options"]:
                option["correct"] = option["num"] == said[1]
                option["explanation"] = line
    return json.dumps({"questions": questions}, ensure_ascii=False), "", 0


def template_in(text: str) -> str:
    """The first fenced block with {chunk_text} in it; the whole text where it has no fence but the place; else TEMPLATE."""
    for block in re.findall(r"```\w*\n(.*?)```", text, re.S):
        if "{chunk_text}" in block:
            return block
    return text if "{chunk_text}" in text and "```" not in text else TEMPLATE


def answer_kind(stdout: str, stderr: str, code: int) -> str:
    """As classify_answer(), for use between attempts."""
    said, out = f"{stdout}\n{stderr}", stdout.strip()
    lower = said.lower()
    if re.search(LIMIT_AT, said) or any(p in lower for p in LIMIT_PHRASES) and (code or len(out) < SHORT_ANSWER):
        return "RATE_LIMIT"
    if code and any(p in lower for p in AUTH_PHRASES):
        return "AUTH"
    if stdout.count("\ufffd") > CORRUPT_SHARE * len(stdout):
        return "ENCODING"
    return "NONZERO_EXIT" if code or not out else "OK"


def unreadable(stdout: str) -> str | None:
    """Why an answer can't be taken: no JSON, broken JSON or not questions; null if it can."""
    fence = re.search(FENCE, stdout)
    body = fence[1].strip() if fence and fence[1].strip() else stdout[stdout.find("{") : stdout.rfind("}") + 1]
    if not body:
        return "no JSON in the answer"
    try:
        return schema_error(json.loads(body))
    except ValueError as e:
        return str(e)


def convert(rows: DataFrame, converter: Converter, *, attempts: int = 3, waits: tuple[float, ...] = WAITS, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """doc_id, chunk_id, stdout, stderr, exit_code, kind, attempts: each prompt answered, with up to `attempts` tries.

    `kind` is the answer's class (classify_answer()). Limits and refused logins end the tries; any other failure asks
    again, and so does an answer that can't be read, which is told why (retry_notice()).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, chunk, text in zip(batch["doc_id"], batch["chunk_id"], batch["prompt"], strict=True):
                asked = text
                for k in range(attempts):
                    stdout, stderr, code = converter(asked)
                    kind = answer_kind(stdout, stderr, code)
                    error = unreadable(stdout) if kind == "OK" else None
                    if kind in FINAL and error is None:
                        break
                    asked = retry_notice(error) + text if error else text
                    if k + 1 < attempts:
                        sleep(waits[min(k, len(waits) - 1)])
                out.append((doc, chunk, stdout, stderr, code, kind, k + 1))
            yield pd.DataFrame(out, columns=["doc_id", "chunk_id", "stdout", "stderr", "exit_code", "kind", "attempts"])

    kinds = dict(rows.dtypes)
    return rows.select("doc_id", "chunk_id", "prompt").mapInPandas(run, f"doc_id {kinds['doc_id']}, chunk_id string, stdout string, stderr string, exit_code int, kind string, attempts int")
