"""A converter's raw answers: classified, unwrapped, parsed, repaired, checked and normalised."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.text import strip

QUESTIONS = "array<struct<id: int, text: string, options: array<struct<num: string, text: string, correct: boolean, explanation: string>>>>"
# Fixed values.
LIMIT_PHRASES = ("usage limit reached", "usage limit", "rate limit", "rate_limit", "too many requests", "429", "overloaded", "quota exceeded")
AUTH_PHRASES = (
    "not logged in", "please run /login", "please login", "invalid api key", "authentication", "unauthenticated", "unauthorized", "401", "oauth token",
)
#: A fenced body, of JSON where a language is told.
FENCE = r"(?is)```(?:json)?\s*\n?(.*?)```"
LIMIT_AT = r"(?i)usage\s+limit\s+reached\s*\|\s*(\d{9,13})"
#: A string, or (its mark as a group) one that stays open; possessive, so that a long one takes no stack.
STRINGS = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|(")[^"\\]*+(?:\\.[^"\\]*+)*+\\?\z'
SHORT_ANSWER, CORRUPT_SHARE = 500, 0.005
SAME, NO_EXPLANATION = "동일", "해설 없음"


def corruption_share(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit("�")) / F.length(text)).otherwise(0.0)


def reset_epoch(stdout: Column, stderr: Column) -> Column:
    """Seconds since 1970 at which a stated usage limit ends; milliseconds are recognised by their size."""
    said = F.try_to_number(F.nullif(F.regexp_extract(F.concat_ws("\n", stdout, stderr), LIMIT_AT, 1), F.lit("")), F.lit("9999999999999")).cast("double")
    return F.when(said > 1e12, said / 1000).otherwise(said)


def classify_answer(stdout: Column, stderr: Column, exit_code: Column) -> Column:
    """RATE_LIMIT, AUTH, ENCODING, NONZERO_EXIT or OK, the first that holds."""
    out, err = F.coalesce(stdout, F.lit("")), F.coalesce(stderr, F.lit(""))
    both = F.lower(F.concat_ws("\n", out, err))
    any_of = lambda phrases: both.rlike("|".join(phrases))
    failed = exit_code != 0
    limited = F.concat_ws("\n", out, err).rlike(LIMIT_AT) | (any_of(LIMIT_PHRASES) & (failed | (F.length(strip(out)) < SHORT_ANSWER)))
    return (
        F.when(limited, "RATE_LIMIT")
        .when(failed & any_of(AUTH_PHRASES), "AUTH")
        .when(corruption_share(out) > CORRUPT_SHARE, "ENCODING")
        .when(failed | (strip(out) == ""), "NONZERO_EXIT")
        .otherwise("OK")
    )


def unwrap(stdout: Column) -> Column:
    """The `result` of a JSON envelope, as text; null for any other answer."""
    return F.get_json_object(stdout, "$.result")


def extract_json(text: Column) -> Column:
    """The first fenced body, if not blank; else from the first { to the last }; else null."""
    fenced = F.nullif(strip(F.regexp_extract(text, FENCE, 1)), F.lit(""))
    first, last = F.instr(text, "{"), F.length(text) - F.instr(F.reverse(text), "}") + 1
    braces = F.when((first > 0) & F.contains(text, F.lit("}")) & (last > first), F.substring(text, first, last - first + 1))
    return F.coalesce(fenced, braces)


def is_truncated(text: Column) -> Column:
    """Open brackets or an open string remain, or the text doesn't end in } or ]."""
    bare = F.regexp_replace(text, STRINGS, "$1")  # of an open string its mark stays
    opened, closed = (F.regexp_count(bare, F.lit(rx)) for rx in (r"[{\[]", r"[}\]]"))
    return (opened != closed) | F.contains(bare, F.lit('"')) | ~strip(text).rlike(r"[}\]]\z")


def whole_objects(text: str) -> list[dict]:
    """The complete objects in the list of questions of a cut-off answer; those that don't parse are left out."""
    at = text.find('"questions"')
    at = text.find("[", at) if at >= 0 else -1
    found, decoder = [], json.JSONDecoder()
    while at >= 0 and (at := text.find("{", at + 1)) >= 0:
        try:
            item, end = decoder.raw_decode(text, at)
        except ValueError:
            depth, quoted, i = 0, False, at
            while i < len(text):
                c = text[i]
                if quoted:
                    i += c == "\\"
                    quoted = c != '"'
                elif c == '"':
                    quoted = True
                elif c in "{[":
                    depth += 1
                elif c in "}]":
                    depth -= 1
                    if not depth:
                        break
                i += 1
            if i >= len(text):
                break
            at = i
            continue
        found.append(item)
        at = end - 1
    return found


def schema_error(data: object) -> str | None:
    """The first place where the data isn't a list of questions as asked for; null if it is."""

    def wrong(value: object, path: str, kind: str) -> str | None:
        whole = isinstance(value, int | float) and not isinstance(value, bool) and value == int(value)
        fits = {"object": isinstance(value, dict), "array": isinstance(value, list), "string": isinstance(value, str), "boolean": isinstance(value, bool), "integer": whole}
        return None if fits[kind] else f"{path}: not of type {kind}"

    def fields(value: dict, path: str, kinds: dict[str, str]) -> str | None:
        for name, kind in kinds.items():
            if name not in value:
                return f"{path}: {name} is missing"
            if error := wrong(value[name], f"{path}.{name}", kind):
                return error
        return None

    if error := wrong(data, "$", "object") or fields(data, "$", {"questions": "array"}):
        return error
    for i, q in enumerate(data["questions"]):
        path = f"$.questions[{i}]"
        if error := wrong(q, path, "object") or fields(q, path, {"id": "integer", "text": "string", "options": "array"}):
            return error
        for j, o in enumerate(q["options"]):
            at = f"{path}.options[{j}]"
            if error := wrong(o, at, "object") or fields(o, at, {"num": "string", "text": "string", "correct": "boolean"}):
                return error
            if "explanation" in o and (error := wrong(o["explanation"], f"{at}.explanation", "string")):
                return error
    return None


def parse_answers(answers: DataFrame, key: str = "chunk_id", text_col: str = "stdout") -> DataFrame:
    """key, ok, recovered, error, questions: each answer parsed and checked; cut-off answers yield their whole questions."""
    rows = answers.select(F.col(key), extract_json(F.coalesce(F.col(text_col), F.lit(""))).alias("json"))
    rows = rows.withColumn("truncated", F.coalesce(is_truncated(F.col("json")), F.lit(True)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, text, cut in zip(batch[key], batch["json"], batch["truncated"], strict=True):
                data, recovered, error = None, False, None
                try:
                    data = json.loads(text) if text else None
                    error = None if text else "no JSON in the answer"
                except ValueError as e:
                    items = whole_objects(text) if cut else []
                    data, recovered, error = ({"questions": items}, True, None) if items else (None, False, str(e))
                if error is None:
                    error = schema_error(data)
                out.append((name, error is None, recovered and error is None, error, json.dumps(data["questions"]) if error is None else None))
            yield pd.DataFrame(out, columns=[key, "ok", "recovered", "error", "body"])

    kind = dict(answers.dtypes)[key]
    parsed = rows.mapInPandas(run, f"{key} {kind}, ok boolean, recovered boolean, error string, body string")
    return parsed.select(key, "ok", "recovered", "error", F.from_json("body", QUESTIONS).alias("questions"))


def normalise(questions: DataFrame) -> DataFrame:
    """Questions (chunk_id, pos, id, text, options) trimmed, repeated texts as `동일`, missing explanations filled in.

    A text is repeated if it equals the last one before it in the chunk that wasn't empty, as given.
    """
    by = Window.partitionBy("chunk_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    own = strip(F.coalesce("text", F.lit("")))
    rows = questions.withColumn("_own", own).withColumn("_last", F.last(F.nullif("_own", F.lit("")), ignorenulls=True).over(by))
    filled = lambda o: strip(F.coalesce(o["explanation"], F.lit("")))
    options = F.transform(
        F.coalesce("options", F.expr("array()")),
        lambda o: F.struct(
            strip(F.coalesce(o["num"].cast("string"), F.lit(""))).alias("num"), strip(F.coalesce(o["text"], F.lit(""))).alias("text"),
            F.coalesce(o["correct"], F.lit(False)).alias("correct"), F.when(filled(o) == "", NO_EXPLANATION).otherwise(filled(o)).alias("explanation"),
        ),
    )
    return rows.withColumns({"text": F.when((F.col("_own") != "") & (F.col("_own") == F.col("_last")), SAME).otherwise(F.col("_own")), "options": options}).drop("_own", "_last")
