"""Chat formatting by event-sourced reconstruction, with DataFrame functions only.

A log holds events (conv_id, message, seq, op, role, text). Within a message, in order of seq:

    delta       appends its text
    edit        replaces what was there by its text
    regenerate  discards what was there; its text (usually empty) begins the new answer
    delete      removes the message unless a later event writes it again

Folding keeps the events from the last edit, regenerate or delete on and joins their texts, so a message of many
deltas costs one pass. Conversations are dealt out once, by conv_id; every later step uses that placement.

The template writes an assistant turn as `<s>role\\ntext</s>` and any other as `[INST]role\\ntext[/INST]`. Inside roles
and texts & becomes &amp;, < becomes &lt; and [ becomes &#91; (in roles also the line feed, &#10;), so no control
string can come from a text, and reading back undoes it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESETS = ("edit", "regenerate", "delete")


def escape(x: Column) -> Column:
    x = F.replace(x, F.lit("&"), F.lit("&amp;"))
    x = F.replace(x, F.lit("<"), F.lit("&lt;"))
    return F.replace(x, F.lit("["), F.lit("&#91;"))


def unescape(x: Column) -> Column:
    for mark, char in (("&#10;", "\n"), ("&#91;", "["), ("&lt;", "<"), ("&amp;", "&")):
        x = F.replace(x, F.lit(mark), F.lit(char))
    return x


def reconstruct(events: DataFrame) -> DataFrame:
    """conv_id, message, role, text: each message's final state, from an event log in any order.

    Ties in seq are ordered by op, role and text. A message's role is the last non-null role given. Null texts are
    empty, an unknown or null op counts as delta. Messages that end deleted are left out.
    """
    log = events.select("conv_id", "message", F.struct("seq", F.coalesce("op", F.lit("delta")).alias("op"), "role", F.coalesce("text", F.lit("")).alias("text")).alias("e"))
    folded = log.repartition("conv_id").groupBy("conv_id", "message").agg(F.array_sort(F.collect_list("e")).alias("events"))
    resets = F.filter(F.transform("events", lambda e, i: F.when(e["op"].isin(*RESETS), i)), lambda i: i.isNotNull())
    folded = folded.withColumn("from", F.coalesce(F.array_max(resets), F.lit(0)))
    live = F.slice("events", F.col("from") + 1, F.size("events"))
    live = F.filter(live, lambda e: e["op"] != "delete")
    roles = F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull())
    folded = folded.withColumn("live", live).filter(F.size("live") > 0)
    return folded.select(
        "conv_id",
        "message",
        F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
        F.array_join(F.transform("live", lambda e: e["text"]), "").alias("text"),
    )


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans array<struct<start, length>> (code points of formatted under the loss mask)."""
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit("&#10;"))
    is_loss = F.col("role") == loss_role
    opened, closed = F.when(is_loss, "<s>").otherwise("[INST]"), F.when(is_loss, "</s>").otherwise("[/INST]")
    turns = messages.withColumns({"head": F.concat(opened, role, F.lit("\n")), "body": escape(F.col("text")), "tail": closed, "loss": is_loss})
    turns = turns.withColumn("piece", F.concat("head", "body", "tail"))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)) + F.length("head"))
    row = F.struct("message", "piece", "loss", F.col("at").alias("start"), F.length("body").cast("long").alias("length"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns array<struct<role, text>> and loss_text, from the rendered strings and spans alone."""
    pieces = F.filter(F.split("formatted", r"(?<=\[/INST\]|</s>)", -1), lambda x: x != "")

    def turn(piece: Column) -> Column:
        body = F.regexp_replace(piece, r"\A(?:<s>|\[INST\])|(?:</s>|\[/INST\])\z", "")
        cut = F.instr(body, "\n")
        return F.struct(unescape(F.substring(body, F.lit(1), cut - 1)).alias("role"), unescape(F.substring(body, cut + 1, F.length(body))).alias("text"))

    masked = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("conv_id", "formatted", F.transform(pieces, turn).alias("turns"), F.array_join(masked, "").alias("loss_text"))


def conversation_events(conversations: DataFrame) -> DataFrame:
    """Rows by turn as a log: each row is one message, written by a single delta.

    Rows of one conversation that share a turn are different messages, ordered by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select("conv_id", F.row_number().over(order).cast("long").alias("message"), F.lit(0).alias("seq"), F.lit("delta").alias("op"), "role", "text")


def chat_digest(conversations: DataFrame) -> DataFrame:
    """The figures of every formatted conversation, each read back from what render() wrote."""
    back = read_back(render(reconstruct(conversation_events(conversations))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
