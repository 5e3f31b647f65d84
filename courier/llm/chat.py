"""Chat logs to training strings: events folded into messages, messages rendered.

A log is a table of events: a conversation, a sequence number, a message number, a role, a
kind and a text.  ``delta`` adds to a message, as streamed answers do; ``edit`` replaces what
the message held; ``regenerate`` throws it away and starts it anew.  A message is what its
last edit or regeneration and the events after it say.

Rendered, a message is

    <|im_start|>role, new line, text <|im_end|> new line

Control strings inside a text would be read as marks.  In each, one backslash goes in
after its first character, and where a text already holds such a broken string, one
backslash more; so no text can hold a control string, and taking one backslash out of each
broken string gives back the text.  Roles are written in the same way, after per cent signs
and new lines in them as %25 and %0A.

All of it is column expressions.  One shuffle brings a conversation together; it is a row of
the result, so it has to be in one place in the end.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courier.llm.common import text_of

START, END = "<|im_start|>", "<|im_end|>\n"
#: Strings with a meaning to common chat templates; all begin with < or [.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")
_TAILS = "|".join(re.escape(c[1:]) for c in CONTROL)
_FIRST = r"([<\[])"


def escape_text(text: Column) -> Column:
    """The text without control strings, reversibly."""
    return F.regexp_replace(text, rf"{_FIRST}(?=\\*(?:{_TAILS}))", r"$1\\")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_FIRST}\\(?=\\*(?:{_TAILS}))", "$1")


def escape_role(role: Column) -> Column:
    """The role on one line and without control strings, reversibly."""
    line = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escape_text(line)


def unescape_role(role: Column) -> Column:
    line = unescape_text(role)
    return F.replace(F.replace(line, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def fold_events(events: DataFrame) -> DataFrame:
    """``conv_id, message, role, text``: final messages of ``conv_id, seq, message, role,
    kind, text`` events.

    Events go by ``seq``; equal ones by kind (delta, edit, regenerate), role and text, and
    repeated rows count each.  A null text is empty, a null kind a delta, a null sequence
    number comes first.  The role is that of the last event that names one.  Messages of a
    null conversation form one conversation, as do those of a null message number one message.
    """
    kind = F.coalesce("kind", F.lit("delta"))
    rank = F.when(kind == "delta", 0).when(kind == "edit", 1).otherwise(2)
    row = events.select(
        "conv_id",
        "message",
        F.struct(
            F.coalesce(F.col("seq").cast("bigint"), F.lit(-(1 << 62))).alias("seq"),
            rank.alias("rank"),
            F.col("role").alias("role"),
            text_of("text").alias("text"),
        ).alias("e"),
    )
    log = F.array_sort(F.collect_list("e"))
    last_reset = F.array_max(
        F.transform("log", lambda e, i: F.when(e["rank"] > 0, i).otherwise(F.lit(0)))
    )
    kept = F.expr("slice(log, reset + 1, size(log))")
    said = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    return (
        row.groupBy("conv_id", "message")
        .agg(log.alias("log"))
        .withColumn("reset", last_reset)
        .select(
            "conv_id",
            "message",
            F.coalesce(F.try_element_at(said, F.lit(-1)), F.lit("")).alias("role"),
            # A regeneration starts empty: its own text is not part of the message.
            F.array_join(
                F.transform(kept, lambda e: F.when(e["rank"] == 2, "").otherwise(e["text"])), ""
            ).alias("text"),
        )
    )


def render(messages: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_spans``: a string per conversation and what to learn of it.

    Messages go by their number, equal ones by role and text.  ``loss_spans`` holds start
    (from 0) and length, in code points, of each text of the role ``learn_from``.
    """
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape_text(F.col("text"))
    parts = messages.select("conv_id", "message", "role", head.alias("head"), body.alias("body"))
    parts = parts.withColumn(
        "length", F.length("head") + F.length("body") + F.lit(len(END))
    )
    order = Window.partitionBy("conv_id").orderBy("message", "role", "body")
    before = F.coalesce(
        F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    placed = parts.withColumn("n", F.row_number().over(order)).withColumn("before", before)
    span = F.struct(
        (F.col("before") + F.length("head")).cast("bigint").alias("start"),
        F.length("body").cast("bigint").alias("length"),
    )
    piece = F.struct("n", F.concat("head", "body", F.lit(END)).alias("s"))
    return placed.groupBy("conv_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["s"]), ""
        ).alias("formatted"),
        F.array_sort(F.collect_list(F.when(F.col("role") == learn_from, span))).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, formatted, turns, loss_texts`` from formatted strings and their spans.

    ``turns`` is an array of role and text as they were; ``loss_texts`` the texts that the
    spans cover, unescaped.
    """
    cut = F.split("formatted", re.sub(r"([|])", r"[\1]", START), -1)
    pieces = F.slice(cut, F.lit(2), F.size(cut))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        text = F.substring(
            piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - len(END)
        )
        return F.struct(
            unescape_role(role).alias("role"), unescape_text(text).alias("text")
        )

    def learnt(span: Column) -> Column:
        start, length = span["start"].cast("int"), span["length"].cast("int")
        return unescape_text(F.substring(F.col("formatted"), start + 1, length))

    return formatted.select(
        "conv_id",
        "formatted",
        F.transform(pieces, turn).alias("turns"),
        F.transform("loss_spans", learnt).alias("loss_texts"),
    )


def events_of_turns(turns: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """A log as chats leave it, of finished conversations ``conv_id, turn, role, text``.

    An answer, a message of the role ``learn_from``, begins with a first try, is regenerated
    and then streamed in three deltas; any other message is begun, edited to two thirds, and
    completed by a delta.  Only the first event of a message names the role.  Rows of equal turn
    numbers stay messages of their own, in the order of role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    text = text_of("text")
    third = F.ceil(F.length(text) / 3).cast("int")
    one, two, three = (F.substring(text, third * k + 1, third) for k in range(3))

    def event(kind: str, said: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), said.alias("text"))

    answer = F.array(
        event("delta", one), event("regenerate", F.lit("")),
        event("delta", one), event("delta", two), event("delta", three),
    )
    other = F.array(event("delta", one), event("edit", F.concat(one, two)), event("delta", three))
    said = F.when(F.col("role") == learn_from, answer).otherwise(other)
    numbered = turns.withColumn("message", F.row_number().over(order).cast("bigint"))
    return numbered.select("conv_id", "message", "role", F.posexplode(said).alias("at", "e")).select(
        "conv_id",
        (F.col("message") * 5 + F.col("at")).alias("seq"),
        "message",
        F.when(F.col("at") == 0, F.col("role")).alias("role"),
        F.col("e.kind").alias("kind"),
        F.col("e.text").alias("text"),
    )


def chat_digests(turns: DataFrame) -> DataFrame:
    """The digest columns of every conversation, read back from the formatted strings."""
    back = read_back(render(fold_events(events_of_turns(turns))))
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    learnt = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learnt).cast("bigint").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
