"""Chat transcripts rebuilt from an event log, and rendered with a loss mask.

The log has one row per event: conv_id, seq, kind, message_id, role, text.  Kinds, in the order of seq:

* ``message`` opens a message, or begins it anew, with ``text`` as its first piece (and sets its role),
* ``delta`` appends to its message,
* ``edit`` puts ``text`` in place of all its message holds so far,
* ``regenerate`` empties its message and withdraws every message opened between it and now.

A message comes where it was opened.  The fold has two steps.  By (conversation, message): the
last event that begins it anew is found, earlier ones go, and the rest is joined - a
conversation with many streamed events is spread over tasks.  By conversation: withdrawn messages
go and the others are numbered, with the place of each in the transcript as a running sum.  Only final
messages of a conversation meet in a task, because a transcript is one row.

The transcript is ``<|im_start|>role\\ntext<|im_end|>\\n`` for each message.  In texts and roles
the backslash, ``<|`` and (in roles) the line feed are escaped, so a control string
never occurs inside, and `unescape` gives back what was there.  ``loss_spans`` (start, length in code points)
cover the assistant's escaped texts and nothing else.

Null texts, roles and kinds: empty text, empty role, a delta.  Events without a message_id are
messages of their own; a null conv_id is a conversation.  Null seq comes first; equal events of a
message are taken in the order of kind, then text.  Repeated rows are repeated events.  An empty log gives no conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
#: each follows the backslash
ESCAPES = {"\\": "s", "<|": "p", "\n": "n"}


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escape(text: Column, line: bool = False) -> Column:
    """No ``<|`` is left, and with ``line`` no line feed."""
    out = _replace(_replace(text, "\\", "\\s"), "<|", "<\\p")
    return _replace(out, "\n", "\\n") if line else out


def unescape(text: Column) -> Column:
    return _replace(_replace(_replace(text, "\\n", "\n"), "\\p", "|"), "\\s", "\\")


def messages(log: DataFrame) -> DataFrame:
    """(conv_id, opened, message_id, regenerated, role, text): each message as its events leave it."""
    known = log.select(
        "conv_id",
        "seq",
        F.coalesce("kind", F.lit("delta")).alias("kind"),
        F.when(F.col("message_id").isNull(), F.monotonically_increasing_id()).alias("_own"),
        "message_id",
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    key = ["conv_id", "message_id", "_own"]
    whole = W.partitionBy(*key)
    rank = F.struct("seq", (F.col("kind") != "regenerate").alias("a"), (F.col("kind") == "delta").alias("b"), "text")
    anew = F.col("kind").isin("message", "edit", "regenerate")
    alive = (
        known.withColumns({"_rank": rank})
        .withColumns(
            {
                "_from": F.max(F.when(anew, F.col("_rank"))).over(whole),
                "_opened": F.min("seq").over(whole),
                "_regenerated": F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(whole),
                "_role": F.max(F.when(F.col("role").isNotNull(), F.struct("_rank", "role"))).over(whole)["role"],
            }
        )
        .filter(F.col("_from").isNull() | (F.col("_rank") >= F.col("_from")))
    )
    piece = F.struct(F.col("_rank").alias("r"), F.when(F.col("kind") == "regenerate", F.lit("")).otherwise(F.col("text")).alias("t"))
    return alive.groupBy(*key).agg(
        F.first("_opened").alias("opened"),
        F.first("_regenerated").alias("regenerated"),
        F.coalesce(F.first("_role"), F.lit("")).alias("role"),
        F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["t"]), "").alias("text"),
    )


def render(final: DataFrame) -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans), one row per conversation."""
    order = W.partitionBy("conv_id").orderBy("opened", "message_id", "_own", "role", "text")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    # a message goes if one opened before it was regenerated after it
    withdrawn = F.max("regenerated").over(before) > F.col("opened")
    kept = final.withColumn("_withdrawn", F.coalesce(withdrawn, F.lit(False))).filter(~F.col("_withdrawn"))
    head = F.concat(F.lit(START), escape(F.col("role"), line=True), F.lit("\n"))
    body = escape(F.col("text"))
    turns = kept.withColumns({"_head": head, "_body": body}).withColumn(
        "_turn", F.concat("_head", "_body", F.lit(f"{END}\n"))
    )
    place = F.coalesce(F.sum(F.length("_turn").cast("bigint")).over(before), F.lit(0))
    span = F.struct(
        (place + F.length("_head")).cast("bigint").alias("start"), F.length("_body").cast("bigint").alias("length")
    )
    placed = turns.select(
        "conv_id",
        F.struct(
            F.row_number().over(order).alias("nth"),
            F.col("_turn").alias("turn"),
            F.when(F.col("role") == TRAINED, span).alias("span"),
        ).alias("t"),
    )
    gathered = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    return gathered.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def transcripts(log: DataFrame) -> DataFrame:
    """Fold and render."""
    return render(messages(log))


def read_back(formatted: Column) -> Column:
    """The turns of a transcript as an array of (role, text), unescaped."""
    turns = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda x: x != "")

    def turn(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        text = F.substring(x, F.length(role) + 2, F.length(x) - F.length(role) - 2 - len(END))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(turns, turn)


def trained_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, one after the other."""
    cut = F.transform(
        spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )
    return F.array_join(cut, "")
