"""Chat formatting: event logs of conversations folded into messages and rendered.

DataFrame functions only. Every message is folded on its own, so a long conversation
costs time in proportion to its events; a conversation's rendered text is one string
and must fit in one (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import without

# The control strings of the template.
OPEN, CLOSE = "[INST]", "[/INST]"
OPEN_LOSS, CLOSE_LOSS = "<s>", "</s>"
#: A control string, perhaps with backslashes after its bracket. Escaping adds one, so
#: that no text can hold a control string, and unescaping takes one away.
CONTROL = r"([\[<])(\\*)(/?(?:INST\]|s>))"
ESCAPED = r"([\[<])\\(\\*)(/?(?:INST\]|s>))"

#: Kinds of events. message, edit and regenerate set a message's text, deltas that come
#: later add to it, delete takes the message out.
RESETS = ("message", "edit", "regenerate")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def fold_events(events: DataFrame) -> DataFrame:
    """Events (conv_id, seq, msg, kind, role, text) to final messages (conv_id, msg, role, text).

    Within a conversation events count in the order of seq (ties: kind, role, text). A
    message's text is that of its last message, edit or regenerate event plus the deltas
    after it; a delete after that event removes it. A regenerate event also removes the
    messages with a larger msg that were last set before it. Null texts are empty, null
    roles "", a null or unknown kind is a delta. Null conv_id is a conversation of its own.
    """
    kind = F.coalesce(F.lower("kind"), F.lit("delta"))
    event = F.struct("seq", kind.alias("kind"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    one = events.groupBy("conv_id", "msg").agg(F.sort_array(F.collect_list(event)).alias("log"))
    last = F.coalesce(F.array_max(F.transform("log", lambda e, i: F.when(e["kind"].isin(*RESETS), i))), F.lit(0))
    one = one.withColumn("base", last).select(
        "conv_id",
        "msg",
        F.array_max(F.transform("log", lambda e: F.when(e["kind"] == "regenerate", e["seq"]))).alias("regen"),
        F.element_at("log", F.col("base") + 1)["seq"].alias("set_at"),
        F.slice("log", F.col("base") + 1, F.size("log")).alias("log"),
    )
    before = W.partitionBy("conv_id").orderBy("msg").rowsBetween(W.unboundedPreceding, -1)
    return (
        one.withColumn("redone", F.max("regen").over(before))
        .where(~F.exists("log", lambda e: e["kind"] == "delete") & F.coalesce(F.col("redone") < F.col("set_at"), F.lit(True)))
        .select("conv_id", "msg", F.element_at("log", 1)["role"].alias("role"), F.array_join(F.transform("log", lambda e: e["text"]), "").alias("text"))
    )


def render(messages: DataFrame, *, loss_role: str = "assistant") -> DataFrame:
    """Messages (conv_id, msg, role, text) to one row per conversation: conv_id, formatted,
    loss_spans (array of start and length in UTF-8 bytes of formatted, in order).

    A turn is its opening mark, the role (percent-encoded), a line feed, the escaped text
    and its closing mark. Turns of loss_role have marks of their own and their text is
    under the loss mask.
    """
    loss = F.col("role") == loss_role
    head = F.concat(F.when(loss, OPEN_LOSS).otherwise(OPEN), F.url_encode("role"), F.lit("\n"))
    turns = messages.select("conv_id", "msg", loss.alias("loss"), head.alias("head"), escape(F.col("text")).alias("body"), F.when(loss, CLOSE_LOSS).otherwise(CLOSE).alias("tail"))
    before = W.partitionBy("conv_id").orderBy("msg").rowsBetween(W.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(F.octet_length(F.concat("head", "body", "tail")).cast("long")).over(before), F.lit(0)) + F.octet_length("head"))
    piece = F.struct("msg", "at", F.octet_length("body").alias("length"), "loss", F.concat("head", "body", "tail").alias("turn"))
    return (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(piece)).alias("turns"))
        .select(
            "conv_id",
            F.array_join(F.col("turns.turn"), "").alias("formatted"),
            F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["at"].alias("start"), t["length"].alias("length"))).alias("loss_spans"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns that a formatted text holds, as array of struct(role, text)."""
    parts = F.split(formatted, r"\[/INST\]|</s>", -1)

    def turn(part: Column) -> Column:
        part = F.regexp_replace(part, r"^(?:\[INST\]|<s>)", "")
        role = F.substring_index(part, "\n", 1)
        return F.struct(F.url_decode(role).alias("role"), unescape(F.substr(part, F.char_length(role) + 2)).alias("text"))

    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    raw = formatted.cast("binary")
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(raw, s["start"].cast("int") + 1, s["length"].cast("int")).cast("string"))), "")


def chat_format(rows: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) to conv_id, formatted, loss_spans.

    Each row is a message event of its own; rows with the same turn stand in the order of
    role and text, and a null turn comes first. Extra columns play no part.
    """
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    events = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).withColumn("msg", F.row_number().over(order))
    return render(fold_events(without(events, "seq", "kind").select("conv_id", F.col("msg").alias("seq"), "msg", F.lit("message").alias("kind"), "role", "text")))
