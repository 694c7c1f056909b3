"""Chat formatting: conversations rebuilt from their event log and rendered with a reversible template.

Log rows: ``conv_id``, ``turn``, ``msg`` (message within the turn), ``seq`` (log order), ``kind``, ``role``,
``text``. Kinds: ``message`` and ``delta`` append text to their message, ``edit`` replaces the message by
its own text, ``regenerate`` empties it so that later deltas fill it anew. An edit or regeneration of a turn
also voids everything logged before it on that turn and on later turns (the old branch).

DataFrame functions only. The log is never windowed by conversation: resets are aggregated into a short
list per conversation and joined to the events (a skewed join that Spark can split), messages are folded by
(conversation, turn, message), and only finished messages meet in the one row that a conversation is.

Defined results: null text and null role read as empty, null kind as ``message``; null turns sort first;
equal rows are kept as messages of their own; turns tie by role, text, then log order; an empty log gives
an empty table; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Openers of control strings: our own ``<|`` and the common ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``.
#: Escaping puts one ``~`` after the opening bracket; a run of ``~`` already there grows by one, so
#: taking one away restores any text.
ESCAPE = r"([<\[])(~*)(\||/?s>|/?INST\])"
UNESCAPE = r"([<\[])~(~*)(\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, "$1~$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def events_from_turns(conversations: DataFrame) -> DataFrame:
    """A log of one ``message`` event per stored turn."""
    row = F.monotonically_increasing_id()
    return conversations.select("conv_id", "turn", row.alias("msg"), row.alias("seq"), F.lit("message").alias("kind"), "role", "text")


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, turn, msg, role, text."""
    log = events.select("conv_id", "turn", "msg", F.coalesce("seq", F.lit(-1)).alias("seq"),
                        F.coalesce("kind", F.lit("message")).alias("kind"),
                        "role", F.coalesce("text", F.lit("")).alias("text"))
    resets = (log.filter(F.col("kind").isin("edit", "regenerate"))
              .groupBy("conv_id", "turn").agg(F.max("seq").alias("seq"))
              .groupBy(F.col("conv_id").alias("_conv")).agg(F.collect_list(F.struct("turn", "seq")).alias("_resets")))
    after = F.array_max(F.transform(F.filter("_resets", lambda r: r["turn"].isNull() | (r["turn"] <= F.col("turn"))), lambda r: r["seq"]))
    alive = (log.join(resets, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
             .filter(F.coalesce(F.col("seq") >= after, F.lit(True))))
    parts = F.array_sort(F.collect_list(F.struct("seq", F.when(F.col("kind") == "regenerate", F.lit("")).otherwise(F.col("text")).alias("text"))))
    return (alive.groupBy("conv_id", "turn", "msg")
            .agg(F.min_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"), parts.alias("parts"), F.min("seq").alias("seq"))
            .select("conv_id", "turn", "msg", "seq", F.coalesce("role", F.lit("")).alias("role"),
                    F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text")))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_mask.

    ``loss_mask`` holds per turn the lengths in code points (head, loss, tail) of the runs without, with
    and without loss; together they cover ``formatted``. Only texts of ``loss_role`` carry loss.
    """
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text", "seq")))
    body = lambda t: escape(t["text"])
    head = lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))
    mask = lambda t: F.struct(
        (F.length(head(t)) + F.when(t["role"] == loss_role, 0).otherwise(F.length(body(t)))).alias("head"),
        F.when(t["role"] == loss_role, F.length(body(t))).otherwise(0).alias("loss"), F.lit(len(END)).alias("tail"))
    return (messages.groupBy("conv_id").agg(turns.alias("_turns"))
            .select("conv_id", F.size("_turns").cast("long").alias("n_turns"),
                    F.array_join(F.transform("_turns", lambda t: F.concat(head(t), body(t), F.lit(END))), "").alias("formatted"),
                    F.transform("_turns", mask).alias("loss_mask")))


def read_back(rendered: DataFrame) -> DataFrame:
    """``rendered`` plus ``turns`` (array of role, text) and ``loss_text``, parsed from the output alone."""
    pieces = F.slice(F.split("formatted", r"<\|turn\|>"), 2, F.size("loss_mask") + 1)
    parsed = F.transform(pieces, lambda p: F.struct(F.split(p, r"<\|text\|>")[0].alias("role"),
                                                    F.split(F.split(p, r"<\|text\|>")[1], r"<\|end\|>")[0].alias("body")))
    out = rendered.withColumn("_parsed", parsed)
    loss = F.zip_with("_parsed", "loss_mask", lambda p, m: unescape(F.substr(p["body"], F.lit(1), m["loss"])))
    turns = F.transform("_parsed", lambda p: F.struct(unescape(p["role"]).alias("role"), unescape(p["body"]).alias("text")))
    return out.withColumn("turns", turns).withColumn("loss_text", F.array_join(loss, "")).drop("_parsed")


def probe_conversation(spark: SparkSession, like: DataFrame) -> DataFrame:
    """Conversation -7 of the contract: both turns consist of another template's control strings."""
    text = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", text), (-7, 1, "assistant", text)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
