r"""Event-sourced chat formatting, in DataFrame functions only.

A log of events is partitioned by conversation and sorted by sequence number.  ``message``,
``edit`` and ``regenerate`` events set a message's text, ``delta`` events append to it, ``delete``
removes it; regenerating a message voids every event of later messages that came before.  The
final messages are rendered as

    ### role: text</turn>\n

with ``\``, ``<`` and ``#`` of role and text written ``\b``, ``\l`` and ``\h`` (``:`` in a role
``\c``), so a control string can't arise inside a text and ``parse`` restores every character.

Defined results: a null text or role reads as empty, a null kind as ``message``; events of equal
sequence number are ordered by kind and text; a null conversation id is one conversation; an empty
log gives no rows; other columns are ignored.  One conversation is one string, so it must fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>\n"
_ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
_RESETS = ("message", "edit", "regenerate", "delete")


def escape(c: Column, role: bool = False) -> Column:
    for raw, code in (*_ESCAPES, *((":", "\\c"),) * role):
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column, role: bool = False) -> Column:
    for raw, code in reversed((*_ESCAPES, *((":", "\\c"),) * role)):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, seq, message, kind, role, text) to final messages (conv_id, message, role, text).

    One exchange, by conversation; the windows and the fold reuse it.
    """
    e = events.select("conv_id", "seq", "message", F.coalesce("kind", F.lit("message")).alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text"))
    earlier = W.partitionBy("conv_id").orderBy("message").rangeBetween(W.unboundedPreceding, -1)
    e = e.withColumn("void", F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(earlier))
    e = e.where(F.col("void").isNull() | (F.col("seq") > F.col("void")))
    own = W.partitionBy("conv_id", "message")
    e = e.withColumn("reset", F.max(F.when(F.col("kind").isin(*_RESETS), F.col("seq"))).over(own))
    e = e.where(F.when(F.col("reset").isNull(), F.col("void").isNull()).otherwise(F.col("seq") >= F.col("reset")))
    folded = e.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_list(F.struct("seq", (F.col("kind") == "delta").alias("appends"), "kind", "text"))).alias("parts"),
        F.min_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"),
    )
    return folded.where(~F.exists("parts", lambda p: p["kind"] == "delete")).select("conv_id", "message", F.coalesce("role", F.lit("")).alias("role"), F.concat_ws("", F.col("parts.text")).alias("text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Per conversation: ``formatted``, and the loss mask as spans of its turns (code points)."""
    turns = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("message", "role", "text"))).alias("turns"))
    turns = turns.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), escape(t["role"], True).alias("head"), escape(t["text"]).alias("body"))).alias("turns"))
    masked = F.transform(
        "turns",
        lambda t, i: F.when(
            t["role"] == loss_role,
            F.struct(i.alias("turn"), (F.length(t["head"]) + len(OPEN) + 2).alias("start"), (F.length(t["head"]) + len(OPEN) + 2 + F.length(t["body"])).alias("end")),
        ),
    )
    return turns.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(F.lit(OPEN), t["head"], F.lit(": "), t["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.filter(masked, lambda m: m.isNotNull()).alias("loss"),
    )


def parse(formatted: DataFrame) -> DataFrame:
    """Read turns and the text under the loss mask back from the output of ``render``."""
    raw = formatted.withColumn("raw", F.split("formatted", CLOSE, -1)).withColumn("raw", F.slice("raw", 1, F.size("raw") - 1))
    return raw.select(
        "conv_id",
        "formatted",
        F.transform(
            "raw",
            lambda t: F.struct(
                unescape(F.substring(t, len(OPEN) + 1, F.instr(t, ": ") - len(OPEN) - 1), True).alias("role"),
                unescape(F.substring(t, F.instr(t, ": ") + 2, F.length(t))).alias("text"),
            ),
        ).alias("turns"),
        F.array_join(F.transform("loss", lambda m: unescape(F.substring(F.get("raw", m["turn"]), m["start"] + 1, m["end"] - m["start"]))), "").alias("loss_text"),
    )


def format_conversations(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    return render(fold_events(events), loss_role)
