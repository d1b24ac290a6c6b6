"""Chat formatting by prefix-target expansion, in DataFrame operations only.

Every assistant turn becomes an example of its own: all turns before it are
context, only its text is trainable. The examples of a conversation share one
formatted text, since the text of an example is the beginning of the
conversation's text that ends with its reply. So a conversation is formatted
once, and an example is a row that says where its text ends and which part of
it is trainable. That keeps the expansion linear in the input; ``example_texts``
writes the texts out where a trainer wants them so.

Template: ``<|role|>text<|end|>`` per turn. In roles and texts ``&``, ``<``, ``[``
and ``|`` are written as ``&amp;``, ``&lt;``, ``&#91;`` and ``&#124;``: neither these marks nor
those of other templates (``</s>``, ``[INST]``) can come from a text, and the
escape is reversible.

Cases: null text or role counts as empty, and a null turn comes first. Rows that
share a turn number are all kept, ordered by role and text. Repeated rows are
turns of their own. A conversation without an assistant turn has no example but
is formatted. An empty table gives empty results. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of the template and the escapes, in the order of escaping.
OPEN, CLOSE, END = "<|", "|>", "<|end|>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), ("|", "&#124;"))
TARGET_ROLE = "assistant"
_EXAMPLES = "array<struct<turn:bigint,loss_start:int,loss_end:int>>"


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, examples): the text once, and one entry per assistant turn.

    An example (turn, loss_start, loss_end) is trained on
    ``formatted[0:loss_end + len(END)]`` with the loss on the code points from
    ``loss_start`` to ``loss_end``, end exclusive. A conversation meets in one
    row, as its text is one value.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the order of the fields is the order of the turns
    head = F.concat(F.lit(OPEN), escape(role), F.lit(CLOSE))
    turn = F.struct(
        F.col("turn").alias("turn"),
        role.alias("role"),
        text.alias("order"),
        head.alias("head"),
        escape(text).alias("body"),
    )
    nulls_first = lambda a, b: F.when(a["turn"].eqNullSafe(b["turn"]), _compare(a, b)).otherwise(
        F.when(a["turn"].isNull() | (a["turn"] < b["turn"]), -1).otherwise(1)
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn), nulls_first).alias("t"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(_EXAMPLES).alias("examples"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(t["head"])
        stop = begin + F.length(t["body"])
        number = t["turn"].cast("bigint").alias("turn")
        one = F.array(F.struct(number, begin.alias("loss_start"), stop.alias("loss_end")))
        more = F.when(t["role"] == TARGET_ROLE, F.concat(acc["examples"], one)).otherwise(acc["examples"])
        return F.struct((stop + len(END)).alias("at"), more.alias("examples"))

    return grouped.select(
        "conv_id",
        F.array_join(F.transform("t", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.aggregate("t", start, step)["examples"].alias("examples"),
    )


def _compare(a: Column, b: Column) -> Column:
    """Order of two turns with the same number: by role, then text."""
    same = F.when(a["order"] < b["order"], -1).when(a["order"] > b["order"], 1).otherwise(0)
    return F.when(a["role"] < b["role"], -1).when(a["role"] > b["role"], 1).otherwise(same)


def expand(formatted: DataFrame) -> DataFrame:
    """One row per example: (conv_id, turn, text_end, loss_start, loss_end, target).

    ``target`` is the trainable part of the formatted text, still escaped.
    """
    rows = formatted.select("conv_id", "formatted", F.explode("examples").alias("e"))
    start, end = F.col("e.loss_start"), F.col("e.loss_end")
    target = F.substring(F.col("formatted"), start + 1, end - start)
    return rows.select(
        "conv_id", "e.turn", (end + len(END)).alias("text_end"), "e.loss_start", "e.loss_end", target.alias("target")
    )


def example_texts(formatted: DataFrame) -> DataFrame:
    """Examples with their texts: (conv_id, turn, text, loss_start, loss_end).

    The output grows with the square of the turns of a conversation.
    """
    rows = formatted.select("conv_id", "formatted", F.explode("examples").alias("e"))
    text = F.substring(F.col("formatted"), F.lit(1), F.col("e.loss_end") + len(END))
    return rows.select("conv_id", "e.turn", text.alias("text"), "e.loss_start", "e.loss_end")


def parse(formatted: Column) -> Column:
    """array of (role, text) read back from a formatted text, unescaped."""
    blocks = F.split(formatted, r"<\|end\|>", -1)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)  # nothing follows the last end mark
    return F.transform(
        blocks,
        lambda b: F.struct(
            unescape(F.substring_index(F.substring(b, F.lit(len(OPEN) + 1), F.length(b)), CLOSE, 1)).alias("role"),
            unescape(F.substring(b, F.instr(b, CLOSE) + len(CLOSE), F.length(b))).alias("text"),
        ),
    )
