"""Chat formatting with expressions only.

A conversation's turns are sorted, adjacent turns of one role share a header, and the pieces are joined:

    <|turn|>role<|text|>first text<|more|>second text of the same role<|end|>

Control strings inside roles and texts get a backslash behind their ``<`` (one more, if they have some), which
is undone on reading, so every text comes back as it was. The loss mask lists start and length (code
points, from 0) of each assistant text in the output.

Defined results: a null text or role is empty; turns are ordered by turn (null first), then role and text, so
ties and repeated rows have one order and all stay; the rows of a null conversation are one conversation;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, MORE, END = "<|turn|>", "<|text|>", "<|more|>", "<|end|>"
CONTROL = r"<(\\*)(\|(?:turn|text|more|end)\|>)"
ESCAPED = r"<\\(\\*)(\|(?:turn|text|more|end)\|>)"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"<\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"<$1$2")


def format_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss`` (start, length) of each conversation."""
    clean = lambda c: F.coalesce(F.col(c), F.lit(""))
    role = clean(role_col)
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"), role.alias("role"), clean(text_col).alias("text"), escape(role).alias("safe_role"),
            escape(clean(text_col)).alias("safe_text"),
        ).alias("_t"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("_t")).alias("_turns"))
    nothing = F.lit(None).cast("string")
    spans = F.array().cast("array<struct<start:bigint,length:bigint>>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), nothing.alias("role"), spans.alias("loss"))

    def placed(seen: Column, turn: Column) -> Column:
        """What stands before the text, then the text; spans are noted as the output grows."""
        header = F.length(turn["safe_role"]) + len(TURN) + len(TEXT)
        before = (
            F.when(seen["role"].isNull(), header).when(seen["role"] == turn["role"], len(MORE)).otherwise(header + len(END))
        )
        size = F.length(turn["safe_text"]).cast("bigint")
        span = F.array(F.struct((seen["at"] + before).alias("start"), size.alias("length")))
        loss = F.when(turn["role"] == LEARNED_ROLE, F.concat(seen["loss"], span)).otherwise(seen["loss"])
        return F.struct((seen["at"] + before + size).alias("at"), turn["role"].alias("role"), loss.alias("loss"))

    def piece(turn: Column, i: Column) -> Column:
        previous = F.get(F.col("_turns"), i - 1)["role"]
        header = F.concat(F.lit(TURN), turn["safe_role"], F.lit(TEXT))
        before = F.when(i == 0, header).when(previous == turn["role"], F.lit(MORE)).otherwise(F.concat(F.lit(END), header))
        return F.concat(before, turn["safe_text"])

    return sorted_turns.select(
        "conv_id",
        F.concat(F.array_join(F.transform("_turns", piece), ""), F.lit(END)).alias("formatted"),
        F.aggregate("_turns", start, placed, lambda seen: seen["loss"]).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of ``role``, ``text``."""
    blocks = F.filter(F.split(formatted, r"<\|turn\|>"), lambda b: b != "")

    def turns(block: Column) -> Column:
        head = F.substring_index(block, TEXT, 1)
        body = F.regexp_replace(F.substring(block, F.length(head) + len(TEXT) + 1, F.length(block)), r"<\|end\|>$", "")
        return F.transform(
            F.split(body, r"<\|more\|>", -1), lambda t: F.struct(unescape(head).alias("role"), unescape(t).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )
