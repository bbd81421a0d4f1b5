r"""Chat formatting checked by a grammar round trip.

A turn is rendered as ``[INST:e]role[/INST]text</s>`` where ``e`` is the escape level of that
turn. Level 0 writes role and text as they are and is taken only if neither holds a control string. The rendered turn
is parsed again; where the recovered role and text differ from the source, the turn is rendered at the next level:

* level 1 puts a backslash behind the first character of each control string in role and text,
* level 2 doubles all backslashes first, which no source text can defeat.

So no control string ever stands inside a rendered role or text. The parser is deterministic: a turn ends at the first
``</s>``, its header at the first ``[/INST]``, and a backslash at level 1 or 2 stands before one literal character. Control
strings hold no backslash and their first characters occur nowhere else in them, so escaping cannot make new ones.

Defined cases: null texts and roles count as empty; rows of a conversation are ordered by turn
(null first), ties by role, then text; repeated rows are turns of their own; rows without a conv_id belong together as
little as they are known to, so each is a conversation of its own; no rows give no rows; extra columns are not read.
A conversation is one output row, so its turns, texts of any length, meet in one task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, HEADER_END, END = "[INST:", "[/INST]", "</s>"
#: What must not stand unescaped inside a role or text.
CONTROLS = ("[INST", "[/INST]", "</s>")


def _guard(text: Column) -> Column:
    for c in CONTROLS:
        text = F.replace(text, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return text


def escape(text: Column, level: int) -> Column:
    if level == 2:
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return _guard(text) if level else text


def unescape(text: Column, level: Column) -> Column:
    plain = text
    for c in CONTROLS:
        plain = F.replace(plain, F.lit(c[0] + "\\" + c[1:]), F.lit(c))
    return (
        F.when(level == 0, text).when(level == 1, plain).otherwise(F.regexp_replace(text, r"(?s)\\(.)", "$1"))
    )


def render(role: Column, text: Column, level: int) -> Column:
    return F.concat(
        F.lit(f"{START}{level}]"), escape(role, level), F.lit(HEADER_END), escape(text, level), F.lit(END)
    )


def parse_turn(body: Column) -> Column:
    """Role, text and level of what stands before a turn's ``</s>``; null where it is no turn."""
    cut = F.instr(body, HEADER_END)
    head, n = len(START), len(HEADER_END)
    level = F.substring(body, head + 1, 1).try_cast("int")
    ok = body.startswith(START) & (F.substring(body, head + 2, 1) == "]") & level.between(0, 2) & (cut > head + 2)
    role = F.substr(body, F.lit(head + 3), cut - (head + 3))
    text = F.substr(body, cut + n)
    return F.when(
        ok,
        F.struct(
            unescape(role, level).alias("role"), unescape(text, level).alias("text"), level.cast("int").alias("level")
        ),
    )


def parse(formatted: Column) -> Column:
    """All turns of a rendered conversation, in order; null where the text doesn't follow the grammar."""
    parts = F.split(formatted, END, -1)
    body = F.slice(parts, F.lit(1), F.size(parts) - 1)
    turns = F.transform(body, parse_turn)
    whole = (F.element_at(parts, -1) == "") & F.forall(turns, lambda t: t.isNotNull())
    return F.when(whole, turns)


def _identical(piece: Column, role: Column, text: Column, level: int) -> Column:
    parts = F.split(piece, END, -1)
    turn = parse_turn(F.element_at(parts, 1))
    whole = (F.size(parts) == 2) & (F.element_at(parts, -1) == "")
    if level == 0:
        whole = whole & ~F.concat_ws("\n", role, text).rlike("|".join(map(re.escape, CONTROLS)))
    return F.coalesce(whole & (turn["role"] == role) & (turn["text"] == text), F.lit(False))


def format_conversations(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, turns, round_trip``.

    ``turns`` holds, in order, code point offsets into ``formatted``: ``start, end`` of each
    turn and ``loss_start, loss_end`` of its text where the role is ``loss_role`` (else both
    equal). ``round_trip`` says that parsing ``formatted`` gives back all source turns.
    """
    rows = conversations.select(
        "conv_id",
        # rows without a conv_id are told apart by a number of their own
        F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("single"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    role, text = F.col("role"), F.col("text")
    piece = render(role, text, 2)
    for level in (1, 0):
        tried = render(role, text, level)
        piece = F.when(_identical(tried, role, text, level), tried).otherwise(piece)
    order = Window.partitionBy("conv_id", "single").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("piece")
    text_length = F.length("piece") - F.instr("piece", HEADER_END) - len(HEADER_END) - len(END) + 1
    placed = (
        rows.withColumn("piece", piece)
        .withColumn("n", F.row_number().over(order))
        .withColumn("start", F.coalesce(F.sum(length.cast("long")).over(before), F.lit(0)))
        .withColumn("end", F.col("start") + length)
        .withColumn("loss_end", F.col("end") - len(END))
        .withColumn(
            "loss_start", F.col("loss_end") - F.when(role == loss_role, text_length).otherwise(0)
        )
    )
    turn = F.struct("n", "start", "end", "loss_start", "loss_end", "piece", "role", "text")
    together = placed.groupBy("conv_id", "single").agg(F.array_sort(F.collect_list(turn)).alias("rows"))
    return (
        together.withColumn("formatted", F.array_join(F.col("rows.piece"), ""))
        .withColumn("parsed", parse(F.col("formatted")))
        .select(
            "conv_id",
            F.size("rows").cast("long").alias("n_turns"),
            "formatted",
            F.transform(
                "rows",
                lambda t: F.struct(t["start"], t["end"], t["loss_start"], t["loss_end"]).cast(
                    "struct<start:bigint,end:bigint,loss_start:bigint,loss_end:bigint>"
                ),
            ).alias("turns"),
            F.coalesce(
                (F.col("parsed.role") == F.col("rows.role")) & (F.col("parsed.text") == F.col("rows.text")),
                F.lit(False),
            ).alias("round_trip"),
        )
    )


def loss_text(formatted: Column, turns: Column) -> Column:
    """The unescaped text under the loss mask, read back from the rendered conversation."""
    pieces = F.slice(F.split(formatted, END, -1), F.lit(1), F.size(turns))
    under = F.zip_with(
        pieces,
        turns,
        lambda p, t: unescape(
            F.substr(p, (t["loss_start"] - t["start"] + 1).cast("int"), (t["loss_end"] - t["loss_start"]).cast("int")),
            F.substring(p, len(START) + 1, 1).cast("int"),
        ),
    )
    return F.array_join(under, "")
