r"""Chat formatting with DataFrame expressions only.

A conversation becomes one text of blocks, one for each run of turns of one
role: ``### role: `` then each turn's text and ``</turn>``, and a line end
between blocks. Control strings inside texts are broken up by a backslash and
backslashes are doubled, so the turns can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, END, BETWEEN = "### ", "</turn>", "\n"


def escape(text: Column) -> Column:
    r"""``\`` becomes ``\\``, ``### `` becomes ``##\# ``, ``</turn>`` becomes ``<\/turn>``."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit(HEAD), F.lit("##\\# ")), F.lit(END), F.lit("<\\/turn>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    """A role may hold a colon besides: it would end the head."""
    return F.replace(escape(role), F.lit(":"), F.lit("\\:"))


def format_chats(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    trained: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: its id, ``formatted``, and the loss mask ``loss_spans``.

    Turns are in order of ``turn`` (null first), ties by role and text; equal
    rows are turns of their own. A null role or text is empty. A conversation
    is one text, so its rows come together in one row of the result; roles,
    texts and numbers of turns may be of any size, the work is linear in them. The mask
    has a span (start, length, in characters) for each turn of a trained role,
    its escaped text without marks.
    """
    turns = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    until_here = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = turns.select(
        "conv_id", "role", escape(F.col("text")).alias("text"), F.row_number().over(in_order).alias("place"),
        (~F.col("role").eqNullSafe(F.lag("role").over(in_order))).alias("first"),
    )
    # A new block has its head before the text, and a line end before that.
    head = F.concat(F.when(F.col("place") > 1, F.lit(BETWEEN)).otherwise(F.lit("")), F.lit(HEAD), escape_role(F.col("role")), F.lit(": "))
    parts = parts.select(
        "conv_id", "place", F.when(F.col("first"), head).otherwise(F.lit("")).alias("head"), "text", F.length("text").alias("length"),
        F.col("role").isin(*trained).alias("trained"),
    )
    ends = F.sum(F.length("head") + F.col("length") + len(END)).over(until_here.orderBy("place"))
    parts = parts.withColumn("start", (ends - len(END) - F.col("length")).cast("int"))
    chats = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "head", "text", "length", "trained", "start"))).alias("parts"))
    return chats.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["text"], F.lit(END))), "").alias("formatted"),
        F.transform(F.filter("parts", lambda p: p["trained"]), lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"))).alias("loss_spans"),
    )


#: Characters of a piece of a formatted text; a span is cut out of the few pieces it lies in.
PIECE = 1024


def read_chats(chats: DataFrame) -> DataFrame:
    """Adds what can be read back: ``turns`` (role, text) and ``loss_texts``."""
    heads = F.split(F.expr(f"substring(formatted, {len(HEAD) + 1})"), F.concat(F.lit(BETWEEN), F.lit(HEAD)), -1)
    # Possessive: the head of any length is read in a loop, without a way back.
    role = r"(?s)^((?:[^\\:]++|\\.)*+): "
    blocks = F.transform(heads, lambda b: F.struct(F.regexp_extract(b, role, 1).alias("role"), b.alias("text")))
    named = F.transform(
        blocks,
        lambda b: F.struct(
            unescape(b["role"]).alias("role"), F.split(F.substr(b["text"], F.length(b["role"]) + 3), F.lit(END), -1).alias("texts")
        ),
    )
    turns = F.flatten(
        F.transform(
            named,
            lambda b: F.transform(
                # The last part is what stands behind the last end mark: nothing.
                F.slice(b["texts"], F.lit(1), F.size(b["texts"]) - 1),
                lambda t: F.struct(b["role"].alias("role"), unescape(t).alias("text")),
            ),
        )
    )
    pieces = F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def cut(have: Column, span: Column) -> Column:
        first, last = F.floor(span["start"] / PIECE), F.floor((span["start"] + span["length"]) / PIECE)
        around = F.array_join(F.slice(have, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
        return F.substr(around, (span["start"] - first * PIECE + 1).cast("int"), span["length"])

    # The pieces are bound to a variable: they are made once per text, not per span.
    losses = F.transform(F.array(pieces), lambda have: F.transform("loss_spans", lambda span: unescape(cut(have, span))))
    return chats.withColumn("turns", turns).withColumn("loss_texts", losses[0])
