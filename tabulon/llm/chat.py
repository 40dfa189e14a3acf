"""Chat formatting with Spark expressions: sorted turns, merged blocks, one text for each conversation.

The template is

    <|turn:ROLE|>TEXT<|next|>TEXT<|end|><|turn:ROLE|>TEXT<|end|>

where neighbouring turns of one role share a block and ``<|next|>`` stands between their texts.
Inside roles and texts ``~`` becomes ``~0`` and ``<|`` becomes ``<~1|``, so no text can hold a
marker and the change can be undone. Strings of other templates, such as ``</s>`` or ``[INST]``,
are ordinary text here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE_ROLE, NEXT, END = "<|turn:", "|>", "<|next|>", "<|end|>"


def escape(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("~"), F.lit("~0")), F.lit("<|"), F.lit("<~1|"))


def unescape(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("<~1|"), F.lit("<|")), F.lit("~0"), F.lit("~"))


def _role_escape(value: Column) -> Column:
    """A role ends at ``|>``, so its bars are changed as well."""
    return F.replace(escape(value), F.lit("|"), F.lit("~2"))


def _role_unescape(value: Column) -> Column:
    return unescape(F.replace(value, F.lit("~2"), F.lit("|")))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, formatted, n_rows.

    Turns are sorted by turn, then role, then text, so ties and repeated rows have one order and all
    of them stay. Null turns come first; null text or role is empty; a null conv_id is a conversation
    of its own. Other columns are not read. An empty table gives no rows.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    escaped = chats.select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(_role_escape(t["role"]).alias("role"), escape(t["text"]).alias("text"))).alias("turns"),
    )
    # Each turn knows the role before it: the same role continues the block, another opens one.
    pieces = F.transform(
        "turns",
        lambda t, i: F.when(F.get("turns", i - 1)["role"].eqNullSafe(t["role"]), F.concat(F.lit(NEXT), t["text"])).otherwise(
            F.concat(F.when(i > 0, F.lit(END)).otherwise(""), F.lit(OPEN), t["role"], F.lit(CLOSE_ROLE), t["text"])
        ),
    )
    return escaped.select(
        "conv_id",
        F.concat(F.array_join(pieces, ""), F.lit(END)).alias("formatted"),
        F.size("turns").cast("long").alias("n_rows"),
    )


def read_chats(chats: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Read formatted texts back.

    Adds ``blocks`` (array of role and texts, unescaped), ``loss_spans`` (start and length in code
    points of the trained texts inside ``formatted``, still escaped) and ``loss_text`` (these texts
    unescaped and joined with nothing between).
    """
    blocks = F.filter(F.split("formatted", F.lit("<\\|end\\|>")), lambda b: b != "")
    parts = chats.withColumn("_blocks", blocks)
    head = lambda b: F.substring_index(b, CLOSE_ROLE, 1)
    parts = parts.withColumn(
        "_blocks",
        F.transform(
            "_blocks",
            lambda b: F.struct(
                F.length(b).alias("size"),
                (F.length(head(b)) + len(CLOSE_ROLE)).alias("head"),
                _role_unescape(F.substr(head(b), F.lit(len(OPEN) + 1))).alias("role"),
                F.split(F.substr(b, F.length(head(b)) + len(CLOSE_ROLE) + 1), F.lit("<\\|next\\|>")).alias("texts"),
            ),
        ),
    )
    # Where each block starts: the sizes before it, one end marker each.
    starts = F.aggregate(
        "_blocks",
        F.struct(F.array().cast("array<int>").alias("at"), F.lit(0).alias("next")),
        lambda s, b: F.struct(
            F.concat(s["at"], F.array(s["next"])).alias("at"), (s["next"] + b["size"] + len(END)).alias("next")
        ),
        lambda s: s["at"],
    )
    parts = parts.withColumn("_starts", starts)
    spans = F.flatten(
        F.transform(
            F.filter(
                F.arrays_zip(F.col("_blocks").alias("b"), F.col("_starts").alias("s")), lambda z: z["b"]["role"] == trained_role
            ),
            lambda z: F.transform(
                z["b"]["texts"],
                lambda t, i: F.struct(
                    (
                        z["s"]
                        + z["b"]["head"]
                        + F.aggregate(F.slice(z["b"]["texts"], 1, i), F.lit(0), lambda n, x: n + F.length(x) + len(NEXT))
                    ).alias("start"),
                    F.length(t).alias("length"),
                ),
            ),
        )
    )
    parts = parts.withColumn("loss_spans", spans)
    return parts.select(
        *chats.columns,
        F.transform(
            "_blocks",
            lambda b: F.struct(b["role"].alias("role"), F.transform(b["texts"], lambda t: unescape(t)).alias("texts")),
        ).alias("blocks"),
        "loss_spans",
        F.array_join(
            F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), ""
        ).alias("loss_text"),
    )
