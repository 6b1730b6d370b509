"""Chat formatting with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks of the template. Within a merged block, NEXT divides the texts of adjacent turns of one role.
START, END, NEXT = "<|im_start|>", "<|im_end|>\n", "<|im_next|>"

#: Goes between "<" and "|" of a control string inside a text.
GUARD = "​"


def escape_text(c: Column) -> Column:
    """No ``<|`` is left: each ``<``, k guards, ``|`` gets one guard more, which :func:`unescape_text` takes away."""
    return F.regexp_replace(c, f"<({GUARD}*)\\|", f"<{GUARD}$1|")


def unescape_text(c: Column) -> Column:
    return F.regexp_replace(c, f"<{GUARD}({GUARD}*)\\|", "<$1|")


def escape_role(c: Column) -> Column:
    """A role is one line, so its line ends are escaped too."""
    return escape_text(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(c: Column) -> Column:
    return F.replace(F.replace(unescape_text(c), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, blocks, loss_mask``.

    Turn structs are collected, sorted by turn (ties by role, then text) and adjacent turns of one role become one block:
    ``<|im_start|>role\\n`` texts joined by ``<|im_next|>`` ``<|im_end|>\\n``. Control strings inside texts and roles are
    escaped reversibly. ``loss_mask`` is run-length coded over ``formatted`` in code points: an array of
    ``(trained, n_chars)`` whose trained runs hold the texts of the trained role and nothing else.

    Null text or role counts as empty, null turns come first, null ``conv`` ids form one conversation. Repeated rows are
    repeated turns. An empty table gives no rows; extra columns are not read. A conversation is one row of the result, so
    it has to fit in a row; nothing else is gathered.
    """
    t = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), escape_role(F.coalesce(F.col(role), F.lit(""))).alias("role"), escape_text(F.coalesce(F.col(text), F.lit(""))).alias("text")).alias("t"),
    )
    t = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    places = F.sequence(F.lit(1), F.size("t"))
    # Places where a block begins, and the last place of the block that begins there.
    t = t.withColumn("begin", F.filter(places, lambda i: (i == 1) | (F.get("t", i - 1)["role"] != F.get("t", i - 2)["role"])))
    blocks = F.transform(
        "begin",
        lambda at, k: F.struct(
            F.get("t", at - 1)["role"].alias("role"),
            F.transform(F.slice("t", at, F.coalesce(F.get("begin", k + 1), F.size("t") + 1) - at), lambda x: x["text"]).alias("texts"),
        ),
    )
    t = t.select("conv_id", blocks.alias("blocks"))
    formatted = F.array_join(F.transform("blocks", lambda b: F.concat(F.lit(START), b["role"], F.lit("\n"), F.array_join(b["texts"], NEXT), F.lit(END))), "")
    run = lambda trained, n: F.struct(trained.alias("trained"), n.cast("int").alias("n_chars"))
    mask = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.concat(
                F.array(run(F.lit(False), F.length(b["role"]) + len(START) + 1)),
                F.flatten(
                    F.transform(
                        b["texts"],
                        lambda x, k: F.array(run(b["role"] == trained, F.length(x)), run(F.lit(False), F.when(k + 1 < F.size(b["texts"]), len(NEXT)).otherwise(len(END)))),
                    )
                ),
            ),
        )
    )
    return t.select("conv_id", formatted.alias("formatted"), "blocks", mask.alias("loss_mask"))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation, an array of ``(role, text)``, read back from the string alone."""
    blocks = F.split(formatted, "<\\|im_start\\|>", -1)
    blocks = F.slice(blocks, 2, F.size(blocks))
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.substring(F.substr(b, F.locate("\n", b) + 1), F.lit(1), F.length(b) - F.locate("\n", b) - len(END)), "<\\|im_next\\|>", -1),
                lambda x: F.struct(unescape_role(F.substring_index(b, "\n", 1)).alias("role"), unescape_text(x).alias("text")),
            ),
        )
    )


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped run by run."""
    ends = F.aggregate(
        mask,
        F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<at:int,n:int>>").alias("runs")),
        lambda acc, x: F.struct((acc["at"] + x["n_chars"]).alias("at"), F.when(x["trained"], F.concat(acc["runs"], F.array(F.struct(acc["at"].alias("at"), x["n_chars"].alias("n"))))).otherwise(acc["runs"]).alias("runs")),
        lambda acc: acc["runs"],
    )
    return F.array_join(F.transform(ends, lambda r: unescape_text(F.substr(formatted, r["at"], r["n"]))), "")
