"""Fine-tuning records in the Alpaca and ShareGPT layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import seeded
from ..sources.jsonl import edit_prompt_text

SYSTEM = "You edit code as you are told."


def fenced(code: Column, language: str) -> Column:
    return F.concat(F.lit(f"```{language}\n"), code, F.lit("\n```"))


def edit_prompt(old: Column, instruction: Column, new: Column, before: str | None = None, after: str | None = None) -> Column:
    """Old code, instruction and new code under their headings; code is fenced where a language is given."""
    old = fenced(old, before) if before else old
    new = fenced(new, after) if after else new
    return F.concat(edit_prompt_text(old, instruction), new)


def format_records(df: DataFrame, layout: str = "share_gpt", seed: int = 42, row_key: tuple[str, ...] = ("commit", "instr_type"), language: str = "python", system: str = SYSTEM, no_thinking_tag: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """``mixed`` records as fine-tuning records.

    About half of the prompts fence the old code, by the parity of a hash of seed and key. The answer is always fenced.
    Columns named in ``keep`` come first, as they are.
    """
    if layout not in ("alpaca", "share_gpt"):
        raise ValueError(f"unknown layout {layout!r}")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    old, new, instruction = text("code_before_purify"), text("code_after_purify"), text("instruct_purify")
    odd = F.conv(F.substring(seeded(seed, *row_key), 1, 1), 16, 10).cast("int") % 2 == 1
    user = F.when(odd, edit_prompt_text(fenced(old, language), instruction)).otherwise(edit_prompt_text(old, instruction))
    if no_thinking_tag:
        user = F.concat(user, F.lit(" /no_think"))
    answer = fenced(new, language)
    meta = [text("commit").alias("commit"), F.coalesce("instr_type", F.lit("unknown")).alias("instr_type"), old.alias("old_code"), new.alias("new_code")]
    if layout == "alpaca":
        return df.select(*keep, user.alias("instruction"), F.lit(system).alias("system"), answer.alias("output"), *meta)
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return df.select(*keep, F.array(turn("system", F.lit(system)), turn("user", user), turn("assistant", answer)).alias("messages"), *meta)
