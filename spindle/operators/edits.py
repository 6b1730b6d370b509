"""Edit pairs out of plain texts: the text, and what is left of it without some of its lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import splitlines


def line_edits(df: DataFrame, key: str, text: str, full: str = "code_before_purify", cut: str = "code_after_purify") -> DataFrame:
    """Adds ``full``, the distinct lines of a text, and ``cut``, those whose hash with key and place doesn't begin with 0.

    One of sixteen lines is missing on average. Which ones depends on the key alone; native and narrow. A null text gives
    nulls.
    """
    lines = F.array_distinct(splitlines(text))
    kept = F.filter("__lines", lambda line, i: F.substring(F.md5(F.concat_ws(":", F.col(key).cast("string"), (i + 1).cast("string"))), 1, 1) != "0")
    d = df.withColumn("__lines", lines)
    return d.withColumns({full: F.array_join("__lines", "\n"), cut: F.array_join(kept, "\n")}).drop("__lines")
