"""Line diffs as Arrow UDFs over the standard library's matcher, whose greedy blocks and junk rule no SQL form gives."""

from __future__ import annotations

import difflib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DIFF
from .pieces import by_pieces

CONTEXT = 3
COUNTS = [f.split()[0] for f in DIFF.split(", ")]


def diff_counts(old: str, new: str, context: int = CONTEXT) -> tuple[int, int, int, int, int]:
    """``added, removed, modified, hunk_num, diff_hunk_num`` of two texts by lines.

    A replaced run counts its longer side as modified. A run of more than twice ``context`` equal lines parts two hunks;
    shorter equal runs lie inside one, also when nothing differs. ``diff_hunk_num`` counts the hunks of a unified diff,
    which are the same but for equal texts, which have none.
    """
    a, b = old.splitlines(), new.splitlines()
    if a == b:
        return 0, 0, 0, int(0 < len(a) <= 2 * context), 0
    tally = dict.fromkeys(("insert", "delete", "replace"), 0)
    ops = difflib.SequenceMatcher(None, a, b).get_opcodes()
    for kind, i, j, k, m in ops:
        if kind != "equal":
            tally[kind] += max(j - i, m - k)
    hunks = sum(inside for inside, _ in groupby(ops, lambda op: op[0] != "equal" or op[2] - op[1] <= 2 * context))
    return tally["insert"], tally["delete"], tally["replace"], hunks, hunks


@F.arrow_udf(T.StructType([T.StructField(n, T.IntegerType()) for n in COUNTS]))
def _line_diff(old: pa.Array, new: pa.Array) -> pa.Array:
    return by_pieces(pa.struct([(n, pa.int32()) for n in COUNTS]), lambda a, b: dict(zip(COUNTS, diff_counts(a, b))), old, new)


@F.arrow_udf(T.StringType())
def _unified(old: pa.Array, new: pa.Array) -> pa.Array:
    return by_pieces(pa.string(), lambda a, b: "\n".join(difflib.unified_diff(a.splitlines(), b.splitlines(), lineterm="")), old, new)


def line_diff(old: Column | str, new: Column | str) -> Column:
    """A struct of five counts; see :func:`diff_counts`. Null texts are empty."""
    return _line_diff(old, new)


def unified_diff(old: Column | str, new: Column | str) -> Column:
    """The text of a unified diff, lines joined by line ends. Null texts are empty."""
    return _unified(old, new)


def register(spark) -> None:
    """``line_diff`` and ``unified_diff`` for SQL."""
    spark.udf.register("line_diff", _line_diff)
    spark.udf.register("unified_diff", _unified)
