"""String and array functions as Columns: no UDF, all inside whole-stage code generation where Spark has it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's str.strip() takes away.
SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_LINE_END = "\r\n|[\n\r\x0b\f\x1c-\x1e\x85  ]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it; keeps nested expressions linear."""
    return F.element_at(F.transform(F.array(value), body), 1)


def py_strip(c: Column | str) -> Column:
    """``str.strip()``: Unicode white space from both ends, which alone are looked at."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(SPACE))


def splitlines(c: Column | str) -> Column:
    """``str.splitlines()``: an empty text has no line, and a line end at the end opens none."""
    lines = F.split(c, _LINE_END, -1)
    return F.when(F.element_at(lines, -1) == "", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)


def seeded(seed: int | str, *key: Column | str) -> Column:
    """A hash rank that depends on seed and key alone: the same on any partitioning, and in any engine with MD5."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in key]))


def hash_int(rank: Column, bound: Column, at: int = 1) -> Column:
    """An integer from 0 to ``bound`` - 1, from eight hexadecimal digits of a rank; for bounds of 2**30 and more the next
    seven digits of it take part too, so that every value can be drawn."""
    digits = lambda n: F.conv(F.substring(rank, at, n), 16, 10).cast("long")
    return F.when(bound < 1 << 30, digits(8)).otherwise(digits(15)) % bound


def split_identifier(c: Column | str) -> Column:
    """camelCase and snake_case parts; ``HTTPServer`` stays whole."""
    return F.filter(F.split(F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2"), r"(?U)[\s_]+"), lambda x: x != "")


def word_tokens(c: Column | str) -> Column:
    """Words at white space, without any character that is no word character, lower-cased."""
    words = F.split(F.lower(F.regexp_replace(c, r"(?U)[^\w\s]+", "")), r"(?U)\s+")
    return F.filter(words, lambda x: x != "")


def is_alpha(c: Column) -> Column:
    return c.rlike(r"^\p{L}+$")


def is_identifier(c: Column) -> Column:
    return c.rlike(r"^[\p{L}_][\p{L}\p{N}_]*$")
