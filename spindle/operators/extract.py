"""Edit triplets from model responses: sections, filters, fenced code, instructions; one narrow plan without a UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let, py_strip

# The spellings of the section marks, and what ends a lazy instruction.
OLD_CODE_MARKS = ("### [Program Before Edit]", "[Program Before Edit]", "### Program Before Edit")
DESCRIPTIVE_MARKS = ("### [Descriptive]", "[Descriptive]", "### Descriptive")
LAZY_MARKS = ("### [Lazy]", "[Lazy]", "### Lazy")
NEW_CODE_MARKS = ("### [Program After Edit]", "[Program After Edit]", "### Program After Edit")
LAZY_ENDS = ("###", "---", "[Program Before Edit]", "```")
FENCE = r"```([^\s`]+)?\s*\n((?:[^`]++|`(?!``))*+)```"
INSTRUCTION_TRIM = "-`*#\n "

SECTIONS = ("code_before", "instruct_descriptive", "instruct_lazy", "code_after")


def has_mark(c: Column, marks: tuple[str, ...]) -> Column:
    found = c.contains(marks[0])
    for m in marks[1:]:
        found = found | c.contains(m)
    return found


def _at(mark: str, c: Column) -> Column:
    """Place of a mark from 1, null where it isn't. Bytes are searched and characters counted once, unlike ``locate``."""
    return F.when(c.contains(mark), F.length(F.substring_index(c, mark, 1)) + 1)


def _after(c: Column, marks: tuple[str, ...]) -> Column:
    """The latest place right behind the first occurrence of any spelling."""
    return F.greatest(*[_at(m, c) + len(m) for m in marks])


def _slice(c: Column, start: Column, end: Column) -> Column:
    return py_strip(F.substring(c, start, F.greatest(end - start, F.lit(0))))


def _once(df: DataFrame, struct: Column) -> DataFrame:
    """The fields of a struct as columns. The generator is a bar to the optimizer, which would compute the struct anew for
    each filter or column that reads a field."""
    return df.select("*", F.inline(F.array(struct)))


def separate_sections(df: DataFrame, response_1: str = "response_1", response_2: str = "response_2") -> DataFrame:
    """Adds ``code_before, instruct_descriptive, instruct_lazy, code_after, reason``.

    ``reason`` is ``missing_mark`` or ``empty_section`` for rows to reject, else null. The old code may be empty. Columns
    that have these names are replaced.
    """
    df = df.drop(*(set((*SECTIONS, "reason")) - {response_1, response_2}))
    def sections(one: Column, two: Column) -> Column:
        earliest = lambda marks: F.least(*[_at(m, one) for m in marks])
        cut = lambda start, end: let(start, lambda s: _slice(one, s, end(s)))
        until = lambda rest: py_strip(F.substring(rest, F.lit(1), F.coalesce(F.least(*[_at(m, rest) for m in LAZY_ENDS]) - 1, F.length(rest))))
        marked = has_mark(one, OLD_CODE_MARKS) & has_mark(one, DESCRIPTIVE_MARKS) & has_mark(one, LAZY_MARKS) & has_mark(two, NEW_CODE_MARKS)
        return F.struct(
            cut(_after(one, OLD_CODE_MARKS), lambda s: earliest(DESCRIPTIVE_MARKS)).alias("code_before"),
            cut(_after(one, DESCRIPTIVE_MARKS), lambda s: earliest(LAZY_MARKS)).alias("instruct_descriptive"),
            let(F.substring(one, _after(one, LAZY_MARKS), F.length(one)), until).alias("instruct_lazy"),
            let(_after(two, NEW_CODE_MARKS), lambda s: _slice(two, s, F.length(two) + 1)).alias("code_after"),
            marked.alias("marked"),
        )

    def judged(s: Column) -> Column:
        empty = (s["code_after"] == "") | (s["instruct_descriptive"] == "") | (s["instruct_lazy"] == "")
        return F.struct(*[s[f].alias(f) for f in SECTIONS], F.when(~s["marked"], "missing_mark").when(empty, "empty_section").alias("reason"))

    one, two = (F.coalesce(F.col(c), F.lit("")) for c in (response_1, response_2))
    found = let(let(one, lambda x: let(two, lambda y: sections(x, y))), judged)
    return _once(df, found)


def is_single_line(c: Column) -> Column:
    """Junk code: one line, a box-drawing line, or a shell prompt; null passes."""
    return F.coalesce(let(c, lambda x: ~x.contains("\n") | x.contains("─") | x.rlike(r"(?U)\A[\s\x1c-\x1f]*\$")), F.lit(False))


def filter_single_line(df: DataFrame, fields: tuple[str, ...] = ("code_before", "code_after")) -> DataFrame:
    for f in fields:
        df = df.filter(~is_single_line(F.col(f)))
    return df


def purified_code(c: Column, keep_language_mark: bool = False, strict_lang_line: bool = False) -> Column:
    """The first fenced block that isn't markdown, else the first; null if there is none or it is blank.

    Code that begins with ``python`` loses its first line, as the language may stand on a line of its own;
    ``strict_lang_line`` takes only a line that is nothing else.
    """
    def blocks(text: Column) -> Column:
        group = lambda k: F.regexp_extract_all(text, F.lit("(?U)" + FENCE), F.lit(k))
        return F.transform(F.arrays_zip(group(1).alias("lang"), group(2).alias("code")), lambda b: F.struct(b["lang"].alias("lang"), b["code"].alias("code")))

    def chosen(found: Column) -> Column:
        other = F.filter(found, lambda b: F.lower(b["lang"]) != "markdown")
        return F.coalesce(F.try_element_at(other, F.lit(1)), F.try_element_at(found, F.lit(1)))

    def shaped(code: Column, lang: Column) -> Column:
        newline = F.locate("\n", code)
        led = (py_strip(F.substring_index(code, "\n", 1)) == "python") if strict_lang_line else code.startswith("python")
        rest = F.when(newline > 0, F.substring(code, newline + 1, F.length(code))).otherwise("")
        out = F.when(led, rest).otherwise(code)
        if keep_language_mark:
            lang = F.when(led, "python").otherwise(lang)
            out = F.when(lang != "", F.concat(F.lit("## "), lang, F.lit("\n"), out)).otherwise(out)
        return F.when(code != "", out)

    return let(let(let(c, blocks), chosen), lambda b: let(py_strip(b["code"]), lambda code: shaped(code, b["lang"])))


def purified_instruction(c: Column) -> Column:
    return F.btrim(c, F.lit(INSTRUCTION_TRIM))


def purify(df: DataFrame, code_fields: tuple[str, ...] = ("code_before", "code_after"), instruction_fields: tuple[str, ...] = ("instruct_descriptive", "instruct_lazy"), drop_unpurified: bool = False, **options) -> DataFrame:
    """Adds ``{field}_purify``, or replaces it. A row without fenced code stays, with null, unless ``drop_unpurified``."""
    df = df.drop(*(f"{f}_purify" for f in (*code_fields, *instruction_fields)))
    code = [purified_code(F.col(f), **options).alias(f"{f}_purify") for f in code_fields]
    df = _once(df, F.struct(*code, *[purified_instruction(F.col(f)).alias(f"{f}_purify") for f in instruction_fields]))
    return df.dropna(subset=[f"{f}_purify" for f in code_fields]) if drop_unpurified else df
