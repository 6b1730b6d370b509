"""Tokens of Python code through Pygments, and of edit prompts."""

from __future__ import annotations

import re
from functools import cache
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pieces import by_pieces
from .text import is_alpha, is_identifier, py_strip, word_tokens

# Tokens of code that say nothing of its topic.
CODE_STOP_WORDS = [
    "def", "return", "import", "from", "as", "class", "if", "else", "elif", "for", "while", "in", "break", "continue",
    "None", "True", "False", "try", "except", "finally", "with", "pass", "print", "self", "assert", "yield", "global", "lambda",
    "nonlocal", "and", "or", "not", "is", "=", "==", "!=", "===", "!==", ">", "<", ">=", "<=",
    "+", "-", "*", "/", "%", "**", "//", "&", "|", "^", "~", "<<", ">>", "+=",
    "-=", "*=", "/=", "%=", "**=", "//=", "&=", "|=", "^=", "~=", "<<=", ">>=", "(", ")",
    "[", "]", "{", "}", ",", ".", ":", ";",
]

# The English stop words of NLTK's corpus (179 words).
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll", "you'd", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's",
    "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "that'll",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having",
    "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until",
    "while", "of", "at", "by", "for", "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again", "further",
    "then", "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more",
    "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very",
    "s", "t", "can", "will", "just", "don", "don't", "should", "should've", "now", "d", "ll", "m", "o",
    "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't",
    "hasn", "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't", "shan",
    "shan't", "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
]


#: Where a camelCase or snake_case name is parted, and what a run of plain text consists of.
_PARTS, _PLAIN = re.compile(r"(?<=[a-z])(?=[A-Z])|_"), re.compile(r"[0-9a-zß-öø-ÿ]+|[^\s0-9a-zß-öø-ÿ]")


@cache
def _lexer() -> tuple[Any, Any]:
    """Pygments' lexer of Python, which takes runs of plain text as one token, and the kind of that token.

    Its rules are tried in turn at each token, and that of names is the last of some fifty. In a run are words that no rule
    names, which are names wherever they stand outside of strings, unless a quote follows; blanks that begin no line, where
    docstrings and soft keywords are looked for; and marks that begin no longer token. All else goes by the rules.
    """
    from pygments.lexer import inherit, words
    from pygments.lexers.python import PythonLexer
    from pygments.regexopt import regex_opt
    from pygments.token import Token

    named = {"in", "is", "and", "or", "not", "self", "Ellipsis", "NotImplemented", "cls", "match", "case", "lazy", "from", "import", "def", "class"}
    for state in ("keywords", "expr-keywords", "builtins", "magicfuncs", "magicvars"):
        named.update(w.split()[0] for rule in PythonLexer.tokens[state] if isinstance(rule[0], words) for w in rule[0].words)
    word = regex_opt(named, prefix="(?!", suffix=r"\b)") + r"[A-Za-zÀ-ÖØ-öø-ÿ][0-9A-Za-z_À-ÖØ-öø-ÿ]*(?=[\x00-!#-&(-/:-@\[-^`{-\x7f]|\Z)"
    run = rf"(?:{word}|\n|(?!^)[^\S\n]+|[,;(){{}}\[\]*/+-]|:(?!=)|\.(?!\d))+"

    class Plain(PythonLexer):
        tokens = {"root": [(run, Token.Plain), inherit]}

    return Plain(stripall=True), Token.Plain


def code_token_list(code: str) -> list[str]:
    """Lower-case tokens; plain, function and variable names in their camelCase and snake_case parts."""
    from pygments.token import Name

    lexer, plain = _lexer()
    out: list[str] = []
    for kind, value in lexer.get_tokens(code):
        if kind is plain:
            out += _PLAIN.findall(_PARTS.sub(" ", value).lower())
            continue
        value = value.strip()
        if kind in (Name, Name.Function, Name.Variable):
            out += _PARTS.sub(" ", value).lower().split()
        elif value:
            out.append(value.lower())
    return out


@F.arrow_udf(T.ArrayType(T.StringType()))
def _code_tokens(code: pa.Array) -> pa.Array:
    return by_pieces(pa.list_(pa.string()), code_token_list, code)


def code_tokens(c: Column | str) -> Column:
    return _code_tokens(c)


def split_edit_prompt(c: Column) -> tuple[Column, Column]:
    """Code and instruction of an edit prompt; empty where a marker is missing. A fence round the whole code goes."""
    code = py_strip(F.regexp_extract(c, r"(?s)## Code Before:(.*?)## Instruction:", 1))
    fenced = code.startswith("```") & code.endswith("```")
    bare = F.regexp_replace(F.regexp_replace(code, r"\A```[a-zA-Z]*\n?", ""), r"\n?```\z", "")
    return F.when(fenced, bare).otherwise(code), py_strip(F.regexp_extract(c, r"(?s)## Instruction:(.*?)## Code After:", 1))


def topic_tokens(c: Column, stop_words: list[str] = ENGLISH_STOP_WORDS) -> Column:
    """The document of the topic model: identifiers of the code, then words of the instruction, without stop words."""
    code, instruction = split_edit_prompt(c)
    names = F.filter(code_tokens(code), lambda t: is_identifier(t) & ~t.isin(*CODE_STOP_WORDS))
    words = F.filter(word_tokens(instruction), lambda t: is_alpha(t) & ~t.isin(*stop_words))
    return F.concat(names, words)


def register(spark) -> None:
    """``code_tokens`` for SQL."""
    spark.udf.register("code_tokens", _code_tokens)
