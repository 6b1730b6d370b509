"""Tokens of code: equal to those of Pygments' lexer as it is, and few steps for plain text."""

import random
import re

from pygments.lexers.python import PythonLexer
from pygments.token import Name

from spindle.functions import code_tokens

PIECES = [
    "match", "case", "lazy", "from", "import", "def", "class", "async for", "yield from", "in", "is", "not", "None", "print", "self", "__init__", "__name__", "_", "a_b", "camelCase",
    "HTTPServer", "rb", "f", "u", "x", "été", "Ünï", "привет", "日本", "ª", "a·b", "İx", "ß", "1", "1e5", "3in", "0x1f", ".5", "5.", "...", "->", ":=", ":", "=", "==", "!=", "<<", '"', "'", '"""', "'''",
    "\\", "\\\n", "\n", "\n  ", "\n\t", " ", "\x0c", "\x1c", ",", ";", "(", ")", "[", "]", "{", "}", "@", "#", "?", "!", "$", "~", "%", "&", "|", "^", "/", "*", "-", "`", "\r", "%s", "{x}", "match x", "ValueError", "len", "as",
]


def by_rules(code):
    """Each token by the rules of the lexer."""
    out = []
    for kind, value in PythonLexer(stripall=True).get_tokens(code):
        value = value.strip()
        if kind in (Name, Name.Function, Name.Variable):
            out += re.sub(r"(?<=[a-z])(?=[A-Z])|_", " ", value).lower().split()
        elif value:
            out.append(value.lower())
    return out


def test_tokens_are_those_of_the_rules():
    r = random.Random(5)
    for _ in range(4000):
        code = "".join(r.choice(PIECES) + r.choice(["", "", " "]) for _ in range(r.randint(1, 14)))
        assert code_tokens.code_token_list(code) == by_rules(code), repr(code)


def test_plain_text_is_one_token_of_the_lexer():
    """Fifty rules for each word made the tokens of a large table take too long."""
    lexer, plain = code_tokens._lexer()
    text = "The quick brown fox, said Böhm; jumps_over the lazyDog.\nNext lines (two) too: done."
    kinds = [kind for kind, _ in lexer.get_tokens(text)]
    assert kinds.count(plain) == len(kinds) and len(kinds) <= 2
    assert code_tokens.code_token_list(text) == by_rules(text)
