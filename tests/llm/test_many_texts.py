"""Encoding of many texts together, as the token store does it."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from spindle.llm import encode


@pytest.fixture
def want():
    t = Tokenizer.from_file(encode.tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


PARTS = [*"abéß Z1.,'s$%!|\n\t\r\x0b\x1c\x85 　漢ñ×÷ɂ​⁠᠎“", "<|endoftext|>", "'re", "  ", "word", " the", " averylongwordindeedlonger", "É,", "words("]


def test_many_equal_library(monkeypatch, want):
    """Also in small groups and windows, from a slice of a column, and where nearly nothing is remembered."""
    r = random.Random(5)
    texts = [None, "", *("".join(r.choice(PARTS) for _ in range(r.randint(0, 12))) for _ in range(2000))]
    texts += [t for t in texts if t and not encode._unsafe(t)]
    for group, window, most, tries in ((1 << 20, 1 << 16, 700_000, 8), (64, 5, 40, 1)):
        monkeypatch.setattr(encode, "_GROUP", group)
        monkeypatch.setattr(encode, "_WINDOW", window)
        monkeypatch.setattr(encode._Table, "MOST", most)
        monkeypatch.setattr(encode._Table, "TRIES", tries)
        e = encode.Encoder(encode.tokenizer_path())
        for _ in range(2):  # the second time from what is remembered
            got = list(e.many(pa.array(["x", *texts, "y"])[1:-1]))
            assert [x.tolist() for x in got] == [want(t) for t in texts]
        assert e.table.kept <= most


def test_pieces_are_looked_up_together(monkeypatch, want):
    """What is remembered goes to no Python call per word, a word is remembered with and without marks at once, and one half is
    for pieces that come again."""
    e = encode.Encoder(encode.tokenizer_path())
    calls = []
    monkeypatch.setattr(encode.Encoder, "piece", lambda self, p, own=encode.Encoder.piece: calls.append(p) or own(self, p))
    monkeypatch.setattr(encode.Encoder, "__call__", None)
    assert next(e.many(pa.array(["late word late, (word"]))).tolist() == want("late word late, (word")
    assert sorted(calls) == [" (word", " late", " word", ",", "late"]
    list(e.many(pa.array([" ".join(["late", "word,", "late."] * 5000)])))
    assert len(calls) == 6
    monkeypatch.setattr(encode._Table, "MOST", 2000)
    letters = np.array(list("abcdefghij"))
    once = ["q" + "".join(letters[[int(c) for c in f"{k:07d}"]]) for k in range(3000)]
    for k in range(0, 3000, 100):
        list(e.many(pa.array([" ".join(once[k : k + 100])])))
    assert 1000 <= e.table.kept < 1200
    for _ in range(3):
        calls.clear()
        assert next(e.many(pa.array(["x newcomer"]))).tolist() == want("x newcomer")
    assert calls == []
