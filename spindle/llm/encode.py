"""Encoding of whole texts with a byte-level BPE file of the tokenizers library, piece by piece where that is the same."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes that one worker's remembered pieces may take, over all its encoders, and the longest piece that is remembered.
REMEMBERED, LONGEST = 40 << 20, 64
#: Bytes of a dictionary's entry besides its text and ids.
_ENTRY = 190
#: Bytes that note which pieces came once, a byte for each hash; they are part of those for remembered pieces.
_ONCE = 1 << 22

# What counts as white space somewhere, but for the space and the line end.
_OTHER_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")


# Letters, and then marks but no apostrophe: one pre-token or two, whatever the Unicode version.
_LETTERS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)")
_MARKS = re.compile(r"[!-&(-/:-@\[-`{-~]+")

#: Texts that are cut together have so many bytes, but for a longer single one; pieces that are looked up together.
_GROUP, _WINDOW = 1 << 19, 1 << 16
_U = np.uint64
_IS_MARK, _IS_ALPHA = (np.array([bool(re.fullmatch(f, chr(b))) for b in range(256)]) for f in (r"[!-&(-/:-@\[-`{-~]", "[A-Za-z]"))
_OTHERS = [c.encode() for c in map(chr, range(0x10000)) if _OTHER_SPACE.match(c)]
#: First bytes of other white space, and the characters of one, two and three bytes as numbers.
_MAY_BE_OTHER = np.isin(np.arange(256), [c[0] for c in _OTHERS])
_OTHER_OF = [np.array([int.from_bytes(c) for c in _OTHERS if len(c) == n]) for n in (1, 2, 3)]


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(own)]
    return {b: b for b in own} | {b: 256 + k for k, b in enumerate(other)}


def _unsafe(text: str) -> bool:
    """Whether there is white space that isn't a single space or line end between two other characters."""
    if not text:
        return False
    return text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or bool(_OTHER_SPACE.search(text))


class _Room:
    """What is left of the bytes for remembered pieces: one half is for all that come, the other for those that come again,
    as half of the distinct words of a corpus never do."""

    left, once = REMEMBERED - _ONCE, bytearray(_ONCE)

    @classmethod
    def clear(cls) -> None:
        cls.left, cls.once = REMEMBERED - _ONCE, bytearray(_ONCE)

    @classmethod
    def take(cls, piece: str, ids: bytes) -> bool:
        left = cls.left
        if left < _ENTRY or len(piece) > LONGEST:
            return False
        need = _ENTRY + len(piece) + len(ids)
        if need > left:
            return False
        if left < REMEMBERED >> 1:
            at = hash(piece) % _ONCE
            if not cls.once[at]:
                cls.once[at] = 1
                return False
        cls.left = left - need
        return True


class _Pieces(dict):
    """Ids of pieces that stand behind ``lead``; a piece that isn't there yet is encoded, and kept while there is room."""

    def __init__(self, encoder: Encoder, lead: str):
        super().__init__()
        self.encoder, self.tokenize, self.lead, self.start = encoder, encoder.tokenize, lead, lead.translate(encoder.letters)

    def __missing__(self, piece: str) -> bytes:
        e = self.encoder
        if piece.isascii() and piece.isalpha():
            ids = array("I", [t.id for t in self.tokenize(self.start + piece)]).tobytes()
        elif m := _LETTERS.fullmatch(piece):
            word, marks = m.groups()
            ids = (self[word] if marks in e.common else e.token(self.start, word)) + e.marks[marks] if marks else e.token(self.start, word)
        else:
            ids = e.whole(self.lead + piece)
        if _Room.take(piece, ids):
            self[piece] = ids
        return ids


class _Marks(dict):
    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, marks: str) -> bytes:
        ids = self.encoder.token("", marks)
        if _Room.take(marks, ids):
            self[marks] = ids
        return ids


class _Table:
    """Ids of pieces of up to 15 bytes, by the bytes themselves: a key is two numbers of eight bytes, the last of which is
    the length. Keys stand at one of few slots from their hash on. One half is for all that come, the rest for those that
    come again. With the ids it takes less than ``REMEMBERED``."""

    SLOTS, TRIES, MOST = 1 << 20, 8, 700_000

    def __init__(self, dtype: type):
        self.a, self.b = np.zeros(self.SLOTS, _U), np.zeros(self.SLOTS, _U)
        self.at, self.n = np.zeros(self.SLOTS, np.uint32), np.zeros(self.SLOTS, np.uint8)
        self.ids, self.used, self.kept, self.once = np.zeros((8 << 20) // np.dtype(dtype).itemsize, dtype), 0, 0, np.zeros(_ONCE, bool)

    def _hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = a * _U(0x9E3779B97F4A7C15) ^ b * _U(0xC2B2AE3D27D4EB4F)
        return (h ^ h >> _U(29)) * _U(0xBF58476D1CE4E5B9)

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> _U(44)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it isn't there."""
        out, at, slot = np.full(len(a), -1), np.arange(len(a)), self._slot(self._hash(a, b))
        for _ in range(self.TRIES):
            there = self.b[slot]
            hit = (there == b) & (self.a[slot] == a)
            out[at[hit]] = slot[hit]
            on = ~hit & (there != 0)
            if not on.any():
                break
            at, slot, a, b = at[on], slot[on] + 1 & self.SLOTS - 1, a[on], b[on]
        return out

    def add(self, a: np.ndarray, b: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        """Remembers keys that differ and aren't there, each with the next ``n`` of ``ids``, while there is room."""
        first, h = np.cumsum(n) - n, self._hash(a, b)
        if self.kept > self.MOST // 2:
            mark = (h >> _U(20)).astype(np.int64) % _ONCE
            again = np.flatnonzero(self.once[mark])
            self.once[mark] = True
        else:
            again = np.arange(len(a))
        again = again[: max(0, self.MOST - self.kept)]
        again = again[np.cumsum(n[again]) <= len(self.ids) - self.used]
        slot = self._slot(h[again])
        for _ in range(self.TRIES):
            free = np.flatnonzero(self.b[slot] == 0)
            to, k = np.unique(slot[free], return_index=True)
            won = again[free[k]]
            self.a[to], self.b[to], self.n[to] = a[won], b[won], n[won]
            ends = np.cumsum(n[won])
            self.at[to] = self.used + ends - n[won]
            self.ids[self.used : self.used + int(n[won].sum())] = ids[_spread(first[won], n[won])]
            self.used, self.kept = self.used + int(n[won].sum()), self.kept + len(won)
            lost = np.ones(len(again), bool)
            lost[free[k]] = False
            again, slot = again[lost], slot[lost] + 1 & self.SLOTS - 1
            if not len(again):
                break


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first``, and the ``n - 1`` places behind, of each."""
    ends = np.cumsum(n)
    return np.arange(int(ends[-1]) if len(n) else 0) + np.repeat(first - (ends - n), n)


def _whole_texts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """What :func:`_unsafe` says of each text of ``data``; they begin at ``starts``, none is empty."""
    white = (data == 32) | (data == 10)
    bad = np.zeros(len(data), bool)
    bad[1:] = white[1:] & white[:-1]
    bad[starts] |= white[starts]
    bad[np.append(starts[1:], len(data)) - 1] |= white[np.append(starts[1:], len(data)) - 1]
    i = np.flatnonzero(_MAY_BE_OTHER[data])
    if len(i):
        x, y, z = (np.append(data, np.zeros(2, np.uint8))[i + k].astype(np.int64) for k in range(3))
        bad[i] |= np.isin(x, _OTHER_OF[0]) | np.isin(x << 8 | y, _OTHER_OF[1]) | np.isin(x << 16 | y << 8 | z, _OTHER_OF[2])
    return np.logical_or.reduceat(bad, starts)


def _cut(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin: at a space, at and behind a line end, and at a mark behind a letter, where
    a pre-token always ends, as none goes on behind its letters."""
    newline = data == 10
    begins = newline | (data == 32)
    begins[1:] |= newline[:-1]
    letter = _IS_ALPHA[data]
    two = (data[:-1] >= 0xC3) & (data[:-1] <= 0xC8) & ~((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    letter[1:] |= two  # U+00C0 to U+023F
    begins[1:] |= _IS_MARK[data[1:]] & letter[:-1]
    begins[starts] = True
    return np.flatnonzero(begins)


def _by_byte_level(t) -> bool:
    """Whether a tokenizer is plain byte-level BPE, the only kind that may be fed piece by piece."""
    from tokenizers import models, pre_tokenizers

    m, pre = t.model, t.pre_tokenizer
    plain = isinstance(m, models.BPE) and not (m.dropout or m.unk_token or m.continuing_subword_prefix or m.end_of_word_suffix or m.byte_fallback or m.ignore_merges)
    return plain and t.normalizer is None and isinstance(pre, pre_tokenizers.ByteLevel) and not pre.add_prefix_space and pre.use_regex


class Encoder:
    """Ids of whole texts as little-endian uint32 bytes, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    The pre-tokenizer of byte-level BPE never lets a token reach over a space or a line end that stands between two
    characters that are no white space: a space goes with what follows, a line end stands alone. So such a text is cut
    there, each distinct piece goes through the library once, and its ids are remembered. Pieces of letters and marks go
    to the library's model, as its pre-tokenizer would hand them on, the rest through the whole tokenizer. A text with any
    other white space next to a space or line end, or with an added token's string, goes through the tokenizer whole, and
    so does every text where the file is no plain byte-level BPE. :meth:`many` takes a column of texts and looks their
    pieces up together.
    """

    common = (".", ",")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.by_piece = _by_byte_level(self.tokenizer)
        self.tokenize, self.letters = self.tokenizer.model.tokenize, _byte_letters()
        self.newline = self.whole("\n")
        self.marks = _Marks(self)
        self.begins, self.follows = _Pieces(self, ""), _Pieces(self, " ")
        self.table = None

    def whole(self, text: str, special_as_text: bool = False) -> bytes:
        self.tokenizer.encode_special_tokens = special_as_text
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def token(self, start: str, word: str) -> bytes:
        """Ids of one pre-token."""
        seen = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenize(start + seen)]).tobytes()

    def __call__(self, text: str, special_as_text: bool = False) -> bytes:
        """With ``special_as_text``, the string of a special token is ordinary text."""
        if not text:
            return b""
        if not self.by_piece or _unsafe(text) or any(a in text for a in self.added):
            return self.whole(text, special_as_text)
        out, begin, follow = [], self.begins.__getitem__, self.follows.__getitem__
        for line in text.split("\n"):
            pieces = line.split(" ")
            out.append(begin(pieces[0]) + b"".join(map(follow, pieces[1:])))
        return self.newline.join(out)

    def piece(self, piece: str) -> array:
        """Ids of a piece that :func:`_cut` gives."""
        start, body = ("\u0120", piece[1:]) if piece[0] == " " else ("", piece)
        if body.isascii() and body.isalpha():
            return array("I", [t.id for t in self.tokenize(start + body)])
        if (m := _LETTERS.fullmatch(body)) and not m[2] or not start and _MARKS.fullmatch(body):
            return array("I", self.token(start, body))
        return array("I", self.whole(piece))

    def _encode_pieces(self, raw: bytes, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after the other, and their numbers; 16 bytes more follow in ``raw``."""
        words = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
        low = np.append((_U(1) << np.arange(0, 64, 8, dtype=_U)) - _U(1), ~_U(0))
        a = words[begins] & low[np.minimum(sizes, 8)]
        b = words[begins + 8] & low[np.clip(sizes - 8, 0, 7)] | sizes.astype(_U) << _U(56)
        short = sizes < 16
        slot = np.where(short, self.table.find(a, b), -1)
        there = slot >= 0
        n = np.where(there, self.table.n[slot], 0).astype(np.int64)
        out = self.table.ids[_spread(np.where(there, self.table.at[slot], 0), n)].astype(np.uint32, copy=False)
        missed = np.flatnonzero(~there)
        if len(missed):
            new: dict[bytes, int] = {}
            which = np.array([new.setdefault(raw[x:y], len(new)) for x, y in zip(begins[missed].tolist(), (begins + sizes)[missed].tolist())])
            found = [self.piece(p.decode()) for p in new]
            ids, each = np.frombuffer(b"".join(found), np.uint32), np.array([len(x) for x in found])
            first = np.cumsum(each) - each
            n[missed] = each[which]
            own, out, here = out, np.empty(int(n.sum()), np.uint32), np.repeat(there, n)
            out[here], out[~here] = own, ids[_spread(first[which], each[which])]
            at = missed[np.unique(which, return_index=True)[1]]
            keep = short[at]
            self.table.add(a[at[keep]], b[at[keep]], ids[_spread(first[keep], each[keep])], each[keep])
        return out, n

    def many(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, in order; many pieces are looked up together. Null counts as empty."""
        if texts.null_count:
            texts = pa.array([x or "" for x in texts.to_pylist()], texts.type)
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(texts.type) else np.int32)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(data or b"", np.uint8)
        k = 0
        while k < len(texts):
            end = max(k + 1, int(np.searchsorted(offsets, offsets[k] + _GROUP, "right")) - 1)
            yield from self._group(data[offsets[k] : offsets[end]], offsets[k : end + 1] - offsets[k])
            k = end

    def _group(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        raw = data.tobytes()
        sizes = np.diff(offsets)
        full = np.flatnonzero(sizes)
        whole = np.zeros(len(sizes), bool)
        if len(full):
            whole[full] = not self.by_piece or _whole_texts(data, offsets[full])
        for added in (x.encode() for x in self.added):
            if added in raw:
                whole |= [added in raw[x:y] for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        if whole.any():
            cut = np.repeat(~whole, sizes)
            pieced, at = data[cut], np.concatenate([[0], np.cumsum(sizes * ~whole)])
        else:
            pieced, at = data, offsets
        starts = at[:-1][np.diff(at) > 0]
        parts, number = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        begins = _cut(pieced, starts) if len(starts) else np.zeros(0, np.int64)
        if len(begins) and self.table is None:
            self.table = _Table(np.uint16 if self.largest < 1 << 16 else np.uint32)
        padded, piece_sizes = pieced.tobytes() + bytes(16), np.diff(np.append(begins, len(pieced)))
        for k in range(0, len(begins), _WINDOW):
            ids, n = self._encode_pieces(padded, begins[k : k + _WINDOW], piece_sizes[k : k + _WINDOW])
            parts.append(ids)
            number.append(n)
        ids, before = np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(number))])
        bounds = before[np.searchsorted(begins, at)].tolist()
        for k, alone in enumerate(whole.tolist()):
            yield np.frombuffer(self.whole(raw[offsets[k] : offsets[k + 1]].decode()), np.uint32) if alone else ids[bounds[k] : bounds[k + 1]]

    @property
    def largest(self) -> int:
        return max(self.tokenizer.get_vocab_size(with_added_tokens=False) - 1, *self.added.values(), 0)

    def is_produced(self, token: int) -> bool:
        """Whether ordinary text can give this id: no special token and within the vocabulary."""
        return token not in self.added.values() and self.tokenizer.id_to_token(token) is not None


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per worker; that of another file takes its place."""
    _Room.clear()
    return Encoder(path)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
