"""Vectorised hashes of the words, shingles and byte windows of one text. All arithmetic is modulo 2**64."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
BASE = U(_BASE)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A random value for each byte.
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)

#: Powers that are kept; a longer text gets its own, which are freed after it.
KEPT_POWERS = 1 << 20
_powers = {_BASE: np.ones(1, U), _INVERSE: np.ones(1, U)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1); the table grows with the texts seen, up to ``KEPT_POWERS``."""
    have = _powers[base]
    if len(have) < n:
        have = np.full(n if n > KEPT_POWERS else min(max(n, 2 * len(have)), KEPT_POWERS), base, U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) <= KEPT_POWERS:
            _powers[base] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def ranges(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte strings data[start:end], from the prefix sums of data."""
    return mixed((sums[end] - sums[start]) * powers(_INVERSE, len(sums))[start] + (end - start).astype(U))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gap = np.concatenate([[True], _SPACE[data], [True]])
    step = np.flatnonzero(gap[1:] != gap[:-1])
    return step[::2], step[1::2]


def words(text: str) -> np.ndarray:
    """A hash for each word ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z lower-cased."""
    whole = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    out = []
    for data in _pieces(whole):
        start, end = word_bounds(data)
        out.append(ranges(prefix_sums(data), start, end))
    return out[0] if len(out) == 1 else np.concatenate([np.zeros(0, U), *out])


def _pieces(data: np.ndarray, size: int = KEPT_POWERS // 2) -> Iterator[np.ndarray]:
    """Parts of a text of about ``size`` bytes, cut at white space: hashing takes many times the memory of its text."""
    at = 0
    while len(data) - at > size:
        end = at + size
        while end < len(data) and not (gap := _SPACE[data[end : end + size]]).any():
            end += size
        if end >= len(data):
            break
        end += int(gap.argmax())
        yield data[at:end]
        at = end
    yield data[at:]


def grams(w: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n words."""
    if len(w) < n:
        return np.zeros(0, U)
    h = w[: len(w) - n + 1].copy()
    for k in range(1, n):
        h = h * U(_BASE) + w[k : len(w) - n + 1 + k]
    return mixed(h)


def shingle_set(text: str, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; with fewer words, of the whole sequence; without any, empty."""
    w = words(text)
    return np.unique(grams(w, min(n, len(w)))) if len(w) else w
