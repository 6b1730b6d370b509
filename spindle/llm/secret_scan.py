"""Secret scans: Aho-Corasick keyword prefilter, anchored expressions at the hits, then checksums."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_or_empty

# Fixed values of the base rules.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LEAST = 18
HEX_LEAST = 16

#: Kinds in the order that breaks ties. Those after the first three are added: tokens that embed a checksum, kept only
#: where it agrees. github, npm: the last six characters are a base-62 CRC-32 of the thirty before. age, nostr: Bech32
#: (BIP 173). bip32: Base58Check.
KINDS = ("assign", "access", "hex", "github", "npm", "age", "nostr", "bip32")
_CHECKED = {
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "age": re.compile(r"(AGE-SECRET-KEY-)1([02-9AC-HJ-NP-Z]{58})(?![A-Za-z0-9])"),
    "nostr": re.compile(r"(nsec)1([02-9ac-hj-np-z]{58})(?![A-Za-z0-9])"),
    "bip32": re.compile(r"([xyz]prv[1-9A-HJ-NP-Za-km-z]{107})()(?![A-Za-z0-9])"),
}

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(rf"[0-9a-f]{{{HEX_LEAST},}}")
_HIGH = re.compile(r"[^\x00-\x7f]+")


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word in ASSIGN_KEYWORDS:
        a.add_word(word, ("assign", len(word)))
    a.add_word("akia", ("access", 4))
    for word in ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"):
        a.add_word(word, ("github", 4))
    a.add_word("npm_", ("npm", 4))
    a.add_word("age-secret-key-1", ("age", 16))
    a.add_word("nsec1", ("nostr", 5))
    for word in ("xprv", "yprv", "zprv"):
        a.add_word(word, ("bip32", 4))
    a.make_automaton()
    return a


def _checksum(body: str) -> str:
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = digits[r] + out
    return out


# The alphabets and the generator of Bech32 and Base58Check.
_BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
_GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def _bech32_agrees(name: str, data: str) -> bool:
    name, state = name.lower(), 1
    for value in [*(ord(c) >> 5 for c in name), 0, *(ord(c) & 31 for c in name), *(_BECH32.index(c) for c in data.lower())]:
        top, state = state >> 25, (state & 0x1FFFFFF) << 5 ^ value
        for k, g in enumerate(_GENERATOR):
            state ^= g if top >> k & 1 else 0
    return state == 1


def _base58_agrees(token: str) -> bool:
    n = 0
    for c in token:
        n = n * 58 + _BASE58.index(c)
    if n >> 656:
        return False
    body, check = divmod(n, 1 << 32)
    twice = hashlib.sha256(hashlib.sha256(body.to_bytes(78, "big")).digest()).digest()
    return twice[:4] == check.to_bytes(4, "big")


def _agrees(kind: str, first: str, last: str) -> bool:
    """Whether the checksum inside a token is that of the token."""
    if kind in ("github", "npm"):
        return _checksum(first) == last
    return _base58_agrees(first) if kind == "bip32" else _bech32_agrees(first, last)


def scan(text: str) -> list[tuple[str, int, int]]:
    """Spans ``(kind, start, end)`` in code points, by start, then kind.

    One pass of the automaton over the text, A-Z lower-cased, finds the keywords; each rule is tried only there, anchored.
    As no match can begin elsewhere, taking hits in order and skipping those inside the match before gives the leftmost
    non-overlapping matches of the rule. Runs of hexadecimal digits have no keyword; they are searched as runs.
    """
    low = text.lower() if text.isascii() else _HIGH.sub(lambda m: "\x80" * len(m[0]), text).lower()
    spans, past = [], dict.fromkeys(KINDS, 0)
    for last, (kind, size) in _automaton().iter(low):
        at = last - size + 1
        if at < past[kind]:
            continue
        if kind == "assign":
            if m := _ASSIGN.match(text, at):
                past[kind] = m.end()
                if len(m[2]) >= ASSIGN_LEAST:
                    spans.append((kind, at, m.end()))
        elif kind == "access":
            if m := _ACCESS.match(text, at):
                past[kind] = m.end()
                if m.end() - at >= ACCESS_LEAST:
                    spans.append((kind, at, m.end()))
        elif (m := _CHECKED[kind].match(text, at)) and _agrees(kind, m[1], m[2]):
            past[kind] = m.end()
            spans.append((kind, at, m.end()))
    spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, spans`` (an array of ``kind, start, end`` in code points); a narrow pass.

    Null text counts as empty and has no spans; rows that repeat are scanned alike; extra columns are not read.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [[dict(zip(("kind", "start", "end"), s)) for s in scan(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], ["doc_id", "spans"])

    d = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind:string,start:long,end:long>>")


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(joined([s for s in spans if s[0] in KINDS[:3]]).encode()).hexdigest()
