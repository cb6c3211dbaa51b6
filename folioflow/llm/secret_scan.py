"""Secrets in text: keyword automaton first, anchored patterns only at its hits, checksums last.

One Aho-Corasick pass over a text finds every keyword, in both letter cases by listing the
variants, so that offsets are those of the text. A kind's pattern is tried only where one of its
keywords starts; a match must then pass the kind's own test: a length, or the checksum that the
token carries. Runs of hexadecimal digits have no keyword and are found by their pattern alone.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from itertools import product

import ahocorasick
from pyspark.sql import DataFrame

from folioflow.llm.common import map_texts, narrow

# The digit order of the two encodings.
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def base62_crc(body: str) -> str:
    """CRC-32 of the body as six base-62 digits, the tail of prefixed platform tokens."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = BASE62[digit] + out
    return out


def _crc_holds(found: re.Match) -> bool:
    token = found[1]
    return base62_crc(token[:-6]) == token[-6:]


def _base58_holds(found: re.Match) -> bool:
    """Base58Check: the last four bytes are the double SHA-256 of the rest."""
    value = 0
    for letter in found[0]:
        value = value * 58 + BASE58.index(letter)
    try:
        raw = value.to_bytes(82, "big")
    except OverflowError:
        return False
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


@dataclass(frozen=True)
class Kind:
    """``keywords`` start a match of ``pattern``; ``any_case`` lists their case variants too."""

    name: str
    keywords: tuple[str, ...]
    pattern: str
    holds: Callable[[re.Match], bool]
    any_case: bool = False


# What counts as a secret, in the order in which spans are listed.
KINDS = (
    Kind("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"),
         r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         lambda m: len(m[2]) >= 8, any_case=True),
    Kind("access", ("AKIA",), r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    Kind("hex", (), r"[0-9a-f]{32,}", lambda m: True),
    Kind("platform", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
         r"(?:gh[pousr]|npm)_([A-Za-z0-9]{36})(?![A-Za-z0-9])", _crc_holds),
    Kind("hdkey", ("xprv",), r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])", _base58_holds),
)


@lru_cache(maxsize=4)
def _compiled(kinds: tuple[Kind, ...]):
    automaton = ahocorasick.Automaton()
    starts: dict[str, list[int]] = {}
    for at, kind in enumerate(kinds):
        for word in kind.keywords:
            cases = product(*({c.lower(), c.upper()} for c in word)) if kind.any_case else [word]
            for form in cases:
                starts.setdefault("".join(form), []).append(at)
    for form, owners in starts.items():
        automaton.add_word(form, (len(form), owners))
    if starts:
        automaton.make_automaton()
    return automaton if starts else None, [re.compile(k.pattern, re.ASCII) for k in kinds]


def find_spans(text: str, kinds: tuple[Kind, ...] = KINDS) -> list[tuple[int, int, int]]:
    """``start, kind's number, end`` in order. Per kind leftmost and non-overlapping: a match that
    fails its test still covers its characters."""
    automaton, patterns = _compiled(kinds)
    hits: dict[int, list[int]] = {}
    if automaton is not None:
        for end, (length, owners) in automaton.iter(text):
            for at in owners:
                hits.setdefault(at, []).append(end - length + 1)
    spans = []
    for at, kind in enumerate(kinds):
        if not kind.keywords:
            spans += [(m.start(), at, m.end()) for m in patterns[at].finditer(text) if kind.holds(m)]
            continue
        free = 0
        for start in sorted(hits.get(at, ())):
            if start >= free and (m := patterns[at].match(text, start)):
                free = m.end()
                if kind.holds(m):
                    spans.append((start, at, free))
    return sorted(spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``doc_id`` and ``spans``, an array of kind, start and end in code points, for every row.

    Rows without a secret have an empty array. Spans of different kinds may overlap.
    """
    names = [k.name for k in kinds]

    def run(texts: list[str]) -> dict:
        return {"spans": [
            [{"kind": names[k], "start": a, "end": b} for a, k, b in find_spans(t, kinds)] for t in texts
        ]}

    return map_texts(narrow(docs, id_col, text_col), _typed(run),
                     "spans array<struct<kind:string,start:bigint,end:bigint>>")


def _typed(run):
    import pyarrow as pa

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return lambda texts: {name: pa.array(rows, kind) for name, rows in run(texts).items()}
