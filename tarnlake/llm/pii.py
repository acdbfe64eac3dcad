"""Personal data in texts, also where it is disguised, with the places in the source text.

Plain identifiers are found by fixed patterns. Disguised ones are found on a normalised text that a
transducer writes: each of its characters remembers the stretch of the source it stands for, so a span found
there is a span of the source. The transducer rewrites

* look-alike characters (full-width and other compatibility forms, those of the space too, digits of any script, Greek and
  Cyrillic letters that look Latin) and drops invisible ones;
* at and dot disguises: [at], (dot), "name at host dot tld" and the like, in four languages;
* runs of spelled digits, with "plus" and "dot" between them.

Plain spans always stay; a disguised span is added where it rests on rewritten characters and overlaps no
plain span of its kind. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from tarnlake.llm import tokens
from tarnlake.llm.common import arrow_map

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match starts at the first digit of a run: starting later in a run fails where starting there fails.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

# Letters of other scripts that look like Latin ones.
_LOOK_ALIKE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q",
    "һ": "h", "ԝ": "w", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "υ": "u",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "ı": "i", "ɑ": "a", "ɡ": "g", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "․": ".", "。": ".",
}
_INVISIBLE = "­​‌‍⁠﻿"
_BETWEEN = " \t\r\n,-\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"     # blanks, also in compatibility forms
_DIGIT_WORDS = [
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
]
_DIGIT = {word: str(i) for line in _DIGIT_WORDS for i, word in enumerate(line.split())}
_DIGIT_BYTES = {form.encode().lower() for word in _DIGIT for form in (word, word.upper())}
_APART = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
_AT, _DOT = "at|ät|arobase|arroba", "dot|punkt|point|punto"
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_BRACKETED = re.compile(rf"(?:(?<!\s)\s+)?{_OPEN}\s*(?:(?P<at>{_AT}|@)|(?P<dot>{_DOT}|\.))\s*{_CLOSE}\s*", re.I)
_PART = r"[A-Za-z0-9-]+"
_AT_WORD = re.compile(rf"(?<!\s)\s+(?:(?P<word>{_AT})\s+|@\s*)|@\s+", re.I)
_DOTTED = rf"(?:(?:\s+(?:{_DOT})\s+|\.){_PART})*"
_HOST_WORDS = re.compile(rf"{_PART}{_DOTTED}\s+(?:{_DOT})\s+{_PART}{_DOTTED}", re.I)
_DOT_WORD = re.compile(rf"(?<!\s)\s+(?:{_DOT})\s+", re.I)
_WORDS = "|".join(sorted(_DIGIT, key=len, reverse=True))
_SPELLED = re.compile(rf"(?:\bplus[\s-]+)?\b(?:{_WORDS})(?:(?:[\s,-]+|\s+(?:{_DOT})\s+)(?:{_WORDS}|[0-9]+)\b){{3,}}", re.I)
_TOKEN = re.compile(rf"(?P<plus>plus)|(?P<dot>{_DOT})|(?P<word>{_WORDS})|(?P<digits>[0-9]+)", re.I)


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    base: bool


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local@host, leftmost and without overlap, by going from one @ to the next."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            last = host.end()
        at = text.find("@", max(at + 1, last))


def _identifiers(text: str) -> Iterator[tuple[str, int, int]]:
    """Plain identifiers, by kind and then start."""
    for start, end in _emails(text):
        yield "email", start, end
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and _luhn(digits):
                yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                yield "phone", m.start(), m.end()


@cache
def _single() -> dict[str, str]:
    """Characters rewritten one by one: compatibility forms of one ASCII character (the space included), decimal digits of
    every script, look-alikes and invisible characters. None is special in a pattern."""
    table = {}
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        if unicodedata.category(c) == "Nd":
            table[c] = str(unicodedata.decimal(c))
        elif form := unicodedata.decomposition(c):
            flat = unicodedata.normalize("NFKC", c)
            if flat == " " or form.startswith("<") and len(flat) == 1 and " " < flat < "\x7f":
                table[c] = flat
    return table | _LOOK_ALIKE | dict.fromkeys(_INVISIBLE, "")


class Mapped:
    """A rewritten text: character i stands for source[start[i]:end[i]]."""

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None):
        self.text = text
        self.start = np.arange(len(text), dtype=np.int32) if start is None else start
        self.end = self.start + np.int32(1) if end is None else end

    def source(self, lo: int, hi: int) -> tuple[int, int]:
        """The stretch of the source that text[lo:hi] stands for."""
        return int(self.start[lo]), int(self.end[hi - 1])

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Apply edits (start, end, replacement), ascending and apart. Each character of a replacement stands for all it replaced."""
        text, start, end, at = [], [], [], 0
        for lo, hi, put in edits:
            text += [self.text[at:lo], put]
            start += [self.start[at:lo], np.repeat(self.start[lo], len(put))]
            end += [self.end[at:lo], np.repeat(self.end[hi - 1], len(put))]
            at = hi
        return Mapped("".join([*text, self.text[at:]]), np.concatenate([*start, self.start[at:]]), np.concatenate([*end, self.end[at:]]))


def _look_alikes(text: str) -> list[tuple[int, int, str]]:
    if text.isascii():
        return []
    table = _single()
    found = table.keys() & set(text)
    pattern = re.compile("[" + "".join(sorted(found)) + "]") if found else None
    return [(m.start(), m.end(), table[m.group()]) for m in pattern.finditer(text)] if found else []


def _brackets(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), "@" if m["at"] else ".") for m in _BRACKETED.finditer(text)]


def _bare(text: str) -> list[tuple[int, int, str]]:
    """A lone at between a local part and a host with a dot word; an @ with blanks around it before any host."""
    edits, last = [], 0
    for m in _AT_WORD.finditer(text):
        if m.start() < last or not m.start() or text[m.start() - 1] not in _LOCAL:
            continue
        host = _HOST_WORDS.match(text, m.end()) or (None if m["word"] else _HOST.match(text, m.end()))
        if host:
            edits.append((m.start(), m.end(), "@"))
            edits += [(d.start(), d.end(), ".") for d in _DOT_WORD.finditer(text, host.start(), host.end())]
            last = host.end()
    return edits


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Each token of a run of spelled digits takes the place up to the next, so separators vanish."""
    edits = []
    if _DIGIT_BYTES.isdisjoint(text.encode().lower().translate(_APART).split()):
        return edits
    for run in _SPELLED.finditer(text):
        found = list(_TOKEN.finditer(text, run.start(), run.end()))
        for token, after in zip(found, [*found[1:], None]):
            value = "+" if token["plus"] else "." if token["dot"] else _DIGIT[token["word"].lower()] if token["word"] else token["digits"]
            for i, c in enumerate(value):
                last = i == len(value) - 1
                lo = token.start() + (i if token["digits"] else 0)
                hi = (after.start() if after else token.end()) if last else lo + 1
                edits.append((lo, hi, c))
    return edits


def normalise(text: str) -> Mapped | None:
    """The text with its disguises rewritten, or None where there are none."""
    mapped = None
    for step in (_look_alikes, _brackets, _bare, _spelled):
        edits = step(mapped.text if mapped else text)
        if edits:
            mapped = (mapped or Mapped(text)).rewrite(edits)
    return mapped


def find(text: str | None) -> list[Span]:
    """All spans of a text, by kind as listed and then start; a null or empty text has none."""
    text = text or ""
    spans = [Span(kind, lo, hi, True) for kind, lo, hi in _identifiers(text)]
    mapped = normalise(text)
    if mapped is not None:
        taken = {kind: [(s.start, s.end) for s in spans if s.kind == kind] for kind in KINDS}     # in order and apart
        for kind, lo, hi in _identifiers(mapped.text):
            start, end = mapped.source(lo, hi)
            if mapped.text[lo:hi] != text[start:end]:
                # A token's place may reach to the next one; what a span ends with is its own token only.
                end = start + len(text[start:end].rstrip(_BETWEEN))
                before = bisect_left(taken[kind], (end,))
                if not before or taken[kind][before - 1][1] <= start:
                    spans.append(Span(kind, start, end, False))
    return sorted(spans, key=lambda s: (KINDS.index(s.kind), s.start, s.end))


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
    for batch in batches:
        for part in tokens.chunks(batch):
            found = [[s._asdict() for s in find(t)] for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], ["doc_id", "spans"])


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for every document, spans being (kind, start, end, base) over its whole text.

    Null and empty texts have an empty list; repeated rows give repeated results; other columns are not read.
    """
    span = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()),
                       StructField("base", BooleanType())])
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("spans", ArrayType(span))])
    return arrow_map(docs.select("doc_id", "text"), _detect, schema)


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["base"])


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
