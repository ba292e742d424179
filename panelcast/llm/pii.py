"""Personal data by anchor expansion.

One Aho-Corasick pass over a whole text finds the anchors: at-signs, address
schemes, identifier cues, and the two or three characters that every number
span holds (``+`` and a digit, a digit on both sides of a point, two digits with at most
one blank or hyphen between). Each anchor is handed to the parser of its kind,
which expands it to its boundaries and validates it. Parsers look only at the
characters around their anchor; what they have consumed is not scanned again.

Kinds, in the order of ``KINDS``:

* ``email``: local part, ``@``, host name of at least two labels.
* ``ip``: four numbers of at most 255; groups of four in longer dotted chains.
* ``card``: the longest chain of digits with single blanks or hyphens between,
  13 to 19 digits, Luhn's checksum.
* ``phone``: ``+``, digits, blanks, brackets, points, hyphens; 9 to 15 digits.
* ``url``: ``http``, ``https`` or ``ftp`` address: host name or number, port, path;
  closing punctuation stays outside.
* ``account``: what follows an identifier cue (``iban``, ``account``, ``token``, ...)
  and ``:``, ``=`` or ``#``: 6 to 64 letters, digits and hyphens, four digits at least.
  The span is the identifier, not its cue.

Spans of one kind never overlap; spans of different kinds may. Ends are
exclusive, positions count code points.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map

KINDS = ("email", "ip", "card", "phone", "url", "account")
EMAIL, IP, CARD, PHONE, URL, ACCOUNT = range(len(KINDS))

# The kinds that every document is reported on
BASE_KINDS = KINDS[:4]

CUES = ("iban", "account", "acct", "ssn", "passport", "token", "secret", "password", "api_key")
SCHEMES = ("http://", "https://", "ftp://")

SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"
#: text that one output batch of ``mask`` holds
BATCH_BYTES = 8 << 20

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?(?:/(?:[A-Za-z0-9/_.~%?=&#+-]*[A-Za-z0-9/_~%=&#+-])?)?")
_IDENTIFIER = re.compile(r"\x20?[:=#]\x20?\"?([A-Za-z0-9-]{6,64})")
_SEPARATORS = str.maketrans("", "", " -")


@functools.cache
def _automaton() -> ahocorasick.Automaton:
    """All anchors; the value is the kind and the anchor's length."""
    automaton = ahocorasick.Automaton()
    digits = "0123456789"
    anchors = [("@", EMAIL)]
    anchors += [(f"{a}.{b}", IP) for a in digits for b in digits]
    anchors += [(f"{a}{gap}{b}", CARD) for a in digits for gap in ("", " ", "-") for b in digits]
    anchors += [(f"+{a}", PHONE) for a in digits]
    anchors += [(scheme, URL) for scheme in SCHEMES]
    anchors += [(form, ACCOUNT) for cue in CUES for form in (cue, cue.upper(), cue.capitalize())]
    for text, kind in anchors:
        automaton.add_word(text, (kind, len(text)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    """Luhn's checksum."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place & 1:
            value = 2 * value - 9 if value > 4 else 2 * value
        total += value
    return total % 10 == 0


def _octet(digits: str) -> bool:
    bare = digits.lstrip("0")
    return len(bare) < 4 and int(bare or "0") <= 255


def _word_character(c: str) -> bool:
    return c.isascii() and (c.isalnum() or c == "_")


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind number, start, end)`` of all spans, by kind, then start."""
    found: list[tuple[int, int, int]] = []
    done = [0] * len(KINDS)  # the end of what each kind has consumed
    for last, (kind, width) in _automaton().iter(text):
        start = last - width + 1
        free = done[kind]
        if start < free:
            continue
        if kind == CARD:
            end = _CARD.match(text, start).end()
            done[CARD] = end
            if 13 <= end - start:
                number = text[start:end].translate(_SEPARATORS)
                if 13 <= len(number) <= 19 and luhn(number):
                    found.append((CARD, start, end))
        elif kind == EMAIL:
            first = start
            while first > free and text[first - 1] in _LOCAL:
                first -= 1
            host = _HOST.match(text, start + 1) if first < start else None
            if host:
                found.append((EMAIL, first, host.end()))
                done[EMAIL] = host.end()
        elif kind == IP:
            while start > free and text[start - 1] in _DIGITS:
                start -= 1
            match = _IP.match(text, start)
            if match:
                done[IP] = match.end()
                if all(map(_octet, match.groups())):
                    found.append((IP, start, match.end()))
        elif kind == PHONE:
            match = _PHONE.match(text, start)
            if match:
                done[PHONE] = match.end()
                if 9 <= sum(c in _DIGITS for c in match.group()) <= 15:
                    found.append((PHONE, start, match.end()))
        elif start and _word_character(text[start - 1]):
            continue  # a scheme or cue begins a word
        elif kind == URL:
            match = _URL.match(text, last + 1)
            if match:
                found.append((URL, start, match.end()))
                done[URL] = match.end()
        else:
            match = _IDENTIFIER.match(text, last + 1)
            if match:
                done[ACCOUNT] = match.end()
                if sum(c in _DIGITS for c in match.group(1)) >= 4:
                    found.append((ACCOUNT, *match.span(1)))
    found.sort()
    return found


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``pii``, the spans of each row's whole text, by kind, then start.

    One row per input row, no shuffle. A null or empty text has no spans (an
    empty list, never null); rows with a null or repeated id are reported like
    any other. Other columns, whatever their names, are not read. The work grows with the
    length of a text, however many anchors it holds. No rows give no rows.
    """
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans = [[{"kind": KINDS[k], "start": i, "end": j} for k, i, j in find_spans(t.as_py() or "")]
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, span)], ["doc_id", "pii"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(rows, step, f"doc_id {rows.schema[0].dataType.simpleString()}, pii {SPAN_TYPE}")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first counts."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
            at = end
        elif end > at:
            at = end  # the rest of a span that begins inside another one goes with it
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with all spans replaced by their kind; every other column as it is, null texts stay null."""
    place = docs.columns.index(text_col)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            rows = max(1, min(len(whole), BATCH_BYTES * len(whole) // max(1, whole.nbytes)))
            for first in range(0, len(whole), rows):
                batch = whole.slice(first, rows)
                texts = batch.column(place).to_pylist()
                texts = [t and masked(t, find_spans(t)) for t in texts]
                yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.column(place).type))

    return arrow_map(docs, step, docs.schema)
