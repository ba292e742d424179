"""Token ids of whole texts by a public tokenizer file, with a memory of pieces.

Texts are cut before each single white space that stands between two other
characters. The two tokenizers in use (byte-level BPE with its usual pattern,
and word BPE that drops white space) never join characters across such a
place, so the ids of a text are those of its pieces one after the other, and
each distinct piece needs the tokenizers library only once. A piece of Latin
letters goes to the library's BPE model itself, in the form that normaliser and
pre-tokenizer would give it; the form is held against the whole tokenizer when an
encoder is made. A text with any two neighbouring white-space characters, or
with the string of a special token, goes to the library whole.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks in parallel

from tokenizers import Tokenizer  # noqa: E402

#: pieces that a worker remembers at a time
PIECE_CACHE = 1_000_000
#: pieces that are encoded as one text
JOINED_WORDS = 1 << 14
#: characters of text whose new pieces are encoded in one call
CALL_CHARS = 2 << 20

#: a stop or comma that may join what stands before it
_JOINED_STOP = re.compile(r"[.,](?<=[\W_].)")


#: the letters that stand for the bytes of UTF-8 in byte-level BPE: a byte's own character if it can be printed,
#: the others count on from 256
_BYTE_LETTERS = dict(zip((b for b in range(256) if b <= 32 or 127 <= b <= 160 or b == 173), range(256, 512), strict=False))


def _byte_letters(piece: str) -> str:
    if piece.isascii():
        return piece.replace(" ", "\u0120")
    return piece.encode().decode("latin-1").translate(_BYTE_LETTERS)


#: what the BPE model is given for a piece of letters, after one blank at most: all of it (byte-level BPE), or
#: lower-case words without the blank (word BPE)
_MODEL_FORMS = (_byte_letters, lambda piece: _byte_letters(piece.lstrip(" ").lower()))
#: words of the vocabulary on which a form is tried, also with accents
PROBES = 400
_ACCENTS = str.maketrans("aeiounscz", "àéîøüñßčž")


class _Pieces(dict):
    """Ids of known pieces. A new piece of Latin letters (one code point each, none that changes its number in
    lower case) is encoded at once if there is a way (``direct``); any other gets an empty array of bytes, to be filled, and is noted."""

    def __init__(self, direct: Callable[[str], bytes] | None):
        super().__init__()
        self.new: list[str] = []
        self.direct = direct

    def __missing__(self, piece: str) -> bytes | bytearray:
        if self.direct is not None and piece.lstrip(" ").isalpha() and (
                piece.isascii() or (max(piece) < "\u0250" and "\u0130" not in piece)):
            value = self[piece] = self.direct(piece)
            return value
        value = self[piece] = bytearray()
        self.new.append(piece)
        return value


class TextEncoder:
    """Encodes texts to ids, as arrays of unsigned 32-bit integers, as the library does by
    default: a special token's string in a text becomes its id."""

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.pieced = Tokenizer.from_str(vocabulary)  # pieces hold no special token: not looked for again
        self.pieced.encode_special_tokens = True
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(added) or r"(?!)")
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.width = int(self.kind[-1])
        self.pieces = _Pieces(self._direct())
        comma = self.tokenizer.encode(",", add_special_tokens=False).ids
        if len(comma) != 1:
            raise ValueError("a comma must be one id of the vocabulary")
        self.comma = comma[0]

    def _direct(self) -> Callable[[str], bytes] | None:
        """Ids of a piece of Latin letters by the BPE model alone, if one of the forms gives the tokenizer's ids."""
        tokenize, code = self.pieced.model.tokenize, {2: "H", 4: "I"}[self.width]
        letters = sorted({t for t in self.pieced.get_vocab() if t.isascii() and t.isalpha()})
        words = letters[:: max(1, len(letters) // PROBES)]
        words += [a + b for a, b in zip(words, reversed(words), strict=True)]
        words += [w.translate(_ACCENTS) for w in words]
        probes = [f"{blank}{case(w)}" for w in words for blank in ("", " ") for case in (str, str.upper, str.title)]
        want = self._library(probes)
        for form in _MODEL_FORMS:

            def direct(piece: str, form=form) -> bytes:
                ids = [t.id for t in tokenize(form(piece))]
                return struct.pack(f"<{len(ids)}{code}", *ids)

            if probes and [direct(p) for p in probes] == want:
                return direct
        return None

    def _library(self, texts: list[str], whole: bool = False) -> list[bytes]:
        found = (self.tokenizer if whole else self.pieced).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of pieces that are letters only: encoded in one text, a comma after each."""
        out: list[bytes] = []
        for i in range(0, len(words), JOINED_WORDS):
            part = words[i : i + JOINED_WORDS]
            raw = self._library([",".join(part) + ","])[0]
            w = self.width
            ends = (np.flatnonzero(np.frombuffer(raw, self.kind) == self.comma) * w).tolist()
            if len(ends) != len(part):
                out += self._library(part)
            else:
                out += [raw[j:k] for j, k in zip([0, *(e + w for e in ends)], ends, strict=False)]
        return out

    def _learn(self) -> None:
        """Encode the new pieces: letters only in one text, others one by one."""
        new, self.pieces.new = self.pieces.new, []
        words, others = [], []
        for p in new:
            w = p.lstrip(" \n")
            (words if w.isalpha() and (w.isascii() or w.lower().isalpha()) else others).append(p)
        for part, found in (words, self._words(words)), (others, self._library(others)):
            for p, ids in zip(part, found, strict=True):
                self.pieces[p].extend(ids)  # also where a text already holds it
                self.pieces[p] = ids

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; null gives none."""
        out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(texts)
        start = 0
        while start < len(texts):
            end, held = start, 0
            while end < len(texts) and (end == start or held < CALL_CHARS):
                held += len(texts[end] or "")
                end += 1
            for i, ids in self._encode_some(texts, start, end):
                out[i] = ids.astype("<u4")
            start = end
        return out

    def _encode_some(self, texts: list[str | None], start: int, end: int) -> list[tuple[int, np.ndarray]]:
        if len(self.pieces) > PIECE_CACHE:
            self.pieces.clear()
        held, marked, whole = [], [], []
        for i in range(start, end):
            text = texts[i]
            if not text:
                continue
            spaced = text.replace("\n", " ")
            # neighbouring or other white space, control characters, strings of special tokens
            if "  " in spaced or not spaced.isprintable() or self.special.search(text):
                whole.append(i)
                continue
            if not _JOINED_STOP.search(text) and "\u0130" not in text:
                # stops and commas follow letters or digits only, and so are pieces of their own
                for stop in ". ", ", ", ".\n", ",\n":
                    text = text.replace(stop, f"\x00{stop}")
            held.append(i)
            marked.append(text.replace(" ", "\x00 ").replace("\n", "\x00\n"))
        raw = self._library([texts[i] for i in whole], True)
        out = [(i, np.frombuffer(ids, self.kind)) for i, ids in zip(whole, raw, strict=True)]
        return out + list(zip(held, self._joined(marked), strict=True))

    def _joined(self, marked: list[str]) -> list[np.ndarray]:
        """The ids of texts whose pieces are separated by zero characters: each distinct piece is looked up once."""
        if not marked:
            return []
        split = pc.split_pattern(pa.array(marked, pa.large_string()), "\x00")
        coded = split.flatten().dictionary_encode()
        known = list(map(self.pieces.__getitem__, coded.dictionary.to_pylist()))
        self._learn()
        own = np.fromiter(map(len, known), np.int64, len(known)) // self.width
        flat = np.frombuffer(b"".join(known), self.kind)
        place = coded.indices.to_numpy()
        size = own[place]
        after = np.concatenate([[0], np.cumsum(size)])
        # where a piece's ids begin among the distinct ones, counted on from where they stand in the texts
        shift = (np.cumsum(own) - own)[place] - after[:-1]
        ids = flat[np.arange(after[-1]) + np.repeat(shift, size)]
        return np.split(ids, after[split.offsets.to_numpy()[1:-1]])


_encoders: dict[int, TextEncoder] = {}


def encoder_for(vocabulary: str) -> TextEncoder:
    """One encoder per worker process and vocabulary; its memory outlives a task."""
    key = hash(vocabulary)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = TextEncoder(vocabulary)
    return _encoders[key]
