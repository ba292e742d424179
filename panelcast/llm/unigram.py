"""Token counts by a unigram model, shared over a trie of pre-tokens.

A text's pre-tokens are its words with a word-start mark. The best
segmentation of a pre-token into pieces of the vocabulary is found by dynamic
programming from its start; the best score of a prefix does not depend on what
follows, so all pre-tokens go into one trie, a node holds the best score and
piece count of its prefix, and each prefix is computed once however many
pre-tokens share it. The node of a whole pre-token is its terminal: its piece
count is the pre-token's token count.

The vocabulary files hold ranks, not probabilities, and are not trained here:
a piece of rank ``r`` has log probability ``-log(r + 1)`` up to a constant,
which is subtracted per piece (Zipf's law). Scores are whole numbers, so that ties are exact; of equal
scores the segmentation with fewer pieces counts. A character without a piece
counts as its UTF-8 bytes.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import VOCABULARY_LIMIT_BYTES, arrow_map

WORD_START = "▁"
#: one unit of score is 2 ** -SCORE_BITS
SCORE_BITS = 20
#: nodes that a worker's trie holds before it starts anew
TRIE_NODES = 1_000_000
#: a longer word (in characters) does not enter the trie: only the scores that a piece can still reach are held
LONG_WORD = 1024


def unigram_scores(model: bytes) -> dict[str, int]:
    """Scores of the pieces of a sentencepiece model file; ``<0xNN>`` are its byte pieces."""
    import sentencepiece

    if len(model) > VOCABULARY_LIMIT_BYTES:
        raise ValueError(f"a vocabulary may have {VOCABULARY_LIMIT_BYTES} bytes")
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i))]
    total = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
    return {p: round((-math.log(r + 1) - total) * 2**SCORE_BITS) for r, p in enumerate(pieces)}


class PretokenTrie(dict):
    """Token counts of pre-tokens: a dictionary that grows the trie for a word it does not know."""

    def __init__(self, scores: dict[str, int]):
        super().__init__()
        self.scores = {p: s for p, s in scores.items() if not (p.startswith("<0x") and len(p) == 6)}
        self.byte_scores = [scores.get(f"<0x{b:02X}>", -(20 << SCORE_BITS)) for b in range(256)]
        self.longest = max(map(len, self.scores), default=1)
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.children: dict[tuple[int, str], int] = {}
        self.best: list[int] = [0]
        self.count: list[int] = [0]

    def _fallback(self, char: str) -> tuple[int, int]:
        raw = char.encode("utf-8", "surrogatepass")
        return sum(self.byte_scores[b] for b in raw), len(raw)

    def _long_word(self, word: str) -> int:
        """The token count of a word of any length in memory for ``longest`` prefixes; it is not remembered."""
        token, scores, ring = WORD_START + word, self.scores, self.longest + 1
        best, count = [0] * ring, [0] * ring
        for end in range(1, len(token) + 1):
            own, n = (scores[token[end - 1]], 1) if token[end - 1] in scores else self._fallback(token[end - 1])
            before = (end - 1) % ring
            found = best[before] + own, -count[before] - n
            for start in range(max(0, end - self.longest), end - 1):
                own = scores.get(token[start:end])
                if own is not None:
                    before = start % ring
                    found = max(found, (best[before] + own, -count[before] - 1))
            best[end % ring], count[end % ring] = found[0], -found[1]
        return count[len(token) % ring]

    def __missing__(self, word: str) -> int:
        """Insert a pre-token; nodes of prefixes that are there already are not computed again."""
        if len(word) > LONG_WORD:
            return self._long_word(word)
        if len(self.best) > TRIE_NODES:
            self._reset()
        token, path, node = WORD_START + word, [0], 0
        children, best, count, scores = self.children, self.best, self.count, self.scores
        for end in range(1, len(token) + 1):
            key = (node, token[end - 1])
            node = children.get(key, -1)
            if node < 0:
                score, pieces = None, 0
                for start in range(max(0, end - self.longest), end):
                    own = scores.get(token[start:end])
                    if own is not None:
                        before = path[start]
                        if score is None or (best[before] + own, -count[before] - 1) > (score, -pieces):
                            score, pieces = best[before] + own, count[before] + 1
                if token[end - 1] not in scores:
                    own, n = self._fallback(token[end - 1])
                    before = path[end - 1]
                    if score is None or (best[before] + own, -count[before] - n) > (score, -pieces):
                        score, pieces = best[before] + own, count[before] + n
                node = children[key] = len(best)
                best.append(score)
                count.append(pieces)
            path.append(node)
        terminal = self[word] = count[node]
        return terminal


_tries: dict[int, PretokenTrie] = {}


def _trie(scores: dict[str, int]) -> PretokenTrie:
    """One trie per worker process and vocabulary; it outlives a task."""
    key = hash(tuple(scores.items()))
    if key not in _tries:
        _tries.clear()
        _tries[key] = PretokenTrie(scores)
    return _tries[key]


def _count_batches(batches: Iterator[pa.RecordBatch], scores) -> Iterator[pa.RecordBatch]:
    trie = _trie(scores.value)
    for batch in batches:
        words, tokens = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
        for i, text in enumerate(batch.column(1).to_pylist()):
            parts = (text or "").split()
            words[i] = len(parts)
            tokens[i] = sum(map(trie.__getitem__, parts))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(tokens)],
                                         ["doc_id", "n_pretokens", "n_tokens"])


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` of every row's whole text.

    Pre-tokens are runs of characters other than Unicode white space. Null
    and empty texts have none; rows without an id and repeated rows stay; an
    empty table gives an empty table; other columns are not read.
    """
    with open(model_path, "rb") as f:
        scores = unigram_scores(f.read(VOCABULARY_LIMIT_BYTES + 1))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(scores)  # a vocabulary of checked size
    return arrow_map(slim, functools.partial(_count_batches, scores=shared),
                     "doc_id long, n_pretokens long, n_tokens long")
