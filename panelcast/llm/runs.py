"""Periodic runs of words: Lyndon arrays by Baier's grouping, roots extended into runs.

A run is a maximal stretch of words with a smallest period, at least
``REPEATS`` periods and ``LEAST_WORDS`` words long. By the runs theorem each run holds, in
one of the two orders of the words, Lyndon words of its period's length that
are the longest ones at their places. ``lyndon_lengths`` computes the longest Lyndon word at
every place with the first phase of Baier's suffix sorter: suffixes start in
groups by first word; groups are taken from the highest to the lowest, and the
nearest suffix to the left that is in a lower group (or several hits on it)
takes the group's context into its own and moves into a new group right above
its old one. The length of the final context is the Lyndon word. Both orders
give the roots, and a root is extended to both sides by longest common
extensions with the text shifted by its period.

A run repeats each of its three-word sequences three times at least, at most a quarter
of the run apart. Stretches in which that does not hold, for any
stretch around them, are left out before (``stretches``); that loses no run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map

#: least number of periods in a run
REPEATS = 4
LEAST_WORDS = 6
#: words handled at a time; a longer document is handled alone
BATCH_WORDS = 1 << 20
#: bytes split into words at a time
SLICE_BYTES = 4 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")

RUN_TYPE = "array<struct<start:long,length:long,period:long>>"


# -- one sequence -------------------------------------------------------------


def lyndon_lengths(x: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place (Baier's grouping, linear time)."""
    n = len(x)
    lengths = [1] * n
    left = list(range(-1, n - 1))  # where to look on for the nearest suffix of a lower group
    low = bytearray(b"\x01") * n   # whether the suffix's group is still to come
    values = sorted(set(x))
    number = {v: k for k, v in enumerate(values)}
    group = [number[v] for v in x]
    members: list[list[int]] = [[] for _ in values]
    for i, g in enumerate(group):
        members[g].append(i)
    context = [1] * len(values)
    below = list(range(-1, len(values) - 1))
    above = list(range(1, len(values) + 1))
    if above:
        above[-1] = -1
    current = len(values) - 1
    while current >= 0:
        here = [i for i in members[current] if group[i] == current]
        members[current] = []
        width = context[current]
        for i in here:
            low[i] = 0
            lengths[i] = width
        hits: dict[int, int] = {}
        for i in here:
            j = left[i]
            if j >= 0 and not low[j]:
                path = [i]
                while j >= 0 and not low[j]:
                    path.append(j)
                    j = left[j]
                for p in path:
                    left[p] = j
            if j >= 0:
                hits[j] = hits.get(j, 0) + 1
        if len(hits) == 1:
            classes = [((count, group[j]), [j]) for j, count in hits.items()]
        else:
            moved: dict[tuple[int, int], list[int]] = {}
            for j, count in hits.items():
                moved.setdefault((count, group[j]), []).append(j)
            classes = sorted(moved.items(), key=lambda c: -c[0][0]) if len(moved) > 1 else list(moved.items())
        for (count, old), suffixes in classes:
            new = len(members)
            members.append(suffixes)
            context.append(context[old] + count * width)
            up = above[old]
            above.append(up)
            below.append(old)
            above[old] = new
            if up >= 0:
                below[up] = new
            for j in suffixes:
                group[j] = new
        current = below[current]
    return lengths


def _extension(x: np.ndarray, i: int, j: int, step: int) -> int:
    """Number of equal words at ``i, j``, ``i + step, j + step`` and so on; ``i < j``."""
    room = len(x) - j if step > 0 else i + 1
    done, size = 0, 64
    while done < room:
        size = min(size, room - done)
        if step > 0:
            differ = x[i + done : i + done + size] != x[j + done : j + done + size]
        else:
            differ = (x[i - done - size + 1 : i - done + 1] != x[j - done - size + 1 : j - done + 1])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done += size
        size *= 2
    return done


def runs_of(x: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of a sequence of word numbers, by start, then period."""
    n, found = len(x), set()
    if n < LEAST_WORDS:
        return []
    words = x.tolist()
    for order in (words, [-w for w in words]):
        period = np.array(lyndon_lengths(order))
        place = np.arange(n)
        root = np.ones(n, bool)  # a run holds its root REPEATS - 1 times in a row from a root's place
        for k in range(1, REPEATS - 1):
            at = place + k * period
            inside = at < n
            root &= inside
            root[inside] &= period[at[inside]] == period[inside]
        places = place[root]
        places = places[np.argsort(period[places], kind="stable")]
        last = (-1, 0, 0)  # start, end and period of the run before
        for a, p in zip(places.tolist(), period[places].tolist(), strict=True):
            if last[2] == p and a >= last[0] and a + 2 * p <= last[1]:
                continue
            right = _extension(x, a, a + p, 1)
            back = _extension(x, a - 1, a + p - 1, -1) if a else 0
            length = back + p + right
            if length >= max(LEAST_WORDS, REPEATS * p):
                last = (a - back, a - back + length, p)
                found.add((a - back, length, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


# -- many documents -----------------------------------------------------------


def _triples(x: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose three words lie in one part, and a number of those words each."""
    place = np.flatnonzero(part[:-2] == part[2:])
    a, b, c = x[place], x[place + 1], x[place + 2]
    size = int(x.max()) + 1
    if size < 1 << 21:
        return place, (a * size + b) * size + c
    pair = np.unique(a * size + b, return_inverse=True)[1]
    return place, pair * size + c


def stretches(x: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that can lie in a run, ascending, and the number of the stretch each is in.

    ``part`` numbers the documents, ascending. A place stays while it is inside
    some three words that occur at least three times in its stretch, two of them at most
    a quarter of the stretch apart.
    """
    where = np.arange(len(x))
    while len(x) >= LEAST_WORDS:
        size = np.bincount(part)
        place, key = _triples(x, part)
        order = np.argsort(key, kind="stable")
        place, key = place[order], key[order]
        head = np.ones(len(place), bool)
        head[1:] = (key[1:] != key[:-1]) | (part[place[1:]] != part[place[:-1]])
        first = np.flatnonzero(head)
        often = np.repeat(np.diff(np.append(first, len(place))), np.diff(np.append(first, len(place)))) >= REPEATS - 1
        gap = np.full(len(place) + 1, len(x), np.int64)
        gap[1:-1] = np.where(head[1:], len(x), place[1:] - place[:-1]) if len(place) else 0
        near = np.minimum(gap[:-1], gap[1:]) * REPEATS <= size[part[place]]
        stay = np.zeros(len(x), bool)
        kept = place[often & near]
        for k in range(3):
            stay[kept + k] = True
        covered = np.flatnonzero(stay)
        new = np.ones(len(covered), bool)
        new[1:] = (np.diff(covered) > 1) | (np.diff(part[covered]) != 0)
        number = np.cumsum(new) - 1
        long_enough = np.bincount(number)[number] >= LEAST_WORDS if len(number) else new
        covered, number = covered[long_enough], number[long_enough]
        number = np.unique(number, return_inverse=True)[1]
        unchanged = len(covered) == len(x) and np.array_equal(np.unique(part, return_inverse=True)[1], number)
        where, x, part = where[covered], x[covered], number
        if unchanged:
            return where, part
    return where[:0], part[:0]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _slices(text: bytes) -> Iterator[bytes]:
    """A text in slices that end at white space."""
    at = 0
    while len(text) - at > SLICE_BYTES:
        cut = _SPACE.search(text, at + SLICE_BYTES)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:] if at else text


def _word_numbers(text: bytes, numbers: _Numbers) -> np.ndarray:
    parts = []
    for piece in _slices(text):
        words = piece.split()
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _collapsed(text: bytes, runs: list[tuple[int, int, int]], n: int) -> bytes:
    """The words that stay, joined by one space: of each run only the first period stays."""
    if not runs:
        return b" ".join(b" ".join(piece.split()) for piece in _slices(text) if piece.strip())
    gone = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    keep = (np.cumsum(gone[:-1]) == 0).tolist()
    out, at = [], 0
    for piece in _slices(text):
        words = piece.split()
        out += [w for w, k in zip(words, keep[at : at + len(words)], strict=True) if k]
        at += len(words)
    return b" ".join(out)


def _solve(texts: list[bytes], arrays: list[np.ndarray]) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Number of words, runs and collapsed text of each document."""
    counts = np.array([len(a) for a in arrays])
    starts = np.concatenate([[0], np.cumsum(counts)])
    x = np.concatenate(arrays)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in arrays]
    where, part = stretches(x, np.repeat(np.arange(len(arrays)), counts))
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    for i, j in zip(cuts.tolist(), np.append(cuts, len(where))[1:].tolist(), strict=True):
        first = int(where[i])
        doc = int(np.searchsorted(starts, first, "right")) - 1
        shift = first - int(starts[doc])
        runs[doc] += [(s + shift, length, p) for s, length, p in runs_of(x[first : first + j - i])]
    return [(n, sorted(r, key=lambda q: (q[0], q[2])), _collapsed(t, r, n))
            for t, n, r in zip(texts, counts.tolist(), runs, strict=True)]


def find_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: all runs of each row's whole text and the text without repeats.

    ``runs`` lists ``(start, length, period)`` in words, by start, then period;
    ``collapsed`` has the words that no run contains after its first period,
    joined by one space. Words are stretches without ASCII white space. A null or
    empty text has no words: no runs, empty ``collapsed``. One row per input row, no shuffle; null and
    repeated ids are reported like any other, other columns are not read. A very long text is
    split into words in slices; its words are held as numbers. No rows give no rows.
    """
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in batches:
            texts = batch.column(1)
            first, held, arrays, numbers, words = 0, [], [], _Numbers(), 0
            for row in range(len(batch)):
                held.append(texts[row].as_py() or b"")
                arrays.append(_word_numbers(held[-1], numbers))
                words += len(arrays[-1])
                if words < BATCH_WORDS and row + 1 < len(batch):
                    continue
                done = _solve(held, arrays)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(held)), pa.array([d[0] for d in done], pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in d[1]] for d in done], run),
                     pa.array([d[2] for d in done], pa.binary())],
                    ["doc_id", "n_words", "runs", "collapsed"])
                first, held, arrays, numbers, words = row + 1, [], [], _Numbers(), 0

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    schema = f"doc_id {rows.schema[0].dataType.simpleString()}, n_words long, runs {RUN_TYPE}, collapsed binary"
    return arrow_map(rows, step, schema).withColumn("collapsed", F.col("collapsed").cast("string"))
