"""Plain reference versions that the operators are held against."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def simhash(text: str | None, shingle: int = 3) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    runs = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n: int, links) -> list[int]:
    """For each of ``n`` nodes, the smallest node it reaches."""
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near(fps: list[int], k: int = 3) -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= k]


def remove_repeats(rows: list[tuple[int, str | None]], window: int = 13) -> dict[int, tuple[int, int, str, str]]:
    words = {i: WORD.findall(t or "") for i, t in rows}
    first: dict[tuple, int] = {}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k : k + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def cosine_links(vectors: np.ndarray, threshold: float) -> np.ndarray:
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    found = unit @ unit.T >= threshold
    np.fill_diagonal(found, False)
    return found
