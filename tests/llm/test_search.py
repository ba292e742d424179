"""Personal data, periodic runs and ranked search, each against a plain version."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from panelcast.llm import lexical, pii, queries, runs

# -- personal data ------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    def valid(kind: str, s: str) -> bool:
        digits = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            double = [sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
            return 13 <= len(digits) <= 19 and sum(double) % 10 == 0
        return kind != "phone" or 9 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m.group())]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return [(pii.KINDS[k], i, j) for k, i, j in pii.find_spans(text) if pii.KINDS[k] in pii.BASE_KINDS]


def test_base_spans_equal_plain_search():
    rng = random.Random(5)
    pieces = ["0", "1", "4", "25", "255", "256", ".", " ", "-", "+", "@", "a", "é", "(", ")", "%", "\n", "12",
              "4111111111111111", "4111 1111 1111 1111", "x@y.z", "+1 (771) 555-1655", "10.0.0.1"]
    for _ in range(20_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 30)))
        assert base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text, want", [
    ("see https://a.example.com:80/x?y=1. And", [("url", 4, 34)]),
    ("xhttp://a.b", []),
    ("http://localhost/x", []),
    ('token = "24be64439e3e49cf"', [("account", 9, 25)]),
    ("IBAN: DE89370400440532013000 ok", [("account", 6, 28)]),
    ("token ring 123456", []),
    ("account: abcdefgh", []),
    ("mytoken=12345678", []),
])
def test_added_kinds(text, want):
    assert [(pii.KINDS[k], i, j) for k, i, j in pii.find_spans(text) if k >= pii.URL] == want


@pytest.mark.parametrize("make", [lambda n: "1" * n, lambda n: "a" * n + "@" * (n // 50), lambda n: "1." * n,
                                  lambda n: "+1" + " " * n, lambda n: "+1(((" * n, lambda n: "1.1.1 " * n,
                                  lambda n: "a@b." * n])
def test_long_stretches(make):
    assert base_spans(make(600)) == plain_spans(make(600))
    base_spans(make(300_000))  # in time that grows with the length; the plain search takes its square


def test_mask():
    text = "to a.b@c.de or 10.0.0.1, http://x.y/z"
    assert pii.masked(text, pii.find_spans(text)) == "to [EMAIL] or [IP], [URL]"


def test_pii_edges(edge, no_docs):
    found = {(r["doc_id"], tuple(r["pii"])) for r in pii.find_pii(edge).collect()}
    assert (3, ()) in found and (4, ()) in found and (None, ()) in found
    assert pii.find_pii(edge).count() == edge.count()
    assert pii.find_pii(no_docs).count() == 0
    assert pii.mask(edge).schema == edge.schema and pii.mask(edge).count() == edge.count()
    assert pii.mask(edge).where("text is null").count() == edge.where("text is null").count()


def test_pii_over_documents(docs):
    rows = {r["doc_id"]: r["pii"] for r in pii.find_pii(docs).collect()}
    for r in docs.collect():
        got = [tuple(s) for s in rows[r["doc_id"]] if s["kind"] in pii.BASE_KINDS]
        assert got == plain_spans(r["text"] or "")


# -- runs ---------------------------------------------------------------------


def plain_runs(x: list) -> list[tuple[int, int, int]]:
    n, best = len(x), {}
    for q in range(1, n // 4 + 1):
        k = 0
        while k < n - q:
            start = k
            while k < n - q and x[k] == x[k + q]:
                k += 1
            length = k - start + q
            if k > start and length >= max(6, 4 * q):
                best.setdefault((start, length), q)
            k += k == start
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def some_words(rng: random.Random, most: int = 70) -> list[int]:
    n = rng.randint(0, most)
    x = [rng.randrange(rng.choice([1, 2, 3, 20])) for _ in range(n)]
    if n > 8 and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + rng.randrange((n - a) // 4 + 1)
        x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
    return x


def test_lyndon_lengths_by_definition():
    rng = random.Random(1)
    for _ in range(1500):
        x = some_words(rng, 40)
        for order in (x, [-v for v in x]):
            want = []
            for i in range(len(order)):
                k = i + 1
                while k < len(order) and order[k:] > order[i:]:
                    k += 1
                want.append(k - i)
            assert runs.lyndon_lengths(order) == want


def test_runs_equal_plain_search():
    rng = random.Random(2)
    for _ in range(1500):
        x = some_words(rng)
        assert runs.runs_of(np.array(x, np.int64)) == plain_runs(x), x


def test_runs_of_many_documents_with_slices(monkeypatch):
    monkeypatch.setattr(runs, "SLICE_BYTES", 16)
    rng = random.Random(3)
    for _ in range(300):
        docs = [some_words(rng) for _ in range(rng.randint(1, 6))]
        texts = [" ".join(f"w{v}" for v in x).encode() for x in docs]
        numbers = runs._Numbers()
        solved = runs._solve(texts, [runs._word_numbers(t, numbers) for t in texts])
        for x, (n, found, kept) in zip(docs, solved, strict=True):
            want = plain_runs(x)
            gone = {i for s, length, q in want for i in range(s + q, s + length)}
            assert (n, found) == (len(x), want)
            assert kept.decode() == " ".join(f"w{v}" for i, v in enumerate(x) if i not in gone)


def test_words_beyond_three_numbers_in_one_key():
    rng = random.Random(4)
    x = np.array([v + (1 << 21) for v in some_words(rng) * 5], np.int64)
    where, _ = runs.stretches(x, np.zeros(len(x), np.int64))
    assert all(set(range(s, s + n)) <= set(where.tolist()) for s, n, _ in plain_runs(x.tolist()))


def test_runs_edges(edge, no_docs):
    found = runs.find_runs(edge).collect()
    assert len(found) == edge.count() and runs.find_runs(no_docs).count() == 0
    by_text = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert by_text[10]["runs"] == [(0, 15, 1)] and by_text[10]["collapsed"] == "same"
    assert by_text[3]["n_words"] == 0 and by_text[3]["collapsed"] == "" and by_text[3]["runs"] == []
    assert by_text[5]["collapsed"] == "" and by_text[11]["collapsed"] == "a b\u00a0c d e"
    assert by_text[8]["n_words"] == 120_000


def test_planted_runs(docs):
    import zlib

    changed = {r["doc_id"]: r["text"] for r in queries.with_planted_runs(docs).collect()}
    for r in docs.collect():
        h, w = zlib.crc32(str(r["doc_id"]).encode()), re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        if h % 10 or not w:
            assert changed[r["doc_id"]] == r["text"]
        else:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert changed[r["doc_id"]].split(" ") == [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


# -- ranked search ------------------------------------------------------------


def plain_rank(docs: list[tuple], items: list[tuple], k: int) -> list[tuple]:
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                                 "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    counts = [(d, Counter(split(t))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    n_terms = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    by_item: dict = {}
    for i, t in items:
        by_item.setdefault(i, set()).update(split(t))
    out = []
    for i, terms in by_item.items():
        scores = []
        for d, c in counts:
            n = sum(c.values())
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (
                1_000_000_000 * c[t] // (1000 * c[t] + 20 * (50 + 50 * n * n_docs // n_terms))) for t in terms if c[t])
            if score > 0:
                scores.append((-score, d is None, d))
        out += [(i, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda s: s[:2] + (s[2] or 0,))[:k])]
    return out


def ranked(frame) -> list[tuple]:
    return sorted(map(tuple, frame.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_rank_over_all_documents(docs, benchmark):
    want = plain_rank([(r["doc_id"], r["text"]) for r in docs.collect()],
                      [(r["item_id"], r["text"]) for r in benchmark.collect()], 50)
    assert ranked(lexical.rank(docs, benchmark)) == sorted(want)


@pytest.mark.parametrize("focus, bucket", [(0.3, 1), (0.8, 8), (1.0, 512)])
def test_pruned_search_loses_nothing(focus, bucket, monkeypatch):
    monkeypatch.setattr(lexical, "FOCUS", focus)
    monkeypatch.setattr(lexical, "FIRST_BUCKET", bucket)
    rng = np.random.default_rng(bucket)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choice(words, int(rng.integers(0, 30)), p=None))) for i in range(150)]
    items = [(i, " ".join(rng.choice(words, 5))) for i in range(12)]
    want = plain_rank(docs, items, 7)
    n_docs, n_terms = sum(bool(t) for _, t in docs), sum(len(t.split()) for _, t in docs)
    rows = [(d, Counter(t.split())) for d, t in docs]
    df = np.array([sum(w in c for _, c in rows) for w in words])
    search = lexical.Searcher([np.array(sorted({words.index(w) for w in t.split()})) for _, t in items],
                              lexical._weights(n_docs, df), n_docs, n_terms, 7, np.ones(12, np.int64))
    for part in (rows[:60], rows[60:61], rows[61:]):
        entries = [[(words.index(w), n) for w, n in c.items()] for _, c in part]
        packed = lexical._pack(0, [d for d, _ in part], [sum(c.values()) for _, c in part],
                               [np.array([t for t, _ in e], np.int32) for e in entries],
                               [np.array([n for _, n in e], np.int32) for e in entries])
        search.search(lexical._Chunk.unpack(packed["vectors"][0]))
    hits = search.hits().to_pydict()
    got = list(zip(hits["item"], hits["doc_id"], hits["score"], strict=True))
    assert sorted(got) == sorted((i, d, s) for i, _, d, s in want)


def test_rank_edges(spark, edge, no_docs):
    items = spark.createDataFrame(
        [(1, "W1 w2 W3", "x"), (1, "w4", "y"), (None, "same", "z"), (2, None, "x"), (3, "", "x"), (4, "é 中文", "x"),
         (5, "nowhere", "x")], "item_id long, text string, doc_id string")
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    want = plain_rank(rows, [(r["item_id"], r["text"]) for r in items.collect()], 50)
    assert ranked(lexical.rank(edge, items)) == sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert lexical.rank(no_docs, items).count() == 0 and lexical.rank(edge, items.limit(0)).count() == 0


def test_rank_in_blocks_of_items(docs, benchmark, monkeypatch):
    whole = ranked(lexical.rank(docs, benchmark, k=5))
    monkeypatch.setattr(lexical, "BLOCK_CHARS", 3000)
    monkeypatch.setattr(lexical, "CHUNK_DOCS", 16)
    assert ranked(lexical.rank(docs, benchmark, k=5)) == whole


def test_terms_in_slices():
    text = ("Ab c9_é-" * 50).encode()
    assert sum((lexical.terms_of(s) for s in lexical._slices(text, 37)), []) == lexical.terms_of(text)
