"""Token ids, Re-Pair files, packing and unigram counts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, normalizers

from panelcast.llm import packing, repair, unigram
from panelcast.llm.tokens import TextEncoder

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def plain(path: str) -> Tokenizer:
    """The library as it is by default."""
    return Tokenizer.from_file(path)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_give_the_library_ids(path):
    rnd = random.Random(4)
    atoms = ["a", "Bc", "é", " ", " ", "\n", ".", ",", "'s", "́", "1", "\t", "\xa0", "\x1c", "İ", "Σ", "<|endoftext|>",
             "中", "!", "'", "...", "_", "\x00", "½", " ", "word", " the"]
    texts = ["".join(rnd.choice(atoms) for _ in range(rnd.randint(0, 16))) for _ in range(6000)]
    encoder = TextEncoder(open(path, encoding="utf-8").read())
    want = plain(path).encode_batch(texts, add_special_tokens=False)
    for _ in range(2):  # with and without a memory of the pieces
        for text, ids, w in zip(texts, encoder.encode(texts), want, strict=True):
            assert ids.tolist() == w.ids, repr(text)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_strings_of_special_tokens_as_the_library_has_them(path):
    library = plain(path)
    names = [t.content for t in library.get_added_tokens_decoder().values()]
    assert names
    texts = [f"hello {n} world" for n in names] + [f"a{n}b{n}" for n in names] + names + ["plain < | text"]
    found = TextEncoder(open(path, encoding="utf-8").read()).encode(texts)
    assert [f.tolist() for f in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_by_the_model_alone(path):
    library, rnd = plain(path), random.Random(12)
    encoder = TextEncoder(open(path, encoding="utf-8").read())
    assert encoder.pieces.direct is not None
    letters = "etaoinshrdlucmETAOINSxqzJéÈçßøæŁœŽªºµſǅɏ"
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 25))) for _ in range(4000)] + ["a" * 5000]
    pieces = [*words, *(f" {w}" for w in words)]
    want = [np.array(e.ids, encoder.kind).tobytes() for e in library.encode_batch(pieces, add_special_tokens=False)]
    assert [bytes(encoder.pieces[p]) for p in pieces] == want and not encoder.pieces.new


def test_a_tokenizer_without_a_known_form_is_asked_whole():
    other = plain(BYTES)
    other.normalizer = normalizers.Replace("e", "o")
    encoder = TextEncoder(other.to_str())
    assert encoder.pieces.direct is None
    assert encoder.encode(["the end, here"])[0].tolist() == other.encode("the end, here", add_special_tokens=False).ids


def test_pair_counts_kept_up_equal_counting_anew():
    def anew(seq, barrier, first, limit, least):
        rules = []
        while True:
            codes = repair._all_counts(seq, barrier, least)
            pairs = repair.chosen_pairs(*codes, limit)
            if not len(pairs):
                return rules, seq
            seq = repair.replace_pairs(seq, pairs, first + len(rules))
            rules += [(int(p >> 32), int(p & 0xFFFFFFFF)) for p in pairs]

    rng = np.random.default_rng(8)
    for _ in range(150):
        ids = rng.integers(0, rng.integers(2, 6), int(rng.integers(2, 250))).astype(np.uint32)
        barrier, limit, least = int(rng.integers(0, 8)), int(rng.integers(1, 5)), int(rng.integers(2, 4))
        rules, symbols = anew(ids, barrier, 10, limit, least)
        grammar = repair.compress(ids, barrier, 10, limit, least)
        assert grammar.rules.tolist() == [list(r) for r in rules] and grammar.symbols.tolist() == symbols.tolist()
        assert grammar.expand(grammar.symbols).tolist() == ids.tolist()


def test_piece_memory_is_bounded(monkeypatch):
    from panelcast.llm import tokens

    monkeypatch.setattr(tokens, "PIECE_CACHE", 50)
    monkeypatch.setattr(tokens, "CALL_CHARS", 40)
    encoder = TextEncoder(open(BYTES, encoding="utf-8").read())
    texts = [f"some words {i} and {i * i}, more. End" for i in range(300)]
    want = plain(BYTES).encode_batch(texts, add_special_tokens=False)
    assert [a.tolist() for a in encoder.encode(texts)] == [w.ids for w in want]
    assert len(encoder.pieces) < 120


def expected_ids(rows, path, end_id):
    t = plain(path)
    return {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, end_id], "<u4") for i, x in rows}


def test_token_files_round_trip(docs, spark):
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    ids = expected_ids(rows, WORDS, 1)
    folder, manifest = repair.write_ids(docs, WORDS, end_id=1)
    found = {r["doc_id"]: r for r in repair.read_ids(spark, folder, manifest, end_id=1).collect()}
    at = 0
    for i, _ in rows:
        assert (found[i]["start"], found[i]["n_tokens"], bytes(found[i]["ids"])) == (at, len(ids[i]), ids[i].tobytes())
        at += len(ids[i])
    totals = manifest.groupBy().sum("n_ids", "n_bytes").first()
    assert totals[0] == at and totals[1] < 2 * at  # below two bytes an id


def test_token_files_edge_rows(edge, no_docs, spark):
    folder, manifest = repair.write_ids(edge, WORDS, end_id=1)
    rows = repair.read_ids(spark, folder, manifest, end_id=1).orderBy("start").collect()
    assert len(rows) == 15
    assert [r["doc_id"] for r in rows] == [None, None, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 10, 11]
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows[:-1])]).tolist()
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (3, 4, 5))
    folder, manifest = repair.write_ids(no_docs, WORDS, end_id=1)
    assert repair.read_ids(spark, folder, manifest, end_id=1).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_grammar_expands_exactly_and_by_ranges(seed):
    rng = np.random.default_rng(seed)
    documents = [np.append(rng.choice([0, 1, 2, 2, 2, 7], int(rng.integers(0, 90))), 1).astype("<u4") for _ in range(40)]
    documents.append(np.full(301, 2, "<u4"))
    documents[-1][-1] = 1
    shard = repair.Shard(b"".join(repair.shard_file([None, *range(40)], documents, 1, 100)), 1)
    assert shard.doc_ids == [None, *range(40)] and len(shard.grammar.rules)
    assert all((a == b).all() for a, b in zip(shard.documents(), documents, strict=True))
    for k in range(41):
        i, j = sorted(rng.integers(0, len(documents[k]) + 1, 2).tolist())
        assert shard.document(k, i, j).tolist() == documents[k][i:j].tolist()
    lengths = shard.grammar.symbol_lengths(np.arange(101, 101 + len(shard.grammar.rules)))
    assert [len(shard.grammar.expand(np.array([101 + r]))) for r in range(len(lengths))] == lengths.tolist()


def test_grammar_goes_on_until_no_pair_is_frequent():
    passage = np.random.default_rng(3).permutation(np.arange(10, 510))
    documents = [np.append(np.tile(passage, 4), 1).astype("<u4") for _ in range(20)]
    grammar = repair.compress(np.concatenate(documents), 1, 1000)
    symbols = grammar.symbols.tolist()
    inner = [p for p in zip(symbols[:-1], symbols[1:], strict=True) if 1 not in p]
    assert grammar.lengths.max() >= 500 and all(inner.count(p) < repair.LEAST_COUNT for p in set(inner))
    assert grammar.expand(grammar.symbols).tolist() == np.concatenate(documents).tolist()


def slow_cost(places, costs, capacity):
    best = [0.0] + [float("inf")] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            size = places[j] - places[i]
            if size > capacity:
                continue
            own = min(capacity - size, packing.SHORT_COST if size in packing.SHORT_SIZES and size < capacity else 1e9)
            best[j] = min(best[j], best[i] + own + costs[j])
    return best[-1]


@pytest.mark.parametrize("seed", range(6))
def test_cuts_are_optimal(seed, monkeypatch):
    monkeypatch.setattr(packing, "SHORT_SIZES", (8, 16))
    rng = np.random.default_rng(seed)
    places = np.concatenate([[0], np.cumsum(rng.integers(1, 14, 120))])
    costs = rng.choice([0.0, 2.0, 24.0], len(places))
    cuts = packing.best_cuts(places, costs, 64)
    cost_at = dict(zip(places.tolist(), costs.tolist(), strict=True))
    sizes = np.diff(cuts).tolist()
    assert max(sizes) <= 64 and cuts[0] == 0 and cuts[-1] == places[-1]
    own = sum(min(64 - s, packing.SHORT_COST if s in (8, 16) else 1e9) for s in sizes) + sum(cost_at[c] for c in cuts[1:])
    assert own == pytest.approx(slow_cost(places.tolist(), costs.tolist(), 64))


def test_every_sentence_end_is_offered():
    ends = np.zeros(4, bool)
    ends[2] = True
    ids = np.tile(np.array([1, 1, 1, 1, 2], "<u4"), 420)  # sentences of 5 ids
    places, costs = packing.offered_cuts(ids, ends, 0)
    assert places.tolist() == list(range(0, 2101, 5)) and set(costs[1:-1].tolist()) == {packing.SENTENCE_COST}
    ids = np.insert(ids[:-1], 0, [1, 1, 1, 2])  # a boundary at 1024
    cuts = packing.best_cuts(*packing.offered_cuts(ids, ends, 0))
    assert 1024 in cuts


def check_pieces(rows, ids, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            own = ids[i][r["start"] : r["start"] + r["length"]]
            assert r["start"] == at and bytes(r["ids"]) == own.tobytes() and r["doc_tokens"] == len(ids[i])
            assert zlib.crc32(own.tobytes()) == zlib.crc32(bytes(r["ids"]))
            at += r["length"]
        assert at == len(ids[i])
    sizes = []
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        sizes.append(at)
    assert max(sizes) <= capacity
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))]
    assert order == sorted(order)
    return sum(capacity - s for s in sizes if s & (s - 1)) / sum(sizes)


def test_packing_places_every_id_once(docs, monkeypatch):
    ids = expected_ids([(r["doc_id"], r["text"]) for r in docs.collect()], BYTES, 0)
    rows = packing.pack(docs, BYTES).collect()
    assert set(ids) == {r["doc_id"] for r in rows}
    assert check_pieces(rows, ids, 1024) < 0.05


def test_packing_in_small_segments():
    rng = np.random.default_rng(8)
    ends = np.zeros(60, bool)
    ends[5] = True
    packer = packing._Packer(ends, 0, 64, 0)
    old = packing.SEGMENT, packing.MARGIN
    packing.SEGMENT, packing.MARGIN = 700, 128
    try:
        ids, rows = {}, []
        for i in range(80):
            body = rng.integers(1, 60, int(rng.choice([0, 3, 50, 400]))).astype("<u4")
            ids[i] = np.append(body, 0).astype("<u4")
            rows += [x for b in packer.add(i, body) for x in b.to_pylist()]
        rows += [x for b in packer.cut(last=True) for x in b.to_pylist()]
    finally:
        packing.SEGMENT, packing.MARGIN = old
    check_pieces(rows, ids, 64)


def test_packing_edge_rows(edge, no_docs):
    rows = packing.pack(edge.where("doc_id is not null").dropDuplicates(["doc_id"]), BYTES).collect()
    assert {r["doc_id"] for r in rows} == set(range(12))
    assert {r["doc_tokens"] for r in rows if r["doc_id"] in (3, 4)} == {1}
    assert packing.pack(edge, BYTES).selectExpr("sum(length)").first()[0] > sum(r["length"] for r in rows)
    assert packing.pack(no_docs, BYTES).count() == 0


def slow_count(scores, word):
    token = "▁" + word
    best = [(0, 0)] + [None] * len(token)
    for j in range(1, len(token) + 1):
        for i in range(j):
            piece = token[i:j]
            options = []
            if piece in scores and not piece.startswith("<0x"):
                options.append((scores[piece], 1))
            elif j - i == 1:
                raw = piece.encode()
                options.append((sum(scores[f"<0x{b:02X}>"] for b in raw), len(raw)))
            for own, n in options:
                new = (best[i][0] + own, best[i][1] - n)
                if best[j] is None or new > best[j]:
                    best[j] = new
    return -best[-1][1]


def test_token_counts_match_plain_programming(docs, edge, no_docs, monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    scores = unigram.unigram_scores(open(path, "rb").read())
    rows = [(r["doc_id"], r["text"]) for r in docs.limit(25).collect()]
    known = {}
    want = {i: (len((t or "").split()), sum(known.setdefault(w, slow_count(scores, w)) for w in (t or "").split()))
            for i, t in rows}
    found = unigram.count_tokens(docs, path).collect()
    found = {r["doc_id"]: (r["n_pretokens"], r["n_tokens"]) for r in found if r["doc_id"] in want}
    assert found == want
    counted = unigram.count_tokens(edge, path).collect()
    assert len(counted) == 15 and all(r["n_tokens"] == 0 for r in counted if r["doc_id"] in (3, 4, 5))
    assert unigram.count_tokens(no_docs, path).count() == 0


def test_trie_shares_prefixes_and_starts_anew(monkeypatch):
    monkeypatch.setattr(unigram, "TRIE_NODES", 50)
    path = public_tokenizers.path("piece_bpe_32k.model")
    scores = unigram.unigram_scores(open(path, "rb").read())
    trie = unigram.PretokenTrie(scores)
    trie["walking"]
    nodes = len(trie.best)
    trie["walked"]
    assert len(trie.best) == nodes + 2  # "walk" is shared
    words = [w for w in ("über", "中文字", "a", "🎉🎉", "walking", "supercalifragilistic") for _ in range(3)]
    assert [trie[w] for w in words] == [slow_count(scores, w) for w in words]
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    assert trie["a"] == len(sp.encode("a"))


def test_very_long_words_leave_no_nodes(monkeypatch):
    scores = unigram.unigram_scores(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    rnd = random.Random(6)
    words = ["".join(rnd.choice(["ing", "a", "é", "中", "the", "🎉", "x", "walk"]) for _ in range(n)) for n in (1, 3, 30, 400)]
    want = [slow_count(scores, w) for w in words]
    trie = unigram.PretokenTrie(scores)
    assert [trie[w] for w in words] == want
    monkeypatch.setattr(unigram, "LONG_WORD", 0)
    trie = unigram.PretokenTrie(scores)
    assert [trie[w] for w in words] == want and len(trie.best) == 1 and not trie
