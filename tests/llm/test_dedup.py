"""SimHash, substring and embedding near-duplicates, and connected components."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from panelcast.llm import quantise, simhash, substring
from panelcast.llm.components import connected_components
from tests.llm import brute


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def test_components_match_union_find(spark):
    rng = np.random.default_rng(3)
    links = [tuple(map(int, p)) for p in rng.integers(0, 120, (110, 2))] + [(i, i + 1) for i in range(200, 230)]
    frame = spark.createDataFrame([*links, (5, 5), (None, 3), (links[0])], "a long, b long")
    found = {r["node"]: r["root"] for r in connected_components(frame).collect()}
    want = brute.groups(231, links)
    assert {i: r for i, r in enumerate(want) if r != i} == found


def test_components_of_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("m", [1, 2, 3, 4])
def test_thresholds_keep_the_pigeonhole_sum(m):
    rng = np.random.default_rng(m)
    share = rng.random(64)
    parts = simhash.group_bits(rng.normal(size=(64, 64)), m)
    assert sorted(itertools.chain(*parts)) == list(range(64))
    cost, thresholds = simhash.allot_thresholds(parts, share, 10**6, 3)
    assert sum(thresholds) == 3 - m + 1 and min(thresholds) >= -1
    options = [t for t in itertools.product(range(-1, 4), repeat=m) if sum(t) == 3 - m + 1]
    alone = [simhash.allot_thresholds([p], share, 10**6, t)[0] if t >= 0 else 0.0
             for p in parts for t in range(-1, 4)]
    best = min(sum(alone[i * 5 + t + 1] for i, t in enumerate(o)) for o in options)
    assert cost == pytest.approx(best)


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2, (500, 2))
    bits = np.where(rng.random((500, 64)) < 0.1, 1, 0) ^ base[:, np.arange(64) % 2]
    parts = simhash.group_bits(np.corrcoef(bits.T), 2)
    assert {tuple(p) for p in parts} == {tuple(range(0, 64, 2)), tuple(range(1, 64, 2))}


@pytest.mark.parametrize("m", [2, 3, 4])
def test_links_match_brute_force_for_any_plan(spark, monkeypatch, m):
    rng = np.random.default_rng(m)
    fps = [int(x) for x in rng.integers(0, 1 << 63, 60)]
    for f in fps[:40]:
        for flips in (1, 3, 4):
            fps.append(f ^ sum(1 << int(b) for b in rng.choice(64, flips, replace=False)))
    fps = list(dict.fromkeys(fps))
    share, corr = np.full(64, 0.5), rng.normal(size=(64, 64))

    def plan(n, share_, corr_, k):
        parts = simhash.group_bits(corr, m)
        return [(p, t) for p, t in zip(parts, simhash.allot_thresholds(parts, share, 10, k)[1], strict=True) if t >= 0]

    monkeypatch.setattr(simhash, "plan_partitions", plan)
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    found = {frozenset((r["a"], r["b"])) for r in simhash.links_within(frame, 3).collect()}
    assert found == {frozenset((signed(fps[i]), signed(fps[j]))) for i, j in brute.near(fps)}


def test_simhash_groups_match_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    fps = [brute.simhash(t) for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    place = {i: p for p, i in enumerate(order)}
    root = brute.groups(len(rows), [(place[i], place[j]) for i, j in brute.near(fps)])
    want = {rows[i][0]: (f"{fps[i]:016x}", rows[order[root[place[i]]]][0]) for i in range(len(rows))}
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert found == want


def test_simhash_edge_rows(edge, no_docs):
    found = simhash.near_duplicates(edge).collect()
    assert len(found) == 15
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append((r["fingerprint"], r["component_id"]))
    assert by_id[3] == by_id[4] == by_id[5] == [("0" * 16, 3)]
    assert by_id[0][0][1] == 0 and by_id[1] == by_id[0]
    assert sorted(by_id[None], key=str) == sorted([by_id[0][0], by_id[3][0]], key=str)
    assert len(by_id[9]) == 2
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.drop_near_duplicates(edge)
    assert kept.columns == edge.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 1 not in ids and 4 not in ids and 0 in ids and 3 in ids


def test_substring_matches_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute.remove_repeats(rows)
    found = substring.remove_repeats(docs).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == {
        i: v[:3] for i, v in want.items()}
    texts = dict(rows)
    assert all(r["text"] == (want[r["doc_id"]][3] if r["n_removed"] else texts[r["doc_id"]]) for r in found)


def test_substring_over_many_chunks_and_ranges(spark, monkeypatch):
    rng = np.random.default_rng(1)
    pool = [" ".join(f"v{x}" for x in rng.integers(0, 400, 30)) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [" ".join(f"v{x}" for x in rng.integers(0, 400, int(rng.integers(0, 40)))) for _ in range(2)]
        cut = pool[int(rng.integers(0, 6))].split()
        a = int(rng.integers(0, 12))
        rows.append((i, " ".join([parts[0], *cut[a : a + int(rng.integers(8, 20))], parts[1]])))
    monkeypatch.setattr(substring, "RANGE_WORDS", 500)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring.remove_repeats(frame).collect()}
    assert found == {i: v[:2] for i, v in brute.remove_repeats(rows).items()}
    assert sum(n for _, n in found.values()) > 300


def test_substring_edge_rows(edge, no_docs):
    out = substring.remove_repeats(edge)
    assert out.columns == ["doc_id", "text", "fp", "score", "ids", "n_words", "n_removed", "kept_sha256"]
    found = out.collect()
    assert len(found) == 15
    by_id = {r["doc_id"]: r for r in found}
    assert (by_id[0]["n_removed"], by_id[1]["n_removed"], by_id[2]["n_removed"]) == (0, 40, 40)
    assert by_id[2]["text"] == "before after" and by_id[1]["text"] == ""
    assert by_id[3]["text"] is None and by_id[5]["text"] == " \t\n "
    assert by_id[9]["n_removed"] == 0 and by_id[10]["n_removed"] == 0 and by_id[10]["n_words"] == 15
    assert sorted(r["n_removed"] for r in found if r["doc_id"] is None) == [0, 40]
    assert by_id[8]["n_words"] == 120_000
    assert substring.remove_repeats(no_docs).count() == 0


def test_runs_survive_coding():
    for values in ([5], [1, 2, 3], [0, 1 << 40, (1 << 40) + 7], list(range(0, 10**6, 37))):
        array = np.array(values, np.uint64)
        assert (substring._decode_run(substring._encode_run(array)) == array).all()


def embedding_rows(rng):
    base = rng.normal(size=(150, 20))
    near = [b + 0.05 * rng.normal(size=20) for b in base[:20]]
    hot = [base[30] * s + 0.02 * rng.normal(size=20) for s in rng.random(80) + 0.5]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate([*base, *near, *hot])]
    return rows + [(1000 + i, rows[5][1]) for i in range(60)]


def test_embeddings_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quantise, "LIST_SIZE", 12)
    monkeypatch.setattr(quantise, "BLOCK_MEMBERS", 16)
    monkeypatch.setattr(quantise, "BLOCK_QUERIES", 32)
    rows = embedding_rows(np.random.default_rng(2))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    links = brute.cosine_links(np.array([v for _, v in rows]), 0.9)
    root = brute.groups(len(rows), zip(*np.nonzero(links), strict=True))
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in quantise.near_duplicates(frame).collect()}
    want = {rows[i][0]: (int(links[i].sum()), rows[root[i]][0], root[i] == i) for i in range(len(rows))}
    hits = sum(min(found[i][0], want[i][0]) for i in want)
    assert all(found[i][0] <= want[i][0] for i in want)
    assert hits >= 0.9 * sum(w[0] for w in want.values())
    assert found == want


@pytest.mark.parametrize("shape", ["mixed lengths", "few dimensions"])
def test_embeddings_lose_no_link_at_list_borders(spark, monkeypatch, shape):
    monkeypatch.setattr(quantise, "LIST_SIZE", 8)
    rng = np.random.default_rng(6)
    if shape == "few dimensions":  # two directions of 64 components
        vectors = rng.normal(size=(400, 2)) @ rng.normal(size=(2, 64))
    else:
        vectors = rng.normal(size=(400, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    if shape == "mixed lengths":
        rows.append((400, [float(x) for x in rng.normal(size=1600)]))
    full = np.zeros((len(rows), max(len(v) for _, v in rows)))
    for i, v in rows:
        full[i, : len(v)] = v
    links = brute.cosine_links(full, 0.9)
    root = brute.groups(len(rows), zip(*np.nonzero(links), strict=True))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in quantise.near_duplicates(frame).collect()}
    assert links.any() and found == {i: (int(links[i].sum()), root[i]) for i in range(len(rows))}


def test_embedding_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, []), (8, [1.0, 0.0, 0.0]), (9, [1e300, 1e290]), (10, [1e-300, 0.0]),
            (None, [1.0, 0.0]), (0, [1.0, 0.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, weight string")
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in quantise.near_duplicates(frame).collect()}
    assert {i for i, f in found.items() if f == (0, i, True)} == {2, 3, 4, 5, 6, 7}
    assert found[0] == (4, 0, True) and found[1] == found[8] == found[9] == found[10] == (4, 0, False)
    assert found[None] == (0, None, False)
    assert quantise.near_duplicates(frame.where("false")).count() == 0
    assert quantise.near_duplicates(frame.where("vec_id = 3")).collect()[0]["kept"] is True
