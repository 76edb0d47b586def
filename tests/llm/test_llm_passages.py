"""Ops 1, 8 and 9 against their plain versions."""

import random

import numpy as np
import pytest

import llm_brute
import llm_data
from tripmart.llm import components
from tripmart.llm import ngram_join as ngram
from tripmart.llm.blocks import pack
from tripmart.llm.components import connected_components
from tripmart.llm.cover_dedup import ANCHOR, COVER, PERIOD, WINDOW, cover_dedup
from tripmart.llm.ngram_join import ngram_join
from tripmart.llm.suffix_array import adjacent_prefixes, suffix_array
from tripmart.llm.suffix_dedup import suffix_dedup


def rows_of(df, columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


OP1 = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
OP9 = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def test_suffix_array_sorts_and_measures():
    rng = random.Random(3)
    for _ in range(300):
        letters = rng.choice([b"ab", b"abc", bytes(range(256)), b"\x00\x01\xff", b"a"])
        text = bytes(rng.choice(letters) for _ in range(rng.randint(1, 60)))
        wanted = np.array([rng.random() < .6 for _ in text])
        depth = rng.choice([1, 3, 8, 9, 20, 100])
        order = suffix_array(text, wanted, depth)
        assert sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
        starts = [text[i:i + depth] for i in order]
        assert starts == sorted(starts)
        for k, common in enumerate(adjacent_prefixes(text, order, depth)[1:], 1):
            a, b = text[order[k - 1]:][:depth], text[order[k]:][:depth]
            true = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common == true or (common > true and true == min(len(a), len(b)))


def test_cover_meets_every_shift():
    for i in range(PERIOD):
        for j in range(PERIOD):
            assert any((i + k) % PERIOD in COVER and (j + k) % PERIOD in COVER
                       and k + ANCHOR <= WINDOW for k in range(PERIOD))


@pytest.mark.parametrize("options", [{"block_bytes": 1500}, {"block_bytes": 3000, "hot": 1}])
def test_suffix_dedup_matches_brute_force(spark, options):
    pairs = llm_data.corpus(1)
    got = rows_of(suffix_dedup(llm_data.plain(spark, pairs), **options), OP1)
    assert got == sorted(llm_brute.suffix_dedup(pairs))


def test_suffix_dedup_keeps_the_right_bytes(spark):
    rng = random.Random(8)
    shared = llm_data.prose(rng, 30)
    pairs = [(1, "first " + shared), (2, "second " + shared + " end"), (3, "no copies here")]
    got = {r.doc_id: bytes(r.kept_text) for r in
           suffix_dedup(llm_data.plain(spark, pairs), with_text=True).collect()}
    assert got == {1: pairs[0][1].encode(), 2: b"second end", 3: b"no copies here"}


def test_cover_dedup_matches_brute_force(spark):
    pairs = llm_data.corpus(2)
    got = rows_of(cover_dedup(llm_data.plain(spark, pairs), block_bytes=1500), OP9)
    assert got == sorted(llm_brute.cover_dedup(pairs))


def test_passage_operators_on_edge_rows(spark):
    rows = llm_data.edge_rows()
    docs = llm_data.frame(spark, rows)
    pairs = [(r[0], r[1]) for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    # ties: of repeated rows either may count as the first, with equal results; rows
    # without an id are in storage order
    want1 = llm_brute.suffix_dedup(pairs)
    got1 = [tuple(r) for r in suffix_dedup(docs, block_bytes=4000).collect()]
    assert sorted(got1, key=key)[:-2] == sorted(want1, key=key)[:-2]
    assert len(got1) == len(rows)
    got9 = [tuple(r) for r in cover_dedup(docs, block_bytes=4000).collect()]
    assert {r[0]: r for r in got9 if r[0] not in (None, 6)} == {
        r[0]: r for r in llm_brute.cover_dedup(pairs) if r[0] not in (None, 6)}
    assert sorted(r[2] for r in got9 if r[0] == 6) == sorted(
        r[2] for r in llm_brute.cover_dedup(pairs) if r[0] == 6)


def test_operators_on_an_empty_table(spark):
    docs = spark.createDataFrame([], llm_data.SCHEMA)
    assert suffix_dedup(docs).count() == 0
    assert cover_dedup(docs).count() == 0
    assert ngram_join(docs).count() == 0


@pytest.mark.parametrize("options", [{"block_bytes": 1500, "group": 2}, {"block_bytes": 1 << 20}])
def test_ngram_join_matches_brute_force(spark, options):
    pairs = llm_data.corpus(3, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in
           ngram_join(llm_data.plain(spark, pairs), **options).collect()}
    assert got == llm_brute.ngram_join(pairs)


def test_ngram_join_at_the_threshold(spark):
    base = [f"t{i}" for i in range(203)]  # 200 shingles
    def changed(n):  # n words at the end replaced: n shingles fewer in common
        return " ".join(base[:len(base) - n] + [f"z{i}" for i in range(n)])
    # 184/216 = 0.8519 links, 183/217 = 0.8433 does not
    pairs = [(5, " ".join(base)), (3, changed(16)), (1, changed(17) + " ")]
    got = {r.doc_id: r.component_id for r in ngram_join(llm_data.plain(spark, pairs)).collect()}
    want = {i: c for i, (_, c, _) in llm_brute.ngram_join(pairs).items()}
    assert got == want and got[5] == got[3]


def test_ngram_join_on_edge_rows(spark):
    got = {}
    for r in ngram_join(llm_data.frame(spark, llm_data.edge_rows()), block_bytes=2000).collect():
        got.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert got[1] == got[2][:0] + [(0, 1)] and got[2] == [(0, 2)] and got[3] == [(0, 3)]
    assert got[8] == [(1, 8)] and got[9] == [(1, 8)]  # equal but for case
    assert got[4][0][1] == 4 and got[5][0][1] == 4
    # the same text under 6 (twice), 7 and no id, which is larger than all ids
    assert {c for _, c in got[6] + got[7]} == {6} and len(got[6]) == 2
    assert 6 in {c for _, c in got[None]}


def test_components_with_hot_nodes(spark, monkeypatch):
    """Stars around a hot node, joined by a chain, with loops and repeated edges."""
    monkeypatch.setattr(components, "LEAST_HOT", 20)
    rng = random.Random(3)
    edges = [(5000 + i, 7) for i in range(900)] + [(3, 9000 + i) for i in range(700)]
    edges += [(20000 + i, 20001 + i) for i in range(40)] + [(i, i) for i in range(100, 130)]
    edges += [(5003, 9004), (5003, 9004), (30000, 100)]
    rng.shuffle(edges)
    got = {r.id: r.component for r in
           connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {x: x for e in edges for x in e}
    for _ in range(50):
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want
    loops = spark.createDataFrame([(4, 4), (6, 6)], "a long, b long")
    assert {(r.id, r.component) for r in connected_components(loops).collect()} == {(4, 4), (6, 6)}
    assert connected_components(loops.limit(0)).count() == 0


def test_candidates_of_long_lists():
    """Interleaved groups of one token: every group is spanned, none is joined to
    another, and the list ends once each entry's partners are in its group."""
    rng = np.random.default_rng(8)
    n, kinds = 3000, 3
    kind = rng.integers(0, kinds, n)
    sketch = rng.integers(0, 1 << 63, (kinds, 8), dtype=np.uint64)[kind]
    size = rng.integers(100, 104, n).astype(np.int32)
    payload = pack(token=np.full(n, 77, np.uint64), id=np.arange(n), size=size,
                   place=np.zeros(n, np.int32), **{f"s{c}": sketch[:, c] for c in range(8)})
    edges = list(ngram._candidates(85)([0], [payload]))
    forest = ngram.Forest(n)
    used = forest.join(np.array([e[0] for e in edges]), np.array([e[2] for e in edges]))
    label = forest.labels()
    assert len(used) == len(edges) == n - kinds
    assert all(len(set(label[kind == k].tolist())) == 1 for k in range(kinds))
    assert ngram._next_group(np.array([4, 4, 2, 2, 2, 9])).tolist() == [2, 2, 5, 5, 5, 6]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, j) for j in range(200, 260)] + [(5, 5)]
    got = {r.id: r.component for r in
           connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 141)} == {100}
    assert {got[i] for i in range(200, 260)} == {7} and got[5] == 5


def doubling(a, b, n):
    """A pattern and its complement, whose polynomial hashes modulo 2^64 agree."""
    x, y = a, b
    while len(x) < n:
        x, y = x + y, y + x
    return x, y


@pytest.mark.parametrize("size", [64, 1024, 2048, 8192])
def test_words_of_doubling_patterns_differ(spark, size):
    x, y = doubling("a", "b", size)
    rest = [f"w{k}" for k in range(19)]
    docs = llm_data.plain(spark, [(1, " ".join([x, *rest])), (2, " ".join([y, *rest]))])
    assert {r.doc_id: r.n_removed for r in cover_dedup(docs).collect()} == {1: 0, 2: 0}
    docs = llm_data.plain(spark, [(1, f"{x} a b c"), (2, f"{y} a b c")])
    got = {r.doc_id: (r.component_id, r.class_id) for r in ngram_join(docs).collect()}
    assert got == {1: (1, 1), 2: (2, 2)}


@pytest.mark.parametrize("block_bytes", [10, 400, 1 << 20])
def test_shared_and_missing_ids_have_one_answer(spark, block_bytes):
    """Rows of one id are one node; each has its own set and links."""
    rng = random.Random(4)
    t = [llm_data.prose(rng, 60, 10 ** 6) for _ in range(6)]
    pairs = [(None, t[0]), (None, t[1]), (5, t[1] + " more"), (7, t[2]), (7, t[3]),
             (8, t[3] + " more"), (9, t[2] + " more"), (2, t[4]), (3, t[4]), (3, ""), (4, ""),
             (None, t[5]), (6, t[5]), (6, t[5])]
    got = sorted(((str(r.doc_id), r.n_shingles, r.component_id, r.class_id, r.n_links)
                  for r in ngram_join(llm_data.plain(spark, pairs), block_bytes=block_bytes).collect()),
                 key=str)
    sets = [(i, frozenset(llm_brute.shingles(x))) for i, x in pairs]

    def linked(a, b):
        return bool(a & b) and 100 * len(a & b) >= 85 * len(a | b)

    group = {k: k for k in range(len(sets))}
    changed = True
    while changed:
        changed = False
        for a in group:
            for b in group:
                if group[a] > group[b] and (sets[a][0] == sets[b][0] or linked(sets[a][1], sets[b][1])):
                    group[a], changed = group[b], True
    def name(ks):
        return min((sets[k][0] for k in ks if sets[k][0] is not None), default=None)
    want = sorted(((str(i), len(s), name([j for j in group if group[j] == group[k]]),
                   name([j for j in group if sets[j][1] == s]) if s else i,
                   len({x for _, x in sets if x != s and linked(s, x)}))
                  for k, (i, s) in enumerate(sets)), key=str)
    assert got == want
