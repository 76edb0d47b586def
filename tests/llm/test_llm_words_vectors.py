"""Ops 11, 12 and 13: licenses, hard negatives, spelling variants."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import llm_data
from tripmart.llm import hard_negatives as hn
from tripmart.llm import licenses, spelling

LOWER = {c: c + 32 for c in range(65, 91)}


# --- op 11 -------------------------------------------------------------------
def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def places(phrase, words):
    p = phrase.split()
    return [k for k in range(len(words)) if words[k:k + len(p)] == p]


def plain_scan(texts):
    """(n_words, n_base, first, last, base labels, labels, score) by trying every offset."""
    docs = [plain_words(t) for t in texts]
    vocabulary = {w for _, text, _ in licenses.TEMPLATES for w in text.split()}
    df = Counter(w for d in docs for w in vocabulary.intersection(d))
    out = []
    for words in docs:
        base = [(label, k) for p, label in licenses.PHRASES for k in places(p, words)]
        labels, score = {x for x, _ in base}, float(bool(base))
        for label, text, keys in licenses.TEMPLATES:
            t = text.split()
            rare = sorted(set(t) & set(words), key=lambda w: (df[w], w))[:licenses.RARE]
            for o in range(-len(t), len(words)):
                in_place = [w for q, w in enumerate(t)
                            if 0 <= o + q < len(words) and words[o + q] == w]
                low, high = o - licenses.SLACK, o + len(t) + licenses.SLACK
                if (len(set(in_place) & set(rare)) >= licenses.LEAST_VOTES
                        and len(in_place) >= licenses.LEAST_SHARE * len(t)
                        and all(any(low <= k and k + len(p.split()) <= high
                                    for k in places(p, words)) for p in keys)):
                    labels.add(label)
                    score = max(score, len(in_place) / len(t))
        starts = [k for _, k in base]
        out.append((len(words), len(base), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted({x for x, _ in base})), ",".join(sorted(labels)), score))
    return out


def license_rows():
    rng = random.Random(3)
    filler = [llm_data.prose(rng, rng.randint(0, 40)) for _ in range(12)]
    notices = [text for _, text, _ in licenses.TEMPLATES]
    rows = llm_data.edge_rows()[:3] + llm_data.edge_rows()[5:]
    for k, (_, text, keys) in enumerate(licenses.TEMPLATES):
        words = text.split()
        rows.append(llm_data.row(100 + k, f"{filler[k % 12]}\n{text.title()}. {filler[k % 7]}"))
        free = [j for j, w in enumerate(words) if w not in " ".join(keys).split()]
        words[free[len(free) // 2] if free else 0] = "changed"
        rows.append(llm_data.row(200 + k, " * ".join(words)))
        rows.append(llm_data.row(300 + k, " ".join(rng.sample(words, len(words)))))  # no order
        rows.append(llm_data.row(400 + k, " ".join(text.split()[:len(words) // 2])))  # a half
    return rows + [
        llm_data.row(500, "UNDER THE MIT LICENSE, under-the-mit license;cc-by-nc 4.0"),
        llm_data.row(501, "apache license version 2 apache license version 2.0"),
        llm_data.row(502, " ".join(notices)), llm_data.row(502, " ".join(notices)),
        llm_data.row(503, "under theé mit license under the mit licenses"),
        llm_data.row(None, "released under the mit license")]


def test_license_scan_matches_plain_scan(spark, monkeypatch):
    rows = license_rows()
    want = sorted(map(str, ((r[0], *x) for r, x in zip(rows, plain_scan([r[1] for r in rows])))))
    docs = llm_data.frame(spark, rows)
    got = licenses.scan_licenses(docs)
    assert got.columns[0] == "doc_id" and sorted(map(str, map(tuple, got.collect()))) == want
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[500].base_labels == "cc-by-nc,mit" and by_id[500].n_base == 3
    assert by_id[501].labels == "apache-2" and by_id[501].score == 1.0
    assert set(by_id[502].labels.split(",")) == {t[0] for t in licenses.TEMPLATES}
    for k, (label, _, _) in enumerate(licenses.TEMPLATES):  # one changed word, then no order
        if len(licenses.TEMPLATES[k][1].split()) > 20:
            assert label in by_id[200 + k].labels.split(",")
            assert label not in by_id[300 + k].labels.split(",")
    assert by_id[2].labels == "" and by_id[2].score == 0.0 and by_id[2].first_word is None


def test_license_scan_reads_texts_in_slices(spark, monkeypatch):
    rows = [r for r in license_rows() if r[1]]
    index = licenses.license_index()
    index = index.with_frequencies({"license": 3, "software": 2, "the": 9})
    whole = [index.scan(r[1].encode()) for r in rows]
    monkeypatch.setattr(licenses, "_SLICE", 7)
    assert [index.scan(r[1].encode()) for r in rows] == whole


def test_license_scan_of_nothing(spark):
    empty = spark.createDataFrame([], llm_data.SCHEMA)
    assert licenses.scan_licenses(empty).count() == 0


# --- op 12 -------------------------------------------------------------------
def plain_negatives(rows, is_anchor):
    """rows: (vec_id, label, integer vector)."""
    out = []
    for i, (a_id, a_label, a) in enumerate(rows):
        if not is_anchor(a_id):
            continue
        def score(v):
            return sum(x * y for x, y in zip(a, v))
        ranked = sorted((-score(v), b_id, label == a_label)
                        for k, (b_id, label, v) in enumerate(rows) if k != i)
        for s, p_id, _ in [r for r in ranked if r[2]][:hn.POSITIVES]:
            fits = [(n, n_id) for n, n_id, same in ranked
                    if not same and 50 * -s <= 100 * -n <= 95 * -s][:hn.NEGATIVES]
            out += [(a_id, p_id, k, n_id, -s, -n) for k, (n, n_id) in enumerate(fits, 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, label, v, "x", 1) for i, label, v in rows],
        "vec_id long, label int, embedding array<double>, slot string, score int").repartition(3)


def mined(spark, rows, every=3):
    got = hn.hard_negatives(vectors(spark, rows), F.col("vec_id") % every == 0)
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("kind", ["spread", "tied", "one label", "large"])
def test_hard_negatives_match_all_scores(spark, monkeypatch, kind):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hn, "GROUP_ROWS", 8)
    monkeypatch.setattr(hn, "CHUNK", 2)
    rng = random.Random(kind)
    labels = 1 if kind == "one label" else 4
    rows = []
    for i in range(90):
        if kind == "tied":  # few different vectors, zero and negative scores too
            v = [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(3)]
        elif kind == "large":  # beyond what doubles add up exactly
            v = [rng.uniform(-1, 1) * 2 ** rng.randint(0, 18) for _ in range(5)]
        else:
            v = [rng.gauss(0, 1) / (1 + d) for d in range(rng.choice([5, 7, 7]))]
        rows.append((i, rng.randrange(labels), v))
    rows += [(3, 0, [1.0] * 7), (3, 0, [1.0] * 7), (4, 2, [])]  # shared ids, an empty vector
    plain = [(i, y, [int(256 * x // 1) for x in v] + [0] * (7 - len(v))) for i, y, v in rows]
    got = mined(spark, rows)
    assert got == plain_negatives(plain, lambda i: i % 3 == 0)
    assert bool(got) == (kind != "one label")


def test_hard_negatives_leave_broken_rows_out(spark):
    good = [(i, i % 2, [float(i % 5), 1.0, float(i % 3)]) for i in range(30)]
    broken = [(60, None, [1.0, 1.0, 1.0]), (63, 1, None), (66, 1, [1.0, None, 1.0]),
              (69, 0, [float("nan"), 1.0, 1.0]), (72, 0, [1.0, float("-inf"), 1.0]),
              (None, 1, [1.0, 1.0, 1.0]), (75, 1, [1e300, 0.0, 0.0])]
    plain = [(i, y, [int(256 * x) for x in v]) for i, y, v in good]
    assert mined(spark, good + broken) == plain_negatives(plain, lambda i: i % 3 == 0)
    assert mined(spark, []) == [] and mined(spark, broken) == []


def test_threshold_join_finds_every_row_at_its_threshold():
    rng = random.Random(8)
    rows = [[rng.randint(-300, 300) // (1 + d) for d in range(12)] for _ in range(200)]
    made = hn._Vectors(hn.pack(row=range(200), vec_id=range(200), label=[0] * 200, v=rows))
    every = hn.np.array(rows) @ hn.np.array(rows).T
    some = rng.sample(range(200), 20)
    anchors = hn._Vectors(hn.pack(row=some, vec_id=some, label=[0] * 20, v=[rows[k] for k in some]))
    for share in (0.9, 0.5, 0.1, -0.2):
        floor = share * anchors.rest[:, 0] * made.rest[:, 0].max()
        a, r, s = hn.threshold_join(anchors, made, floor, hn.np.ones((20, 200), bool))
        want = {(i, k) for i in range(20) for k in range(200) if every[some[i], k] >= floor[i]}
        assert set(zip(a.tolist(), r.tolist())) == want
        assert all(s == every[hn.np.array(some)[a], r])


# --- op 13 -------------------------------------------------------------------
def plain_words_of(rows):
    counts = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % spelling.NOISE == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= spelling.LEAST_LETTERS:
                counts[w] += 1
    return {w: n for w, n in counts.items() if n >= spelling.LEAST_COUNT}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def plain_variants(rows):
    n = plain_words_of(rows)
    near = {w: [x for x in n if is_near(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= spelling.RATIO * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=str)


def spelled(rng, n_texts=40):
    """Texts of a few words, their misspellings, and misspellings of those."""
    words = ["banana", "ananas", "aaaaaa", "aaaaaaa", "élèveré", "straßen", "Mississippi",
             "colour", "color", "colours", "a" * 300, "×÷×÷×÷×"]
    for w in words[:8]:
        k = rng.randrange(len(w))
        words += [w[:k] + w[k + 1:], w[:k] + rng.choice("aéz") + w[k:],
                  w[:k] + rng.choice("xyß") + w[k + 1:]]
    weight = [5 ** (3 - min(3, k // 7)) for k in range(len(words))]
    return [" ".join(rng.choices(words, weight, k=60)) + ". " for _ in range(n_texts)]


def test_spelling_variants_match_all_pairs(spark):
    rng = random.Random(11)
    rows = [(i, t) for i, t in enumerate(spelled(rng))]
    rows.append((90, "chainsaw " * 150 + "chainsaws " * 30 + "chainsawss " * 6))
    rows += [(r[0], r[1]) for r in llm_data.edge_rows()] + [(7, rows[0][1]), (None, rows[1][1])]
    got = spelling.spelling_variants(llm_data.plain(spark, rows))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(rows)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert any(w[1] and w[2] != w[1] for w in want)  # a chain of forms is among them


def test_word_counts_cut_long_texts_between_words(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(spelled(random.Random(2), 20))]
    monkeypatch.setattr(spelling, "_SLICE", 50)
    cut = [x for i, t in rows for x in spelling._pieces(t.encode())]
    assert b"".join(cut).decode() == "".join(t for _, t in rows)
    counts = Counter()
    import pyarrow as pa
    table = pa.record_batch([pa.array([str(i) for i, _ in rows]),
                             pa.array([t.encode() for _, t in rows])], ["id", "text"])
    for b in spelling._count([table]):
        for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            counts[w] += n
    assert {w: n for w, n in counts.items() if n >= spelling.LEAST_COUNT} == plain_words_of(rows)


def test_equal_node_numbers_of_different_paths_make_no_neighbours(spark, monkeypatch):
    words = ["abcdef", "abcdeg", "zzzzzz", "zzzzzzz", "qwerty", "qwertz", "unlike", "abcdefg"]
    frame = spark.createDataFrame([(k, w, 9) for k, w in enumerate(words)],
                                  "wid long, word string, n long")
    want = {(a, b) for a in range(8) for b in range(8) if is_near(words[a], words[b])}

    def pairs():
        found = spelling.near_words(frame).collect()
        assert len(found) == len({(r.wid, r.near_wid) for r in found})
        return {(r.wid, r.near_wid) for r in found}

    assert pairs() == want

    def coarse(batches):  # a forward trie of two nodes, a reversed one of two
        for b in spelling._dictionary(batches):
            few = [(b.column(k).to_numpy() & 1) for k in range(2)]
            yield type(b).from_arrays([*few, *b.columns[2:]], b.schema.names)

    monkeypatch.setattr(spelling, "_dictionary", coarse)
    assert pairs() == want


def test_spelling_of_nothing(spark):
    empty = spark.createDataFrame([], llm_data.SCHEMA)
    assert spelling.spelling_variants(empty).count() == 0
