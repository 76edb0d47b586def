"""Ops 2, 4, 5 and 10: per-document operators."""

import base64
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import llm_brute
import llm_data
from conftest import SF_SMALL
from oracle_check import canon
from tripmart.llm import bpe, divergence, langid, queries, toxicity

SF = SF_SMALL.replace("0.001", "0.01")


# --- op 2 --------------------------------------------------------------------
def test_base_counts_match_brute_force(spark):
    rows = llm_data.edge_rows() + [
        llm_data.row(20, "a b c a b c a b c " * 20), llm_data.row(21, "x y\nx y\n \nx y\n#&|"),
        llm_data.row(22, llm_data.prose(random.Random(1), 300, 12), "fr")]
    got = divergence.quality_rules(llm_data.frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted((str(r[0]), *llm_brute.base_counts(r[1])) for r in rows)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)


def test_divergence_drops_junk_and_keeps_prose(spark):
    out = queries.op2_distribution_divergence(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    shares = {r.quality: (r.n, r.kept) for r in out.filter("not base_failed").join(labels, "doc_id")
              .groupBy("quality").agg(F.count("*").alias("n"),
                                      F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert shares[1][1] > 0.99 and shares[0][1] < 0.1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_divergence_without_a_known_language(spark):
    rng = random.Random(4)
    def text(letters, n=120):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9)))
                        for _ in range(n))
    prose, other, junk = "abcdefghijklmnopqrstuvwxyz", "бвгдежзиклмн", "#$%|0123456789"
    rows = [llm_data.row(i, text(prose), "en") for i in range(20)]
    rows += [llm_data.row(100 + i, text(other), "ru") for i in range(20)]
    rows += [llm_data.row(200, text(junk), None), llm_data.row(201, text(junk), "ru"),
             llm_data.row(202, text(prose), None), llm_data.row(203, text(other), None)]
    got = {r.doc_id: r for r in divergence.quality_rules(llm_data.frame(spark, rows)).collect()}
    assert len(got) == len(rows) and not any(r.base_failed for r in got.values())
    assert {i for i, r in got.items() if not r.kept} == {200, 201}
    # to the nearer of the two; the junk in it counts in the reference of "ru"
    assert got[202].char_distance < 0.1 and got[203].char_distance < 0.2
    assert got[200].word_distance is None and got[201].word_distance is None
    # no row has a language
    bare = [(*r[:2], None, *r[3:]) for r in rows[:20] + rows[40:41]]
    left = divergence.quality_rules(llm_data.frame(spark, bare)).filter("kept").collect()
    assert sorted(r.doc_id for r in left) == list(range(20))


@pytest.mark.parametrize("named", [True, False])
def test_divergence_sql_with_awkward_languages(spark, tmp_path, named):
    """Rows of no language, of one without a word list, and of one in which
    nothing passes the base rules; then no row has a language."""
    rng = random.Random(9)
    common = divergence.COMMON_WORDS["en"]
    rows = []
    for i in range(60):
        lang = ["en", "en", "xx", None, "fr"][i % 5] if named else None
        n = rng.randint(10, 49) if lang == "fr" else rng.randint(40, 160)
        letters = "XYZ#$%19" if i % 12 == 1 else "abcdefgh"
        words = [rng.choice(common) if rng.random() < 0.4 and letters[0] == "a" else
                 "".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n)]
        rows.append(llm_data.row(i, " ".join(words), lang))
    rows += [llm_data.row(100, None, None), llm_data.row(101, "", "fr")]
    llm_data.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.op2_distribution_divergence(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    res = con.execute(queries.ORACLE_SQL["op2_distribution_divergence"])
    columns = [d[0] for d in res.description]
    got = [tuple(r) for r in df.collect()]
    assert canon(got, df.columns) == canon(res.fetchall(), columns)
    kept = {r[df.columns.index("kept")] for r in got if not r[df.columns.index("base_failed")]}
    assert kept == {True, False} or not named


def test_word_limit_narrows_with_length(spark):
    """A sample of the reference stays at every length; other words don't."""
    rng = np.random.default_rng(3)
    share = np.append(np.full(20, 0.02), 0.6)
    rows = [(n, rng.multinomial(n, share).tolist()) for n in (50, 80, 200, 2000) for _ in range(200)]
    rows += [(n, [0] * 20 + [n]) for n in (80, 200, 2000)]
    ref = F.array(*[F.lit(int(x)) for x in share * 1000])
    df = spark.createDataFrame(rows, "n int, counts array<int>").select(
        "n", (F.get("counts", 20) == F.col("n")).alias("bare"),
        divergence.jensen_shannon(F.col("counts"), ref, F.col("n"), F.lit(1000.0)).alias("d"),
        divergence._word_limit(ref, F.lit(1000.0), F.col("n"), divergence.WORD_SHARE).alias("limit"))
    got = df.collect()
    assert all(r.d > r.limit for r in got if r.bare)
    assert all(r.d <= r.limit for r in got if not r.bare)
    limits = [r.limit for r in got if not r.bare]
    assert limits == sorted(limits, reverse=True)


def test_jensen_shannon(spark):
    df = spark.createDataFrame([([1, 1], [2, 2], [0, 5], [0, 0])], "a array<long>, b array<long>, "
                               "c array<long>, z array<long>")
    def js(a, b):
        return divergence.jensen_shannon(a, b, divergence.total(a), divergence.total(b))

    r = df.select(js(F.col("a"), F.col("b")).alias("same"), js(F.col("a"), F.col("c")).alias("far"),
                  js(F.array(F.lit(1), F.lit(0)), F.col("c")).alias("apart"),
                  js(F.col("a"), F.col("z")).alias("none")).first()
    assert r.same == 0 and r.apart == 1 and r.none is None
    m = np.array([.25, .75])
    p, q = np.array([.5, .5]), np.array([0, 1.])
    want = (np.sum(p * np.log2(p / m)) + np.log2(1 / .75)) / 2
    assert r.far == pytest.approx(np.sqrt(want))


# --- op 4 --------------------------------------------------------------------
def test_toxicity_on_held_out_documents(spark):
    larger = SF_SMALL.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    model = toxicity.train(docs.filter(~held), labels)
    got = toxicity.toxicity_chain(docs.filter(held), model).join(labels.withColumnRenamed(
        "toxic", "label"), "doc_id").collect()
    assert len(model.models) == len(toxicity.CATEGORIES)
    assert [len(m.dense) for m in model.models] == [0, 1, 2]  # each sees the ones before it
    assert sum(r.toxic for r in got if not r.label) <= 0.002 * len(got)
    assert sum(r.toxic for r in got if r.label) >= 0.9 * sum(r.label for r in got)


def test_toxicity_edge_rows(spark):
    docs = llm_data.frame(spark, llm_data.edge_rows())
    empty = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    got = toxicity.toxicity_chain(docs, empty).collect()
    assert len(got) == 18 and all(r.p_toxic == 0 and not r.toxic for r in got)
    labels = spark.createDataFrame([(8, 1), (10, 0), (11, None), (99, 1), (None, 1)],
                                   "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert toxicity.toxicity_chain(docs, model).count() == 18
    assert toxicity.toxicity_chain(docs.limit(0), model).count() == 0


def test_chain_matches_plain_loops(spark):
    """Every model sees the probabilities before it: out of fold in training,
    its own predecessors' when scoring."""
    rng = random.Random(6)
    bad = sorted(toxicity.LEXICON["insult"])[:3] + sorted(toxicity.LEXICON["contempt"])[:2]
    texts, toxic = [], []
    for i in range(240):
        words = [f"w{rng.randrange(60)}" for _ in range(20)]
        toxic.append(int(i % 4 == 0))
        texts.append(" ".join(words + rng.sample(bad, 2) * toxic[-1]))
    docs = llm_data.frame(spark, [llm_data.row(i, t) for i, t in enumerate(texts)])
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    order = [r.doc_id for r in labels.orderBy(F.xxhash64("doc_id")).collect()]
    texts, toxic = [texts[i] for i in order], [toxic[i] for i in order]
    # screening: features of at least 3 documents, far from chance
    seen, base = {}, sum(toxic) / len(toxic)
    for t, x in zip(texts, toxic):
        for f in toxicity.features_of(t):
            n, k = seen.get(f, (0, 0))
            seen[f] = n + 1, k + x
    far = {f for f, (n, k) in seen.items() if n >= 3 and (k - n * base) ** 2 / max(
        n * base * (1 - base) * (1 - n / (len(toxic) + 1)), 1e-9) >= toxicity.LEAST_CHI_SQUARED}
    assert set(model.columns) == far
    y = np.array(toxic, float)
    rows = model.rows(texts)
    fold = np.arange(len(y)) % toxicity.FOLDS
    for lists in (toxicity.LEXICON["insult"], toxicity.LEXICON["contempt"]):
        assert any(lists & set(t.split()) for t in texts)
    # the second and third model, fitted anew to held-out probabilities
    earlier = np.zeros((len(y), 0))
    for k, name in enumerate(toxicity.CATEGORIES):
        goal = y if name == "toxic" else np.array(
            [float(t and bool(toxicity.LEXICON[name] & set(x.split()))) for x, t in zip(texts, y)])
        whole = toxicity.fit_linear(rows, earlier, goal, len(set(model.columns.values())))
        assert np.allclose(whole.sparse, model.models[k].sparse)
        assert np.allclose(whole.dense, model.models[k].dense)
        held = np.zeros(len(y))
        for f in range(toxicity.FOLDS):
            part = toxicity.fit_linear([r for r, g in zip(rows, fold) if g != f],
                                       earlier[fold != f], goal[fold != f], len(whole.sparse))
            held[fold == f] = part.probability([r for r, g in zip(rows, fold) if g == f],
                                               earlier[fold == f])
        earlier = np.column_stack([earlier, held])
    got = model.predict(texts[:40])
    for i in range(40):
        done = []
        for m in model.models:
            z = m.bias + sum(m.sparse[j] for j in rows[i]) + sum(a * b for a, b in
                                                                 zip(m.dense, done))
            done.append(1 / (1 + math.exp(-z)))
        assert got[i] == pytest.approx(done)


# --- op 5 --------------------------------------------------------------------
def test_language_of_held_out_documents(spark):
    out = queries.op5_language_id(spark, SF).alias("o").join(
        spark.read.parquet(f"{SF}/documents.parquet").alias("d"), "doc_id")
    r = out.filter("held_out and lang is not null").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("hit"),
        F.count("*").alias("n")).first()
    assert r.n > 200 and r.hit > 0.98


def test_language_edge_rows(spark):
    docs = llm_data.frame(spark, llm_data.edge_rows())
    model = langid.train(docs)
    assert model.langs == ["en"]
    out = {str(r.doc_id): r.p for r in docs.select("doc_id", langid.predictor(spark, model)(
        F.col("text")).alias("p")).collect()}
    for i in ("1", "2", "3"):
        assert out[i].lang == "und" and out[i].score == 0
    assert out["4"].lang == "en" and out["4"].score == 1
    nothing = langid.train(docs.limit(0))
    assert nothing.predict(["text", None]) [0] == ["und", "und"]


def test_ngrams_match_a_plain_count():
    texts = ["Ab c", "", "été 1x"]
    buckets, owner, letters = langid.ngram_buckets(texts)
    assert letters.tolist() == [3, 0, 4]
    plain = [sum(any(c.isalpha() for c in t[i:i + n]) for n in (1, 2, 3)
                 for i in range(len(t) - n + 1)) for t in (t + " " for t in texts)]
    assert np.bincount(owner, minlength=3).tolist() == plain
    again = langid.ngram_buckets(["AB C"])[0]
    assert sorted(again) == sorted(buckets[owner == 0])


def plain_bayes(labelled, texts, buckets):
    """Multinomial naive Bayes with dictionaries, an n-gram at a time."""
    def hashed(text):
        return langid.ngram_buckets([text], buckets=buckets)[0].tolist()

    seen, docs = {}, {}
    for text, lang in labelled:
        docs[lang] = docs.get(lang, 0) + 1
        for b in hashed(text):
            seen.setdefault(lang, {})
            seen[lang][b] = seen[lang].get(b, 0) + 1
    out = []
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        logs = {}
        for lang in docs:
            own = seen.get(lang, {})
            total = sum(own.values()) + langid.SMOOTHING * buckets
            logs[lang] = math.log(docs[lang]) + sum(
                math.log((own.get(b, 0) + langid.SMOOTHING) / total) for b in hashed(text))
        best = min(logs, key=lambda k: (-logs[k], k))
        out.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    return out


def test_language_matches_a_plain_naive_bayes(spark):
    rng = random.Random(11)
    alphabets = {"aa": "abcdeé", "bb": "abcxyz", "cc": "бвгa"}
    def text(lang, n):
        return "".join(rng.choice(alphabets[lang] + "  ,1") for _ in range(n))
    labelled = [(text(k, rng.randint(0, 60)), k) for k in alphabets for _ in range(8)]
    labelled += [("only here", "dd"), ("", "ee")]
    asked = [text(rng.choice(list(alphabets)), n) for n in (1, 2, 3, 5, 8, 13, 40, 90)] * 4
    asked += [None, "", "12 ,", "only", "abc", "É", "unseen 漢字"]
    rows = [llm_data.row(i, t, k) for i, (t, k) in enumerate(labelled)]
    rows += [llm_data.row(500, "never learned from", None), llm_data.row(501, None, "aa")]
    model = langid.train(llm_data.frame(spark, rows))
    langs, scores = model.predict(asked)
    for t, lang, score, want in zip(asked, langs, scores,
                                    plain_bayes(labelled, asked, langid.BUCKETS)):
        assert score == pytest.approx(want[1], abs=1e-4), t
        assert lang == want[0] or score < 0.51, t


# --- op 10 -------------------------------------------------------------------
@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path(queries.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def test_bpe_matches_the_library(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    monkeypatch.setattr(bpe, "CACHE_STRETCHES", 40)
    rng = random.Random(2)
    parts = [" ", "  ", "\n", "\t", "a", "b", "é", "ab", "the", "'s", "'ll", "1", "23", "!", "...",
             "　", "\x1c", "\x85", "漢", "😀", "\r\n", "ing", "aaaa", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    texts += [None, "", "a" * 5000 + " " + "ab" * 5000, " " * 300, "x" * 63 + " " + "x" * 65]
    with open(public_tokenizers.path(queries.VOCABULARY), "rb") as f:
        coder = bpe.ByteBpe(bpe.parse_ranks(f.read()), public_tokenizers.PATTERN)
    for text, ids in zip(texts, coder.encode_all(texts)):
        assert ids == reference.encode_ordinary(text or "")
        assert coder.decode(ids) == (text or "").encode()


def test_bpe_round_trip_in_spark(spark, reference):
    rows = llm_data.edge_rows()
    shared = queries.shared_vocabulary(spark)
    docs = llm_data.frame(spark, rows)
    got = docs.select("text", bpe.round_trip(shared)(F.col("text")).alias("d"),
                      bpe.decoder(shared)(bpe.encoder(shared)(F.col("text"))).alias("back")).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = reference.encode_ordinary(r.text or "")
        assert r.d.n_tokens == len(ids)
        assert r.d.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.d.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
        assert bytes(r.back) == (r.text or "").encode()


def test_tokenize_slices_are_bounded_in_bytes():
    import pyarrow as pa

    small, long = "a" * 10, "é" * bpe.SLICE_BYTES
    texts = [small] * 1200 + [long, None, long, small] + ["b" * (bpe.SLICE_BYTES // 3)] * 7 + [None]
    for column in (pa.array(texts), pa.array([small, *texts]).slice(1)):
        cuts = list(bpe._slices(column))
        assert [s for s, _ in cuts] == [0, *[s + n for s, n in cuts]][:-1]
        assert sum(n for _, n in cuts) == len(texts)
        for start, n in cuts:
            size = sum(len((t or "").encode()) for t in texts[start:start + n])
            assert n <= bpe.SLICE_ROWS and (n == 1 or size <= bpe.SLICE_BYTES)
    assert list(bpe._slices(pa.array([], pa.string()))) == []


def test_a_word_is_remembered_once():
    import public_tokenizers

    with open(public_tokenizers.path(queries.VOCABULARY), "rb") as f:
        own = bpe.ByteBpe(bpe.parse_ranks(f.read()), public_tokenizers.PATTERN)
    text = " ".join(f"zqx{i}v 9{i} \n {i}'s" for i in range(300)) + " \t x  y"
    ids = own.encode(text)
    assert own.decode(ids) == text.encode() and own.encode(text) == ids
    assert own.stretches.new and not any(" " + s in own.pieces.new for s in own.stretches.new)
    own.forget()
    assert own.encode(text) == ids


def test_picked_features_need_no_join(spark):
    """Rows that share a feature meet in no join, so nothing grows with their number."""
    found = [["clown", "a"], ["clown", "b", "clow~"], [], ["clown", "clown"]]
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(found)],
                                 "at int, found array<string>")
    def number(word):
        return zlib.crc32(word.encode())
    picked = sorted(map(number, ["clown", "b", "gone"]))
    lists = rows.select("at", toxicity._picked_hashes(picked).alias("h"))
    names = toxicity._names_of(rows, picked)
    for frame in (lists, names):
        assert "Join" not in frame._jdf.queryExecution().optimizedPlan().toString()
    assert {r["at"]: sorted(r["h"]) for r in lists.collect()} == {
        0: [number("clown")], 1: sorted([number("clown"), number("b")]), 2: [], 3: [number("clown")]}
    assert sorted((r["name"], r["hash"]) for r in names.collect()) == [
        ("b", number("b")), ("clown", number("clown"))]
    assert toxicity._names_of(rows, []).collect() == []
    assert [r["h"] for r in rows.select(toxicity._picked_hashes([]).alias("h")).collect()] == [[]] * 4
