"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of every labelled text per (language, hash bucket) in
numpy, a partial sum per task, added up by Spark. The log-probability matrix
(languages x buckets, both bounded by the labels and a parameter) is
broadcast; scoring gathers the matrix columns of a batch's n-grams and adds
them up per document.

Defined results: a NULL text, or one without a letter, is ``und`` with score
0; so is every text if nothing was learned. Ties go to the smaller language
by code point. Rows with a NULL language teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shipping import ship_package

UNKNOWN = "und"
BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
#: Characters that are turned into n-grams at a time.
_SLICE = 1 << 19
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)  # fixed, odd

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Code point -> is it a letter, for the whole code space; made once per worker."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngram_buckets(texts: list[str], orders=ORDERS, buckets: int = BUCKETS):
    """(bucket of every n-gram, document of every n-gram, letters per document).

    Texts are lower-cased and end with a space; other characters than letters
    count as spaces. N-grams hold a letter and don't cross documents.
    """
    texts = [t.lower() for t in texts]
    codes = np.frombuffer("".join(t + " " for t in texts).encode("utf-32-le", "replace"),
                          np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    letter = _letter_table()[codes]
    codes = np.where(letter, codes, np.uint32(32))
    letters = np.bincount(doc[letter], minlength=len(texts))
    found, owners = [], []
    for n in orders:
        if len(codes) < n:
            continue
        size = len(codes) - n + 1
        h = np.full(size, n, np.uint32)
        some = np.zeros(size, bool)
        for k in range(n):
            h = (h ^ codes[k:k + size]) * _MULTIPLIERS[k % 3]
            h ^= h >> np.uint32(15)
            some |= letter[k:k + size]
        keep = some & (doc[:size] == doc[n - 1:n - 1 + size])
        found.append((h[keep] % np.uint32(buckets)).astype(np.int32))
        owners.append(doc[:size][keep])
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), letters
    return np.concatenate(found), np.concatenate(owners), letters


def _pieces(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Whole texts in slices of about _SLICE characters: (first index, texts)."""
    start, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t) + 1
        if size >= _SLICE:
            yield start, texts[start:k + 1]
            start, size = k + 1, 0
    if start < len(texts):
        yield start, texts[start:]


@dataclass
class LanguageModel:
    langs: list[str]
    log_prob: np.ndarray  # languages x buckets
    log_prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        whole = [t or "" for t in texts]
        langs, scores = [], []
        for _, part in _pieces(whole):
            b, doc, letters = ngram_buckets(part, buckets=max(1, self.log_prob.shape[1]))
            if not self.langs:
                langs += [UNKNOWN] * len(part)
                scores.append(np.zeros(len(part)))
                continue
            total = np.stack([np.bincount(doc, row[b], len(part)) for row in self.log_prob])
            total += self.log_prior[:, None]
            best = total.argmax(0)
            share = 1 / np.exp(total - total.max(0)).sum(0)
            langs += [self.langs[k] if n else UNKNOWN for k, n in zip(best, letters)]
            scores.append(np.where(letters > 0, share, 0.0))
        return langs, np.concatenate(scores) if scores else np.zeros(0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of one task: a row per (language, bucket) seen."""
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for first, part in _pieces(texts):
            own = langs[first:first + len(part)]
            names = sorted(set(own))
            label = np.array([names.index(x) for x in own])
            b, doc, _ = ngram_buckets(part)
            both = np.bincount(label[doc] * BUCKETS + b, minlength=len(names) * BUCKETS)
            for name, row in zip(names, both.reshape(len(names), BUCKETS)):
                counts[name] = counts.get(name, 0) + row
            for name in own:
                docs[name] = docs.get(name, 0) + 1
    for name, row in counts.items():
        seen = np.flatnonzero(row)
        bucket = np.append(seen, BUCKETS)  # the last one holds the documents
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(bucket)), pa.array(bucket.astype(np.int32)),
             pa.array(np.append(row[seen], docs[name]).astype(np.int64))],
            ["lang", "bucket", "n"])


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from every row of ``labelled`` with a text and a language. The
    sums that come to the driver are languages x BUCKETS numbers."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.dropna()
    ship_package(labelled.sparkSession)
    sums = (rows.mapInArrow(_count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(sums["lang"].unique())
    table = np.full((len(langs), BUCKETS), SMOOTHING)
    prior = np.zeros(len(langs))
    for k, name in enumerate(langs):
        own = sums[sums["lang"] == name]
        buckets, n = own["bucket"].to_numpy(), own["n"].to_numpy()
        table[k, buckets[buckets < BUCKETS]] += n[buckets < BUCKETS]
        prior[k] = np.log(n[buckets == BUCKETS].sum())
    log_prob = np.log(table) - np.log(table.sum(1, keepdims=True))
    return LanguageModel(langs, log_prob.astype(np.float32), prior)


def predictor(spark, model: LanguageModel):
    """A column function: text -> struct(lang, score). The model goes out once."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        langs, scores = shared.value.predict(texts.where(texts.notna(), None).tolist())
        return pd.DataFrame({"lang": langs, "score": scores})

    return predict


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1 (a NULL id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1
