"""Toxicity by a classifier chain.

Categories are predicted one after the other: ``insult`` (a word for a
person), ``contempt`` (a word of scorn), then ``toxic``, the label itself. Each
is a logistic regression over the words of a text, their first letters and
the probabilities of the categories before it. While training, those
probabilities are out of fold, so a later model sees them as uncertain as
they will be on new texts.

The model is fitted on the driver to a bounded sample of labelled documents
(SAMPLE, taken in the order of a hash of doc_id); only the features that
screening leaves are used, and only they leave the tasks. The threshold is the
best one for the sample's out-of-fold probabilities that calls few clean
documents toxic. Scoring reads whole texts.

Defined results: a NULL or empty text has no features, which gives the models'
base rate; without labels of both kinds every probability is 0; a NULL label
teaches nothing; rows that share a doc_id are scored separately.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.shipping import ship_package
from tripmart.session import cut_lineage

CATEGORIES = ("insult", "contempt", "toxic")
#: Words that make a document labelled toxic an example of a category.
LEXICON = {
    "insult": frozenset("clown idiot loser moron scum trash".split()),
    "contempt": frozenset("disgusting pathetic stupid worthless".split()),
}
#: Labelled documents that are learned from, and features that are kept.
SAMPLE = 8000
FEATURES = 3000
#: A feature must be in this many documents of the sample, and so far from
#: chance (chi-squared with one degree of freedom).
LEAST_DOCUMENTS = 3
LEAST_CHI_SQUARED = 20.0
FOLDS = 5
#: Share of the clean documents that the threshold may call toxic.
FALSE_ALARMS = 0.002
_PREFIXES = (4, 5)
# words beyond 100 letters are taken in pieces
_word = re.compile(r"\w{1,100}").findall


def features_of(text: str | None) -> set[str]:
    """The words of a text, and the starts of longer ones (with a mark)."""
    words = set(_word((text or "").lower()))
    found = set(words)
    for n in _PREFIXES:
        found.update({w[:n] + "~" for w in words if len(w) > n})
    return found


@dataclass
class Linear:
    """Logistic regression over sparse 0/1 features and a few dense ones."""

    sparse: np.ndarray
    dense: np.ndarray
    bias: float

    def probability(self, rows: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
        z = np.array([self.sparse[r].sum() for r in rows]) + dense @ self.dense + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(rows: list[np.ndarray], dense: np.ndarray, y: np.ndarray, size: int,
               steps: int = 400, rate: float = 0.1, decay: float = 1e-4) -> Linear:
    """Adam on the mean log loss with a little weight decay; no randomness."""
    lengths = np.array([len(r) for r in rows])
    index = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), lengths)
    width = dense.shape[1]
    w = np.zeros(size + width + 1)
    base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w[-1] = np.log(base / (1 - base))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = np.bincount(owner, w[index], len(rows)) + dense @ w[size:-1] + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(rows)
        g = np.concatenate([np.bincount(index, error[owner], size), dense.T @ error,
                            [error.sum()]])
        g[:-1] += decay * w[:-1]
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Linear(w[:size], w[size:-1], float(w[-1]))


@dataclass
class ChainModel:
    columns: dict[str, int] = field(default_factory=dict)
    models: list[Linear] = field(default_factory=list)
    threshold: float = 0.5

    def __post_init__(self):
        self.names = frozenset(self.columns)

    def rows(self, texts) -> list[np.ndarray]:
        column = self.columns
        return [np.unique(np.array([column[f] for f in self.names & features_of(t)], np.int64))
                for t in texts]

    def predict(self, texts) -> np.ndarray:
        """Probabilities, a column per category."""
        texts = list(texts)
        if not self.models:
            return np.zeros((len(texts), len(CATEGORIES)))
        rows = self.rows(texts)
        done = np.zeros((len(texts), 0))
        for model in self.models:
            done = np.column_stack([done, model.probability(rows, done)])
        return done


def fit_chain(rows: list[np.ndarray], goals: dict[str, np.ndarray], size: int,
              folds: int = FOLDS) -> tuple[list[Linear], np.ndarray]:
    """The models, fitted to rows of feature numbers and a 0/1 goal per category,
    and the out-of-fold probabilities, a column per category."""
    fold = np.arange(len(rows)) % folds
    earlier, models = np.zeros((len(rows), 0)), []
    for name in CATEGORIES:
        goal = goals[name]
        held = np.zeros(len(rows))
        for f in range(folds):
            train, test = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            part = fit_linear([rows[i] for i in train], earlier[train], goal[train], size)
            held[test] = part.probability([rows[i] for i in test], earlier[test])
        models.append(fit_linear(rows, earlier, goal, size))
        earlier = np.column_stack([earlier, held])
    return models, earlier


def best_threshold(probability: np.ndarray, y: np.ndarray) -> float:
    """Where the F1 score of probabilities made out of fold is largest among the
    thresholds that call at most FALSE_ALARMS of the clean documents toxic: half
    way between the last one called and the next."""
    order = np.argsort(-probability, kind="stable")
    p, hits, called = probability[order], np.cumsum(y[order]), np.arange(1, len(y) + 1)
    below = np.append(p[1:], 0.0)
    f1 = 2 * hits / (called + y.sum())
    f1[p == below] = -1  # equal probabilities fall on one side
    f1[called - hits > FALSE_ALARMS * (len(y) - y.sum())] = -1
    best = int(np.argmax(f1))
    return float((p[best] + below[best]) / 2) if f1[best] > 0 else 1.0


def _sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """at (0, 1, ...), toxic and found (features) of the sampled documents."""
    some = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("toxic").cast("int").alias("toxic")).dropna()
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    ship_package(docs.sparkSession)

    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        return texts.where(texts.notna(), None).map(lambda t: sorted(features_of(t)))

    text = F.col("text").cast("string")
    # some: at most ``sample`` rows of two numbers
    rows = cut_lineage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .join(F.broadcast(some), "doc_id")
        .select(F.xxhash64("doc_id").alias("place"), "doc_id", F.md5("text").alias("tie"),
                F.monotonically_increasing_id().alias("tag"), "toxic",
                found("text").alias("found")), "toxicity_features")
    order = ["place", "doc_id", "tie", "tag"]
    first = rows.select(*order).orderBy(*order).limit(sample).withColumn(
        "at", F.row_number().over(Window.orderBy(*order)) - 1)
    return cut_lineage(rows.join(F.broadcast(first.select("tag", "at")), "tag").select(
        "at", "toxic", "found"), "toxicity_sample")


def _screened(rows: DataFrame, n: int, toxic: int) -> DataFrame:
    """hash of the FEATURES features that differ most between the two labels (by
    the chi-squared of their counts; ties by hash), in order."""
    base = toxic / n
    seen = F.col("n").cast("double")
    spread = F.greatest(seen * F.lit(base * (1 - base)) * (1 - seen / F.lit(n + 1.0)), F.lit(1e-9))
    counts = (rows.select("toxic", F.explode(F.array_distinct(_hashes())).alias("hash"))
              .groupBy("hash")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k"))
              .filter(F.col("n") >= LEAST_DOCUMENTS)
              .withColumn("score", F.pow(F.col("k") - seen * F.lit(base), F.lit(2.0)) / spread)
              .filter(F.col("score") >= LEAST_CHI_SQUARED)
              .orderBy(F.col("score").desc(), "hash").limit(FEATURES))
    return counts.select("hash").orderBy("hash")


def _hashes() -> Column:
    return F.transform("found", lambda f: F.crc32(f.cast("binary")))


def _literal(hashes: list[int]) -> Column:
    """One array literal: building it element by element costs a round trip each."""
    return F.expr(f"cast(array({','.join(map(str, hashes))}) as array<bigint>)")


def _picked_hashes(picked: list[int]) -> Column:
    """The picked features of a row, each once. No join: a row stays one row,
    however many rows share its features."""
    return F.array_intersect(_hashes(), _literal(picked))


def _names_of(rows: DataFrame, picked: list[int]) -> DataFrame:
    """name and hash of the picked features."""
    names = rows.select(F.explode("found").alias("name")).withColumn(
        "hash", F.crc32(F.col("name").cast("binary")))
    among = F.expr(f"hash in ({','.join(map(str, picked))})") if picked else F.lit(False)
    return names.filter(among).distinct()


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ChainModel:
    """Fit to at most ``sample`` labelled documents (one row per doc_id). Texts
    become features and are screened in Spark; the driver gets at most FEATURES
    names of bounded length and ``sample`` lists of at most FEATURES numbers."""
    rows = _sample(docs, labels, sample)
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    if not seen["n"] or seen["toxic"] in (0, seen["n"]):
        return ChainModel()
    # at most FEATURES numbers, in order: a feature's column is its place
    picked = [r["hash"] for r in _screened(rows, seen["n"], seen["toxic"]).collect()]
    columns = {r["name"]: bisect_left(picked, r["hash"]) for r in _names_of(rows, picked).collect()}
    flags = [(F.col("toxic").cast("boolean")
              & F.arrays_overlap("found", F.array(*[F.lit(w) for w in sorted(words)]))).alias(name)
             for name, words in LEXICON.items()]
    told = (rows.select("at", "toxic", *flags, _picked_hashes(picked).alias("hashes"))
            .toPandas().sort_values("at"))
    sparse = [np.searchsorted(np.array(picked, np.int64), np.sort(np.array(h, np.int64)))
              for h in told["hashes"]]
    goals = {name: told[name].to_numpy(float) for name in LEXICON}
    y = told["toxic"].to_numpy(float)
    models, held = fit_chain(sparse, goals | {"toxic": y}, len(picked))
    return ChainModel(columns, models, best_threshold(held[:, -1], y))


def scorer(spark: SparkSession, model: ChainModel):
    """Column function: text -> struct of a probability per category."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(", ".join(f"{c} double" for c in CATEGORIES))
    def score(texts: pd.Series) -> pd.DataFrame:
        found = shared.value.predict(texts.where(texts.notna(), None))
        return pd.DataFrame(found, columns=list(CATEGORIES))

    return score


def toxicity_chain(docs: DataFrame, model: ChainModel, threshold: float | None = None) -> DataFrame:
    """Per document: doc_id, p_insult, p_contempt, p_toxic and toxic (p_toxic from
    the threshold on, else from the model's)."""
    threshold = model.threshold if threshold is None else threshold
    score = scorer(docs.sparkSession, model)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text")).alias("p"))
    return out.select("doc_id", *[F.col(f"p.{c}").alias(f"p_{c}") for c in CATEGORIES],
                      (F.col("p.toxic") >= threshold).alias("toxic"))
