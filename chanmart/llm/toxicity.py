"""A toxicity classifier regularised by counterfactuals.

Features are the presence of words and of word beginnings (inflected insults
share a stem).  A logistic model is fitted to a bounded sample of labelled
rows (``TRAIN_ROWS``, smallest hash of the id first, exact copies once): the
features most unevenly spread over the labels enter (at most ``FEATURES`` of
chi-square ``CHI_SQUARE`` or more), and besides the log-loss the fit pays for every change of the
score when the identity terms of a labelled text are swapped for other terms
of their group.  Mentions of a group thus can't carry weight that the same
sentence about another group would not.  Scoring covers every document with
the model broadcast (at most ``FEATURES`` weights); nothing is shuffled.

Defined cases: NULL and empty texts have no feature and get the intercept's
score; rows whose label or id is NULL aren't learned from; an id labelled
twice, or a text under two ids, counts as toxic if either row says so; without labels every score is
0.5; with one label only it is the smoothed share; an empty table gives no
rows.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanmart.llm.common import byte_texts, crc32_of_id, prepare, tidy

TRAIN_ROWS = 20_000
FEATURES = 4096
MIN_DOCS = 3
#: Least chi-square of a feature; keeps chance features out where labels are few.
CHI_SQUARE = 15.0
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
PAIR_WEIGHT = 5.0
#: Groups of identity terms; a term is swapped for the next of its group.
IDENTITY_GROUPS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("woman", "man"),
    ("women", "men"),
    ("female", "male"),
    ("immigrant", "citizen", "refugee"),
    ("immigrants", "citizens", "refugees"),
    ("deaf", "blind", "disabled", "elderly", "young"),
    ("muslimisch", "christlich", "jüdisch"),
    ("frauen", "männer"),
    ("schwarze", "weiße"),
    ("musulman", "chrétien", "juif"),
    ("femmes", "hommes"),
    ("musulmán", "cristiano", "judío"),
    ("mujeres", "hombres"),
)
SWAP = {term: group[(i + 1) % len(group)] for group in IDENTITY_GROUPS for i, term in enumerate(group)}
_WORD = re.compile(r"\w+")


def words_of(text: bytes) -> set[str]:
    return set(_WORD.findall(text.decode("utf-8", "replace").lower()))


def word_features(word: str) -> list[str]:
    """The word itself and its beginnings, marked by a trailing ``*``."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


class Scorer:
    """Weights of a fitted model, with each seen word's features remembered."""

    def __init__(self, weights: dict[str, float], intercept: float):
        self.number = {f: i for i, f in enumerate(weights)}
        self.weights = np.array(list(weights.values()), np.float64)
        self.intercept = intercept
        self.memo: dict[str, tuple[int, ...]] = {}

    def features(self, words: set[str]) -> set[int]:
        memo = self.memo
        if len(memo) > 150_000:
            memo.clear()
        out: set[int] = set()
        for w in words:
            known = memo.get(w)
            if known is None:
                known = memo[w] = tuple(self.number[f] for f in word_features(w) if f in self.number)
            if known:
                out.update(known)
        return out

    def score(self, text: bytes) -> float:
        found = sorted(self.features(words_of(text)))
        z = self.intercept + math.fsum(self.weights[found])
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def swapped(words: set[str]) -> set[str] | None:
    """The words with identity terms swapped, or None where there are none."""
    if not any(w in SWAP for w in words):
        return None
    return {SWAP.get(w, w) for w in words}


def fit(rows: list[list[int]], pairs: list[tuple[list[int], list[int]]], labels: np.ndarray, n_features: int, pair_weight: float = PAIR_WEIGHT, l2: float = 1e-5, rounds: int = 300):
    """Weights and intercept of the penalised logistic fit by full-batch Adam.

    ``pairs``: features of a labelled text and of its counterfactual; the fit
    pays ``pair_weight`` times the mean squared change of the score's logit.
    """

    def sparse(lists):
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.repeat(np.arange(len(lists)), lengths), np.fromiter((f for x in lists for f in x), np.int64, int(lengths.sum()))

    r, c = sparse(rows)
    ar, ac = sparse([a for a, _ in pairs])
    br, bc = sparse([b for _, b in pairs])
    n, y = len(rows), labels.astype(np.float64)
    w, b = np.zeros(n_features), math.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    m, v, mb, vb = np.zeros(n_features), np.zeros(n_features), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = b + np.bincount(r, w[c], n)
        e = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - y
        g = np.bincount(c, e[r], n_features) / n + l2 * w
        if pairs:
            change = np.bincount(ar, w[ac], len(pairs)) - np.bincount(br, w[bc], len(pairs))
            change *= 2 * pair_weight / len(pairs)
            g += np.bincount(ac, change[ar], n_features) - np.bincount(bc, change[br], n_features)
        gb = e.mean()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        step = 0.1 / (1 + t / 100)
        w -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        b -= step * (mb / (1 - 0.9**t)) / (math.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    return w, b


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``rows`` labelled texts outside the held-out fold: text, toxic; exact copies once."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(crc32_of_id(F.col("doc_id")) % 3 != 1)
    chosen = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    labelled = texts.join(F.broadcast(chosen), "doc_id")  # at most ``rows`` small rows
    return labelled.groupBy("text").agg(F.max("toxic").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, features: int = FEATURES, pair_weight: float = PAIR_WEIGHT) -> tuple[dict[str, float], float]:
    """Weights by feature and the intercept."""
    sample = training_sample(docs, labels, rows).withColumn("toxic", (F.col("toxic") > 0).cast("int")).persist()
    try:
        n, positive = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
        if not 0 < positive < n:
            return {}, math.log((positive + 0.5) / (n - positive + 0.5))

        @tidy
        def spread(batches):
            counts: dict[str, list[int]] = {}
            for batch in batches:
                for text, toxic in zip(byte_texts(batch.column(0)), batch.column(1).to_pylist()):
                    words = words_of(text)
                    for f in {f for w in words | (swapped(words) or set()) for f in word_features(w)}:
                        counts.setdefault(f, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *(pa.array([x[i] for x in counts.values()], pa.int64()) for i in (0, 1))], names=["f", "clean", "toxic"])

        counts = sample.mapInArrow(spread, "f string, clean long, toxic long").groupBy("f").agg(F.sum("clean").cast("double").alias("a"), F.sum("toxic").cast("double").alias("b"))
        a, b = F.col("a"), F.col("b")
        negative = float(n - positive)
        gap = a * float(positive) - b * negative
        chi = gap * gap / ((a + b) * (F.lit(float(n)) - a - b + 0.5)) * (n / (positive * negative))
        chosen = counts.filter((a + b >= MIN_DOCS) & (chi >= CHI_SQUARE)).orderBy(chi.desc(), "f").limit(features)
        vocabulary = [r["f"] for r in chosen.select("f").collect()]  # at most ``features``
        terms = sample.sparkSession.sparkContext.broadcast(vocabulary)

        @tidy
        def encode(batches):
            scorer = Scorer(dict.fromkeys(terms.value, 0.0), 0.0)
            for batch in batches:
                plain, other = [], []
                for text in byte_texts(batch.column(0)):
                    words = words_of(text)
                    swap = swapped(words)
                    plain.append(sorted(scorer.features(words)))
                    other.append(None if swap is None else sorted(scorer.features(swap)))
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(plain, pa.list_(pa.int32())), pa.array(other, pa.list_(pa.int32()))], names=["toxic", "plain", "other"])

        rows_ = sample.mapInArrow(encode, "toxic int, plain array<int>, other array<int>").orderBy("plain", "toxic", "other").toArrow().to_pydict()  # bounded by ``rows``
    finally:
        sample.unpersist()
    pairs = [(x, y) for x, y in zip(rows_["plain"], rows_["other"]) if y is not None]
    w, intercept = fit(rows_["plain"], pairs, np.array(rows_["toxic"]), len(vocabulary), pair_weight)
    return {f: float(x) for f, x in zip(vocabulary, w) if abs(x) > 1e-6}, float(intercept)


def score_toxicity(docs: DataFrame, model: tuple[dict[str, float], float], text_col: str = "text", score_col: str = "toxicity") -> DataFrame:
    """The documents with their score; an input column of that name is replaced."""
    prepare(docs.sparkSession)
    docs = docs.drop(score_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def score(batches):
        scorer = Scorer(*sent.value)
        for batch in batches:
            texts = byte_texts(batch.column(batch.schema.get_field_index(text_col)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([scorer.score(t) for t in texts], pa.float64())], names=[*batch.schema.names, score_col])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))


def trained(spark, sf_dir: str, docs: DataFrame) -> tuple[dict[str, float], float]:
    prepare(spark)
    return train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_toxicity(docs, trained(spark, sf_dir, docs), score_col="score")
    held_out = crc32_of_id(F.col("doc_id")) % 3 == 1
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
