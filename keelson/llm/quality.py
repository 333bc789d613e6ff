"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader (FTRL-proximal) updates.

A text's tokens (runs of letters, digits, or other signs) are seen in two
ways: as lower-cased words, and as shapes (kind of capitals, the signs
themselves, ``=`` for a word that repeats the one before). One- and two-grams
of words and one- to three-grams of shapes are hashed into ``2**bits``
weights; a feature's value is 1 + log of its count, and the words' and the
shapes' values are each scaled to length 1. A score is the logistic of the
sparse dot product.

Training takes a bounded sample of the labelled rows (about ``SAMPLE`` of
each label, ``text.training_rows``), deals it by hashed id into a fixed number of shards, trains one
learner on each for some epochs as a Spark task (rows weighted so that both
labels count the same), and averages the weights. Logits are scaled to
probabilities by Platt's method, fitted on logits of the sample's rows from the
learners that weren't taught them: those of the other shards (where a sample is
so small that it has one shard only, that one's).

Cases: null and empty texts have no features and score the logistic of the
intercept; texts of any length are read whole; rows without a label, id or
text teach nothing; labels repeated for one id teach once; without any
labelled row every score is 0.5. Repeated documents score alike, an empty table
gives an empty result. Results are keyed by the id column only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.text import WordHashes, held_out, mix64, training_rows

BITS = 18
SAMPLE = 6_000
TOKENS = regex.compile(r"[\p{L}\p{M}]+|\p{N}+|[^\s\p{L}\p{M}\p{N}]+")
_VIEW = [np.uint64(0x1000 + i) for i in range(5)]


class Featurizer:
    """text -> (hashed feature numbers, their values)."""

    def __init__(self, bits: int = BITS):
        self.size = np.uint64(1 << bits)
        self.hashes = WordHashes(300_000)
        self.shape_hash = WordHashes(10_000)

    def _shape(self, token: str) -> str:
        if token.isalpha():
            if token.islower():
                return "x"
            if token.isupper():
                return "X" if len(token) > 1 else "I"
            return "Xx" if token[0].isupper() and token[1:].islower() else "xX"
        return "9" if token[0].isnumeric() else token[:4]

    def _grams(self, ids: np.ndarray, width: int, view: np.uint64) -> np.ndarray:
        if len(ids) < width:
            return np.empty(0, dtype=np.uint64)
        out = np.full(len(ids) - width + 1, view, dtype=np.uint64)
        for i in range(width):
            out = mix64(out + ids[i:len(ids) - width + 1 + i])
        return out % self.size

    def _scaled(self, grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at, times = np.unique(np.concatenate(grams), return_counts=True)
        values = 1.0 + np.log(times)
        return at.astype(np.int64), values / max(1e-9, math.sqrt(float(values @ values)))

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        found = TOKENS.findall(text) if text else []
        if not found:
            return np.empty(0, dtype=np.int64), np.empty(0)
        words = self.hashes.array([t.lower() for t in found])
        shapes = self.shape_hash.array(list(map(self._shape, found)))
        again = np.flatnonzero(words[1:] == words[:-1]) + 1
        shapes[again] = self.shape_hash["="]
        a = self._scaled([self._grams(words, n, _VIEW[n - 1]) for n in (1, 2)])
        b = self._scaled([self._grams(shapes, n, _VIEW[n + 1]) for n in (1, 2, 3)])
        return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])


@dataclass
class Ftrl:
    """FTRL-proximal logistic regression over sparse rows."""

    bits: int = BITS
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02

    def __post_init__(self):
        n = (1 << self.bits) + 1  # the last is the intercept
        self.z, self.n = np.zeros(n), np.zeros(n)

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int, weight: float = 1.0) -> None:
        at = np.append(at, len(self.z) - 1)
        values = np.append(values, 1.0)
        weights = self.weights(at)
        gradient = weight * (logistic(float(weights @ values)) - label) * values
        square = gradient * gradient
        step = (np.sqrt(self.n[at] + square) - np.sqrt(self.n[at])) / self.alpha
        # two features of a row may share a number
        np.add.at(self.z, at, gradient - step * weights)
        np.add.at(self.n, at, square)


def logistic(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-x)) if x >= 0 else math.exp(x) / (1.0 + math.exp(x))


@dataclass
class Model:
    weights: np.ndarray  # 2**bits and the intercept
    bits: int = BITS

    def logit(self, features: tuple[np.ndarray, np.ndarray]) -> float:
        at, values = features
        return float(self.weights[at] @ values) + float(self.weights[-1])

    def score(self, features: tuple[np.ndarray, np.ndarray]) -> float:
        return logistic(self.logit(features))


def platt(logits: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept that turn logits into probabilities: Newton steps
    on the log loss with Platt's smoothed targets, both labels counting the
    same; the slope stays positive."""
    ones, zeros = max(1, int(labels.sum())), max(1, int((labels == 0).sum()))
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    weight = np.where(labels == 1, 0.5 / ones, 0.5 / zeros)
    x = np.column_stack([logits, np.ones_like(logits)])
    found = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + 1e-4 * np.array([found[0] - 1, 0])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
        found = found - step
        if np.abs(step).max() < 1e-6:
            break
    return max(1e-3, float(found[0])), float(found[1])


def fit(rows: DataFrame, shards: int = 6, epochs: int = 6, bits: int = BITS) -> Model:
    """Averaged weights of ``shards`` learners over the training rows
    (doc_id, y, text). 2**bits weights for each shard, and the logits of the
    rows, a bounded sample, reach the driver."""
    rows = rows.withColumn("turn", F.xxhash64(F.lit("order"), F.col("doc_id").cast("string"), "text"))
    rows = rows.withColumn("shard", F.pmod("turn", F.lit(shards)))

    def train(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["turn", "y"])
        make, learner = Featurizer(bits), Ftrl(bits)
        features = [make(t) for t in group["text"]]
        share = group["y"].value_counts(normalize=True)
        for _ in range(epochs):
            for (at, values), y in zip(features, group["y"], strict=True):
                learner.learn(at, values, y, 0.5 / share[y])
        weights = learner.weights(slice(None))
        return pd.DataFrame({"shard": group["shard"].iloc[:1], "weights": [weights.tobytes()]})

    trained = rows.groupBy("shard").applyInPandas(train, "shard long, weights binary").collect()
    learners = {r["shard"]: np.frombuffer(r["weights"]) for r in sorted(trained)}
    if not learners:
        return Model(np.zeros((1 << bits) + 1), bits)
    model = Model(sum(learners.values()) / len(learners), bits)
    untaught = {}
    for shard in learners:
        others = [w for s, w in learners.items() if s != shard] or [learners[shard]]
        untaught[shard] = Model(sum(others) / len(others), bits)
    measured = rows.select("y", _untaught_logit(rows, untaught)("shard", "text").alias("x")).collect()
    x, y = (np.array([r[c] for r in measured], dtype=float) for c in ("x", "y"))
    if len(np.unique(y)) == 2:
        slope, shift = platt(x, y)
        model.weights *= slope
        model.weights[-1] += shift
    return model


def _untaught_logit(df: DataFrame, models: dict[int, Model]):
    """(shard, text) -> the logit of the model that wasn't taught the shard."""
    shared = df.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("double")
    def logit(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        models, make = shared.value, None
        for shards, texts in batches:
            make = make or Featurizer(next(iter(models.values())).bits)
            yield pd.Series([models[s].logit(make(t)) for s, t in zip(shards, texts, strict=True)],
                            dtype=float)

    return logit


def score_udf(df: DataFrame, model: Model):
    """text -> score, as a pandas UDF; the model (2**bits numbers) is broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        make = Featurizer(model.bits)
        for texts in batches:
            yield pd.Series([model.score(make(t)) for t in texts], dtype=float)

    return score


def learn_and_score(docs: DataFrame, labels: DataFrame, modulus: int = 3,
                    remainder: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted for all of ``docs``."""
    model = fit(training_rows(docs, labels, "quality", modulus, remainder, SAMPLE))
    score = score_udf(docs, model)
    return (docs.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"),
                        score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
