"""Language identification as a mixture.

Each language is a distribution over hashed character trigrams of its
lower-cased letters (other characters are one space). A document is a
mixture: expectation-maximisation finds the languages' proportions under
which its trigrams are likeliest. Languages join its set one at a time, the
best first, as long as the log-likelihood less a penalty (half the log of
the number of trigrams for each language, times ``penalty``) rises.

Cases: a text that is null or has no letter is ``und`` with score 0 and no
languages; so is every text if nothing can be learned. Long texts are read
whole (memory follows the text; the counts are bounded by the buckets).
Proportions that tie go to the first language by name. Null languages and
null ids teach nothing. Repeated rows are predicted one by one, an empty table
gives an empty result. Results are keyed by the id column only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.text import bounded_sample, held_out, mix64

BUCKETS = 1 << 16
NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
UNKNOWN = "und"


def letters_only(text: str) -> str:
    """Lower-cased runs of letters between single spaces; empty without a letter."""
    kept = NOT_LETTERS.sub(" ", text.lower()).strip()
    return f" {kept} " if any(c.isalpha() for c in kept) else ""


def trigram_buckets(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of every trigram of a text's letters, in order."""
    kept = letters_only(text) if text else ""
    codes = np.frombuffer(kept.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    if len(codes) < 3:
        return np.empty(0, dtype=np.int64)
    grams = (codes[:-2] << np.uint64(42)) | (codes[1:-1] << np.uint64(21)) | codes[2:]
    return (mix64(grams) % np.uint64(buckets)).astype(np.int64)


@dataclass
class LanguageModel:
    languages: list[str]
    probability: np.ndarray  # buckets x languages
    penalty: float = 1.0
    steps: int = 25

    def mixture(self, seen: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions and log-likelihood by expectation-maximisation;
        ``seen``: trigrams x languages."""
        total = times.sum()
        share = np.full(seen.shape[1], 1.0 / seen.shape[1])
        for _ in range(self.steps if seen.shape[1] > 1 else 0):
            likely = seen @ share
            new = share * ((times / likely) @ seen) / total
            done = np.abs(new - share).max() < 1e-4
            share = new
            if done:
                break
        return share, float(times @ np.log(seen @ share))

    def infer(self, text: str | None) -> dict[str, float]:
        """The document's languages with their proportions, largest first."""
        grams = trigram_buckets(text, len(self.probability))
        if len(grams) == 0 or not self.languages:
            return {}
        buckets, times = np.unique(grams, return_counts=True)
        seen, times = self.probability[buckets], times.astype(float)
        every, _ = self.mixture(seen, times)
        order = sorted(range(len(every)), key=lambda i: (-every[i], self.languages[i]))
        cost = 0.5 * np.log(times.sum()) * self.penalty
        chosen, share, best = [], None, -np.inf
        for i in order:
            if chosen and every[i] * times.sum() < 1.0:
                break  # less than a trigram's worth
            new, likelihood = self.mixture(seen[:, [*chosen, i]], times)
            if (value := likelihood - cost * (len(chosen) + 1)) <= best:
                break
            chosen, share, best = [*chosen, i], new, value
        found = sorted(zip(chosen, share.tolist(), strict=True),
                       key=lambda x: (-x[1], self.languages[x[0]]))
        return {self.languages[i]: p for i, p in found}


def fit(df: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        sample_per_language: int = 2_000, buckets: int = BUCKETS, smoothing: float = 0.5,
        penalty: float = 1.0) -> LanguageModel:
    """Trigram distributions of the non-null languages in ``df``, from about
    ``sample_per_language`` documents of each at most (hashed ids choose
    them). Spark adds up the counts; languages x buckets numbers reach the
    driver, whatever the size of ``df``."""
    known = df.filter(F.col(lang).isNotNull() & F.col(doc_id).isNotNull())
    sample = bounded_sample(known, doc_id, F.col(lang), sample_per_language).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, value in zip(batch["lang"], batch["text"], strict=True):
                if language not in sums:
                    sums[language] = np.zeros(buckets, dtype=np.int64)
                np.add.at(sums[language], trigram_buckets(value, buckets), 1)
        for language, total in sums.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": language, "bucket": at, "n": total[at]})

    rows = (sample.mapInPandas(count, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(set(rows["lang"]))
    counts = np.full((buckets, len(languages)), smoothing)
    place = {x: i for i, x in enumerate(languages)}
    counts[rows["bucket"].to_numpy(dtype=np.int64), [place[x] for x in rows["lang"]]] += \
        rows["n"].to_numpy(dtype=float)
    return LanguageModel(languages, counts / counts.sum(axis=0), penalty)


def predict(df: DataFrame, model: LanguageModel, text: str = "text", doc_id: str = "doc_id",
            ) -> DataFrame:
    """doc_id, lang_pred, score (its proportion) and the whole mixture."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # buckets x languages numbers

    @F.pandas_udf("lang_pred string, score double, mixture map<string, double>")
    def infer(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages = shared.value
        for texts in batches:
            found = [languages.infer(t) for t in texts]
            yield pd.DataFrame({
                "lang_pred": [next(iter(x), UNKNOWN) for x in found],
                "score": [min(1.0, next(iter(x.values()), 0.0)) for x in found],
                "mixture": found})

    return df.select(F.col(doc_id), infer(F.col(text)).alias("found")).select(doc_id, "found.*")


def learn_and_predict(df: DataFrame, modulus: int = 3, remainder: int = 1) -> DataFrame:
    """``predict`` for all of ``df`` after learning from the rows that
    ``held_out`` doesn't keep back; with held_out."""
    out = held_out("doc_id", modulus, remainder)
    model = fit(df.filter(~out))
    found = predict(df.select("doc_id", "text"), model)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "mixture")
