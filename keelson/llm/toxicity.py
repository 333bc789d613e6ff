"""Toxicity: a weighted lexicon matched by an Aho-Corasick automaton.

Words are folded first: lower case, look-alike letters of other scripts to
Latin ones, accents off, and, in words that hold a letter, digits and signs
that stand for letters (1d10t, @, $). The lexicon has whole words and stems
(word beginnings that many different endings follow); a match inside an
exception phrase (a harmless neighbour and the word) doesn't count. A text's
density is the sum of its matches' weights over its number of words
(``FLOOR`` at least); its score is density / (density + pivot), so that the
pivot scores 0.5.

All of it is learned from labelled rows, a bounded sample (about ``SAMPLE``
of each label, ``text.training_rows``): candidates are all words and stems that
lean to toxic rows and occur in 0.3 % of them (so the sample bounds their
number, and nothing else does); weights, the log odds of
toxic against clean, from the number of *different* neighbourhoods a term is
met in (copies of one document count once); exception phrases from clean
rows; the pivot where a lexicon learned from four fifths of the sample
separates the last fifth best (the whole sample, where that fifth has one kind
of rows only).

Cases: null, empty and wordless texts have density and score 0; texts of any
length are read whole; rows without a label, id or text teach nothing; with
no lexicon every score is 0, and an empty table gives an empty result; a
density at the pivot scores 0.5, which is toxic, and pivots that separate
equally well give the least; repeated rows score alike. Results are keyed by
the id column only.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.text import held_out, staged, training_rows

#: A word with the signs that may stand for letters in it.
TOKENS = regex.compile(r"[\p{L}\p{M}\p{N}@$€!|+]*[\p{L}\p{M}\p{N}][\p{L}\p{M}\p{N}@$€|+]*")
#: Look-alikes that compatibility decomposition doesn't map to Latin letters.
LOOKALIKES = str.maketrans({
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ғ": "f", "һ": "h", "і": "i", "ј": "j",
    "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y",
    "х": "x", "ԛ": "q", "ԝ": "w", "ѵ": "v", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i",
    "ɑ": "a", "ɡ": "g", "ɩ": "i", "ո": "n", "օ": "o", "ս": "u", "ց": "g", "հ": "h", "ø": "o",
    "ł": "l", "đ": "d", "ħ": "h"})
LETTER_SIGNS = str.maketrans("01345789@$€!|+", "oieastbgaseilt")
SIGNS = "@$€!|+"
FLOOR = 20
SAMPLE = 4_000
MIN_STEM, MAX_STEM = 3, 8


class Folds(dict):
    """token -> folded token, for those met lately (bounded)."""

    def __missing__(self, token: str) -> str:
        folded = unicodedata.normalize("NFKD", token.lower())
        folded = "".join(c for c in folded if not unicodedata.combining(c)).translate(LOOKALIKES)
        if not folded.isalpha() and any(c.isalpha() for c in folded):
            folded = folded.translate(LETTER_SIGNS)
        if len(token) <= 64:
            if len(self) >= 300_000:
                self.clear()
            self[token] = folded
        return folded


def fold(text: str | None, folds: Folds) -> list[str]:
    return list(map(folds.__getitem__, TOKENS.findall(text))) if text else []


def starts(words: list[str]) -> tuple[str, list[int]]:
    """The words between single spaces, and where each begins."""
    joined = " " + " ".join(words) + " "
    at, out = 1, []
    for word in words:
        out.append(at)
        at += len(word) + 1
    return joined, out


@dataclass
class Lexicon:
    #: term -> weight; a whole word stands between spaces, a stem after one
    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()  # phrases of two words
    pivot: float = 1.0

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            found.add_word(term, (term, weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (f" {phrase} ", None))
        if not len(found):
            return None
        found.make_automaton()
        return found

    def density(self, words: list[str], automaton) -> float:
        if automaton is None or not words:
            return 0.0
        joined = " " + " ".join(words) + " "
        hits: dict[int, float] = {}  # word start -> weight of its heaviest term
        spared: list[tuple[int, int]] = []
        for end, (term, weight) in automaton.iter(joined):
            start = end - len(term) + 2  # after the space
            if weight is None:
                spared.append((start, end))
            else:
                hits[start] = max(weight, hits.get(start, weight))
        if not hits:
            return 0.0
        for start, end in spared:
            for at in [h for h in hits if start <= h < end] if len(hits) < 64 else range(start, end):
                hits.pop(at, None)
        return math.fsum(hits.values()) / max(FLOOR, len(words))

    def score(self, density: float) -> float:
        return density / (density + self.pivot) if density > 0 else 0.0


def _documents(rows: DataFrame) -> DataFrame:
    """(word, toxic, clean): in how many documents of each kind a word is."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        folds, sums = Folds(), {0: Counter(), 1: Counter()}

        def flushed() -> pd.DataFrame:
            part = pd.DataFrame([(w, n if y else 0, 0 if y else n)
                                 for y, c in sums.items() for w, n in c.items()],
                                columns=["word", "toxic", "clean"])
            for c in sums.values():
                c.clear()
            return part

        for batch in batches:
            for text, y in zip(batch["text"], batch["y"], strict=True):
                sums[int(y)].update(set(fold(text, folds)))
                if len(sums[0]) + len(sums[1]) > 200_000:
                    yield flushed()
        yield flushed()

    counted = rows.select("text", "y").mapInPandas(count, "word string, toxic long, clean long")
    return counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _candidates(words: DataFrame, toxic: int, clean: int, least: int) -> list[str]:
    """Whole words and stems that lean to toxic rows, as lexicon terms."""
    rate = (F.col("toxic") / toxic) / (F.col("toxic") / toxic + F.col("clean") / clean)
    whole = words.filter((F.col("toxic") >= least) & (F.length("word") > 1) & (rate >= 0.6)).collect()
    begun = words.select(
        "word", "toxic", "clean",
        F.explode(F.sequence(F.lit(MIN_STEM), F.least(F.lit(MAX_STEM), F.length("word"))))
        .alias("n")).filter(F.length("word") >= MIN_STEM)
    following = begun.groupBy(
        F.expr("substring(word, 1, n)").alias("stem"), F.expr("substring(word, n + 1, 1)").alias("c")
    ).agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    stems = following.groupBy("stem").agg(
        F.max("toxic").alias("most"), F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("ways"),
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    branching = stems.filter((F.col("toxic") >= least) & (rate >= 0.98) & (F.col("ways") >= 4)
                             & (F.col("most") <= 0.6 * F.col("toxic"))).collect()
    kept: set[str] = set()  # none begins with another
    for stem in sorted((r["stem"] for r in branching), key=lambda s: (len(s), s)):
        if not any(stem[:n] in kept for n in range(MIN_STEM, len(stem))):
            kept.add(stem)
    return sorted(f" {r['word']} " for r in whole) + sorted(f" {s}" for s in kept)


def _contexts(rows: DataFrame, terms: list[str]) -> DataFrame:
    """(term, before, word, after, toxic, clean): the neighbourhoods in which
    the terms occur, with how many times in rows of each kind."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        folds, automaton = Folds(), Lexicon(dict.fromkeys(terms, 1.0)).automaton()
        for batch in batches:
            out = []
            for text, y in zip(batch["text"], batch["y"], strict=True):
                words = fold(text, folds)
                joined, begin = starts(words)
                place = {at: i for i, at in enumerate(begin)}
                for end, (term, _) in automaton.iter(joined):
                    i = place[end - len(term) + 2]
                    out.append((term, words[i - 1] if i else "", words[i],
                                words[i + 1] if i + 1 < len(words) else "", int(y), 1 - int(y)))
            yield pd.DataFrame(out, columns=["term", "before", "word", "after", "toxic", "clean"])

    schema = "term string, before string, word string, after string, toxic long, clean long"
    found = rows.select("text", "y").mapInPandas(find, schema)
    return found.groupBy("term", "before", "word", "after").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _exceptions(contexts: DataFrame) -> DataFrame:
    """Phrases of a term's word and a neighbour that only clean rows have,
    in different surroundings."""
    sides = (F.concat_ws(" ", "before", "word").alias("phrase"), F.col("after").alias("rest")), \
        (F.concat_ws(" ", "word", "after").alias("phrase"), F.col("before").alias("rest"))
    both = contexts.filter(F.col("before") != "").select(*sides[0], "toxic", "clean").unionByName(
        contexts.filter(F.col("after") != "").select(*sides[1], "toxic", "clean"))
    found = both.groupBy("phrase").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
        F.count_distinct("rest").alias("ways"))
    return found.filter((F.col("toxic") == 0) & (F.col("clean") >= 3) & (F.col("ways") >= 3)).select(
        "phrase")


def best_pivot(rows: list[tuple[float, int]]) -> float:
    """The density that parts toxic from clean rows best (mean of the two
    rates), in the geometric middle of the gap it lies in."""
    toxic = max(1, sum(y for _, y in rows))
    clean = max(1, len(rows) - sum(y for _, y in rows))
    best, cut, right = -1.0, None, 0.0
    ordered = sorted(rows)
    caught, left = 1.0, 0.0
    for i, (density, y) in enumerate(ordered):
        if density > 0 and (i == 0 or density > ordered[i - 1][0]):
            low = ordered[i - 1][0] if i else 0.0
            if caught + left > best + 1e-12:
                best, cut = caught + left, (low, density)
        caught -= y / toxic
        left += (1 - y) / clean
    if cut is None:
        return 1.0
    low, right = cut
    return math.sqrt(max(low, right / 4) * right)


def fit(rows: DataFrame) -> Lexicon:
    """A lexicon from the training rows (doc_id, y, text), a bounded sample;
    the terms and the phrases around them are what reaches the driver."""
    apart = F.pmod(F.xxhash64(F.lit("pivot"), "doc_id"), F.lit(5)) == 0
    kinds = rows.groupBy(apart.alias("apart"), "y").count().collect()
    if sum(r["apart"] for r in kinds) == sum(not r["apart"] for r in kinds) == 2:
        taught, measured = rows.filter(~apart), rows.filter(apart)
    else:
        taught = measured = rows
    lexicon = _learned(taught)
    densities = measured.select("y", density_udf(measured, lexicon)("text").alias("density")).collect()
    pivot = best_pivot([(r["density"], r["y"]) for r in densities])  # the bounded sample
    if taught is not rows:
        lexicon = _learned(rows)
    lexicon.pivot = pivot
    return lexicon


def _learned(rows: DataFrame) -> Lexicon:
    """Terms, weights and exception phrases."""
    sums = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    toxic, clean = sums.get(1, 0), max(1, sums.get(0, 0))
    if toxic == 0:
        return Lexicon()
    least = max(3, round(0.003 * toxic))
    terms = _candidates(staged(_documents(rows), "toxicity-words"), toxic, clean, least)
    if not terms:
        return Lexicon()
    contexts = staged(_contexts(rows, terms), "toxicity-contexts")
    phrases = staged(_exceptions(contexts), "toxicity-phrases")
    unspared = contexts
    for pair in (("before", "word"), ("word", "after")):
        unspared = unspared.withColumn("phrase", F.concat_ws(" ", *pair)).join(
            phrases, "phrase", "left_anti").drop("phrase")
    met = unspared.groupBy("term").agg(
        F.sum((F.col("toxic") > 0).cast("int")).alias("toxic"),
        F.sum((F.col("clean") > 0).cast("int")).alias("clean")).collect()
    weights = {}
    for r in sorted(met):
        odds = math.log((r["toxic"] + 0.5) / toxic) - math.log((r["clean"] + 0.5) / clean)
        doubt = math.sqrt(1 / (r["toxic"] + 0.5) + 1 / (r["clean"] + 0.5))
        if r["toxic"] >= least and odds - doubt >= math.log(10):
            weights[r["term"]] = odds
    lexicon = Lexicon(weights)
    found = lexicon.automaton()
    if found is not None:  # phrases without a term spare nothing
        lexicon.exceptions = tuple(sorted(r["phrase"] for r in phrases.collect()
                                          if any(True for _ in found.iter(f" {r['phrase']} "))))
    return lexicon


def density_udf(df: DataFrame, lexicon: Lexicon):
    """text -> density, as a pandas UDF; the lexicon (bounded) is broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("double")
    def density(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon, folds = shared.value, Folds()
        automaton = lexicon.automaton()
        for texts in batches:
            yield pd.Series([lexicon.density(fold(t, folds), automaton) for t in texts],
                            dtype=float)

    return density


def is_toxic(df: DataFrame, lexicon: Lexicon, text: str = "text") -> Column:
    """Whether a text scores 0.5 or more: its density reaches the pivot."""
    return density_udf(df, lexicon)(F.col(text)) >= F.lit(lexicon.pivot)


def learn_and_score(docs: DataFrame, labels: DataFrame, modulus: int = 5,
                    remainder: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted and density for all of ``docs``."""
    lexicon = fit(training_rows(docs, labels, "toxic", modulus, remainder, SAMPLE))
    density = density_udf(docs, lexicon)("text")
    found = docs.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"),
                        density.alias("density"))
    score = F.col("density") / (F.col("density") + F.lit(lexicon.pivot))
    return (found.withColumn("score", score)
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
