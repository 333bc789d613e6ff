"""Quality and toxicity: held-out accuracy, method parts, awkward cases."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import quality as Q
from keelson.llm import toxicity as T
from keelson.llm.text import training_rows
from tests.conftest import SF_CHECK
from tests.llm.helpers import awkward, empty, labels


def read(spark, name):
    return spark.read.parquet(f"{SF_CHECK}/{name}.parquet")


def auc(rows):
    rows = sorted(rows)
    ones = sum(y for _, y in rows)
    rank = sum(i for i, (_, y) in enumerate(rows) if y) - ones * (ones - 1) / 2
    return rank / (ones * (len(rows) - ones))


def test_quality_on_held_out_documents(spark):
    out = Q.learn_and_score(read(spark, "documents"), read(spark, "labels"))
    rows = out.join(read(spark, "labels"), "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [(r["score"], r["quality"]) for r in rows if r["held_out"]]
    assert auc(held) > 0.98
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.95
    assert out.count() == read(spark, "documents").count()


def test_quality_does_not_see_labels_of_held_out_rows(spark):
    docs, marks = read(spark, "documents").limit(200), read(spark, "labels")
    other = marks.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1,
                                               1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r["doc_id"], r["score"]) for r in Q.learn_and_score(docs, m).collect())
            for m in (marks, other))
    assert a == b


def test_probabilities_are_not_too_sure(spark):
    """On labels of which a fifth are wrong, scores of held-out rows are about
    right: Platt's scaling is fitted on rows a learner wasn't taught."""
    rng = random.Random(5)
    rows, marks = [], []
    for i in range(1500):
        y = rng.random() < 0.5
        own = rng.choices("amber birch cedar delta ember".split() if y
                          else "flint grove heath islet jetty".split(), k=4)
        words = own + [f"noise{rng.randrange(4000)}" for _ in range(30)]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        marks.append((i, int(y != (rng.random() < 0.2)), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = Q.learn_and_score(docs, labels(spark, marks)).filter("held_out").collect()
    y = {d: q for d, q, _ in marks}
    loss = -np.mean([math.log(max(1e-9, r["score"] if y[r["doc_id"]] else 1 - r["score"]))
                     for r in out])
    assert loss < 0.62  # 0.50 at best; 0.69 without any knowledge
    sure = [r for r in out if not 0.05 < r["score"] < 0.95]
    assert len(sure) < 0.1 * len(out)


def test_ftrl_learns_a_separable_rule():
    learner, rng = Q.Ftrl(bits=8), random.Random(0)
    rows = [(np.array(rng.sample(range(200), 5)), np.ones(5)) for _ in range(400)]
    for _ in range(5):
        for at, values in rows:
            learner.learn(at, values, int(at.min() < 30))
    model = Q.Model(learner.weights(slice(None)), 8)
    assert np.mean([(model.score(x) >= 0.5) == (x[0].min() < 30) for x in rows]) > 0.9


def test_features_are_normalised_and_whole():
    make = Q.Featurizer()
    at, values = make("One two three. " * 50_000)
    assert float(values @ values) == pytest.approx(2.0)
    assert len(make("")[0]) == len(make(None)[0]) == len(make(" \n")[0]) == 0
    assert len(at) == len(values)


@pytest.mark.parametrize("score", [Q.learn_and_score, T.learn_and_score])
def test_awkward_rows(spark, score):
    marks = labels(spark, [(1, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (99, 0, 1), (1, 1, 0)])
    rows = score(awkward(spark), marks).collect()
    assert len(rows) == 9 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] for r in rows if r["doc_id"] is None)
    same = [r["score"] for r in rows if r["doc_id"] == 1]
    assert same[0] == same[1]
    assert len(score(awkward(spark), labels(spark)).collect()) == 9
    assert score(empty(spark), marks).count() == 0


def toxic_corpus(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("aeioumnrst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    endings = ["a", "ix", "uve", "orn", "eld", "ist", "oc", "ywa"]
    docs, marks = [], []
    for i in range(1200):
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        toxic = i % 5 == 0
        for _ in range(rng.randint(2, 5) if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(
                ["skunkbag", "dolthead", "grub" + rng.choice(endings)])
        if not toxic and i % 7 == 0:  # harmless in this phrase
            text[5:7] = ["friendly", "skunkbag"]
        docs.append((i, " ".join(text), "xx", "s", 0, 0.0))
        marks.append((i, 1, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, "
                                        "n_chars long, score double"), labels(spark, marks))


def test_toxicity_learns_words_stems_and_exceptions(spark):
    docs, marks = toxic_corpus(spark)
    lexicon = T.fit(training_rows(docs, marks, "toxic", 5, 0, T.SAMPLE))
    assert " dolthead " in lexicon.terms and " skunkbag " in lexicon.terms
    assert " grub" in lexicon.terms
    assert "friendly skunkbag" in lexicon.exceptions
    out = T.learn_and_score(docs, marks).join(marks, "doc_id").collect()
    held = [(r["score"], r["toxic"]) for r in out if r["held_out"]]
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.97

    folds, found = T.Folds(), lexicon.automaton()
    score = lambda text: lexicon.score(lexicon.density(T.fold(text, folds), found))
    assert score("you d0lthe4d, what a DOLTHEÁD") > 0.5
    assert score("уou dоlthеad") > 0.3  # Cyrillic letters
    assert score("a grubling and grubzzz here") > 0.5
    assert score("the friendly skunkbag sleeps") == 0
    assert score("doltheads") == score("xdolthead") == 0  # whole words only
    short, long = score("dolthead " + "tide " * 10), score("dolthead " + "tide " * 3000)
    assert short > long > 0  # by length


def test_toxicity_on_the_given_labels(spark):
    out = T.learn_and_score(read(spark, "documents"), read(spark, "labels"))
    rows = out.join(read(spark, "labels"), "doc_id").collect()
    held = [(r["score"], r["toxic"]) for r in rows if r["held_out"]]
    clean = [s for s, y in held if not y]
    assert np.mean([s < 0.5 for s in clean]) == 1.0  # clean ones are left alone
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.9


def test_copies_do_not_make_lexicon_words(spark):
    docs, marks = toxic_corpus(spark)
    copy = "quabble zunder vexil " * 3 + "dolthead tail"
    more = spark.createDataFrame([(5000 + i, copy, "xx", "s", 0, 0.0) for i in range(60)], docs.schema)
    lexicon = T.fit(training_rows(docs.union(more), marks.union(
        labels(spark, [(5000 + i, 1, 1) for i in range(60)])), "toxic", 5, 0, T.SAMPLE))
    assert " zunder " not in lexicon.terms and " dolthead " in lexicon.terms


def test_training_rows_are_bounded_and_not_held_out(spark):
    docs, marks = toxic_corpus(spark)
    marks = marks.union(marks)
    rows = training_rows(docs.union(docs.limit(100)), marks, "toxic", 5, 0, 150).collect()
    assert len({(r["doc_id"], r["y"]) for r in rows}) == len(rows)
    for y in (0, 1):
        assert 100 < sum(r["y"] == y for r in rows) < 220
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0 for r in rows)


def test_best_pivot():
    assert T.best_pivot([]) == 1.0
    assert T.best_pivot([(0.0, 0), (0.0, 0), (4.0, 1), (5.0, 1)]) == pytest.approx(2.0)
    assert 1.0 < T.best_pivot([(0.0, 0), (1.0, 0), (3.0, 1), (5.0, 1)]) < 3.0


def naive_density(lexicon, text):
    """Every term at every word, without an automaton."""
    words = T.fold(text, T.Folds())
    spared = set()
    for i in range(len(words) - 1):
        if f"{words[i]} {words[i + 1]}" in lexicon.exceptions:
            spared |= {i, i + 1}
    total = 0.0
    for i, word in enumerate(words):
        if i not in spared:
            total += max([w for t, w in lexicon.terms.items()
                          if (t[1:-1] == word if t.endswith(" ") else word.startswith(t[1:]))],
                         default=0.0)
    return total / max(T.FLOOR, len(words)) if words else 0.0


def test_densities_against_a_naive_matcher(spark):
    docs, marks = toxic_corpus(spark)
    lexicon = T.fit(training_rows(docs, marks, "toxic", 5, 0, T.SAMPLE))
    assert lexicon.exceptions and any(not t.endswith(" ") for t in lexicon.terms)
    for r in docs.select("text", T.density_udf(docs, lexicon)("text").alias("d")).collect():
        assert r["d"] == pytest.approx(naive_density(lexicon, r["text"]))


def test_no_learned_term_is_cut_off(spark):
    """Thousands of neutral words that lean by chance push no rare toxic word out."""
    rng = random.Random(3)
    docs, marks = [], []
    neutral = [f"n{i:05d}" for i in range(6000)]
    for i in range(900):
        toxic = int(i % 3 == 0)
        text = rng.sample(neutral[:4500] if toxic else neutral, 60)
        if toxic and i % 30 == 0:
            text[3:3] = ["rarebad"]
        docs.append((i, " ".join(text), "", "", 0, 0.0))
        marks.append((i, 1, toxic))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, "
                                     "n_chars long, score double")
    lexicon = T.fit(training_rows(df, labels(spark, marks), "toxic", 5, 0, T.SAMPLE))
    assert " rarebad " in lexicon.terms


def test_ftrl_against_a_plain_learner():
    """The same learner, coordinate by coordinate in plain Python."""
    learner, rng = Q.Ftrl(bits=5), random.Random(2)
    alpha, beta, l1, l2 = learner.alpha, learner.beta, learner.l1, learner.l2
    z, n = [0.0] * 33, [0.0] * 33  # the last is the intercept

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(200):
        at = sorted(rng.sample(range(32), 4))
        values = [rng.uniform(0.1, 1.0) for _ in at]
        y = int(at[0] < 6)
        p = 1 / (1 + math.exp(-sum(weight(i) * v for i, v in zip([*at, 32], [*values, 1.0]))))
        for i, v in zip([*at, 32], [*values, 1.0]):
            g = (p - y) * v
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
            w = weight(i)
            z[i] += g - sigma * w
            n[i] += g * g
        learner.learn(np.array(at), np.array(values), y)
    assert learner.weights(slice(None)) == pytest.approx([weight(i) for i in range(33)], abs=1e-9)
