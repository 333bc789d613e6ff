import math
import random
import re
from collections import Counter

import pytest

from keelson.llm import lexical as X
from keelson.llm import queries as Q
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward, empty

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k=X.K):
    """(item, rank, doc_id, score) by scoring every document for every item."""
    texts = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    texts = [(d, c, sum(c.values())) for d, c in texts if c]
    n_all, length = len(texts), sum(n for *_, n in texts)
    df = Counter(t for _, c, _ in texts for t in c)
    out = []
    for item, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for d, c, n in texts:
            m = 75 + 25 * n * n_all // length
            score = sum(times * math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                        for t, times in asked.items() if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table_against_brute_force(spark):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/{t}.parquet").select(
        c, "text").collect()] for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    found = Q.op11_lexical_search(spark, SF_SMALL)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint",
                                  "score": "bigint"}
    assert rows(found) == brute(docs, items)


def made(spark, rng, n, words, repeats=1):
    docs = [(i // repeats, " ".join(rng.choices(words, k=rng.randrange(0, 30)))) for i in range(n)]
    return docs, spark.createDataFrame(docs, "doc_id long, text string")


def test_ties_blocks_and_query_blocks(spark, monkeypatch):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)] + ["Ä", "ß1", "E"]
    docs, df = made(spark, rng, 400, words, repeats=2)
    docs += [(1000 + i, "w1 w2 same text") for i in range(60)]  # more ties than places
    df = df.unionByName(spark.createDataFrame(docs[-60:], "doc_id long, text string"))
    items = [(i, " ".join(rng.choices(words + ["absent"], k=6))) for i in range(15)]
    items += [(90, "same same w1"), (91, "absent"), (92, ""), (93, None), (94, "SAME e É"),
              (90, "same same w1")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    wanted = brute(docs, items)
    assert rows(X.search(df.repartition(3), asked)) == wanted
    monkeypatch.setattr(X, "BLOCK_POSTINGS", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        assert rows(X.search(df.repartition(2), asked, query_bytes=60)) == wanted
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_reading_stops_early():
    """A document far ahead ends the reading; ties at the k-th place don't."""
    import numpy as np
    n = 20_000
    doc = np.concatenate([np.arange(n), np.arange(n)])
    term = np.repeat([0, 1], n)
    impact = np.concatenate([np.arange(n, 0, -1), np.arange(n, 0, -1)]) + 1
    lists = X.ImpactLists(doc, term, impact, n, 2)
    top = X.Top(5)
    met = X.best_positions(lists, [(0, 1), (1, 2)], np.arange(n), np.zeros(n, bool), top)
    assert met < 100 and top.doc.tolist() == [0, 1, 2, 3, 4]
    level = X.ImpactLists(doc, term, np.full(2 * n, 3), n, 2)
    top = X.Top(5)
    ids = np.arange(n)[::-1].copy()
    assert X.best_positions(level, [(0, 1), (1, 2)], ids, np.zeros(n, bool), top) == n
    assert top.doc.tolist() == [0, 1, 2, 3, 4]


def test_awkward_rows(spark):
    items = [(1, "the tide"), (2, "漢字 1234 ämläut"), (3, None), (None, "birds sand")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    assert rows(X.search(awkward(spark), asked)) == brute(docs, items)
    assert X.search(empty(spark), asked).count() == 0
    nothing = spark.createDataFrame([], "item_id long, text string, rank long")
    assert X.search(awkward(spark), nothing).collect() == []
    clash = awkward(spark).selectExpr("*", "score as n", "lang as terms", "lang as item_id")
    assert rows(X.search(clash, asked)) == brute(docs, items)


@pytest.mark.parametrize("text", ["A-b_C  9z", "naïve Straße x", "", "!?", "\x7f\x00ok"])
def test_terms(text):
    assert [t.decode() for t in X.terms(text)] == TERM.findall(text.translate(LOWER))
