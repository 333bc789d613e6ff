import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import fingerprint as P
from keelson.llm.text import word_hashes
from tests.conftest import SF_CHECK
from tests.llm.helpers import awkward, empty


def exact(text, width=5):
    words = text.lower().split()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows):
    """(doc_id, edited text, next text) in ascending order of id, nulls last."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        out.append((doc, text, (text[:-half] if half else text) + after[:half], after))
    return out


def test_edited_texts_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text")
    wanted = {d: x for d, *x in brute([tuple(r) for r in docs.collect()])}
    maker = P.Sketcher()
    rows = P.edited_fingerprints(docs.repartition(7)).collect()
    assert len(rows) == len(wanted)
    off = []
    for r in rows:
        text, edited, after = wanted[r["doc_id"]]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == P.to_text(maker.sketch(text))
        assert r["edited_fingerprint"] == P.to_text(maker.sketch(edited))
        a, b, c = exact(text), exact(edited), exact(after)
        off.append(abs(r["near_edited"] - len(a & b) / len(a | b)))
        off.append(abs(r["near_next"] - len(a & c) / len(a | c)))
    assert max(off) < 0.2 and np.mean(off) < 0.03


def test_sketch_is_the_bottom_of_all_hashes():
    maker = P.Sketcher()
    for text in ("", None, "one", "a b c d e f", "x y " * 3000,
                 " ".join(map(str, range(30_000))), "q " * 2000 + " ".join(map(str, range(200)))):
        every = np.unique(P.shingle_hashes(word_hashes(text or ""), 5))
        assert np.array_equal(maker.sketch(text), every[:P.K])
        assert np.array_equal(P.from_text(P.to_text(maker.sketch(text))), every[:P.K])


def test_merging_and_estimates():
    maker = P.Sketcher()
    words = [str(i) for i in range(6000)]
    a, b = maker.sketch(" ".join(words[:4000])), maker.sketch(" ".join(words[2000:]))
    whole = maker.sketch(" ".join(words[:4000] + ["|"] * 0))
    assert np.array_equal(P.merge(a, a), whole)
    assert P.distinct(P.merge(a, b)) == pytest.approx(5990, rel=0.3)
    assert P.resemblance(a, b) == pytest.approx(1 / 3, abs=0.15)
    assert P.containment(a, b) == pytest.approx(0.5, abs=0.2)
    assert P.distinct(maker.sketch("a b c d e f")) == 2
    nothing = maker.sketch("")
    assert P.resemblance(nothing, nothing) == 1.0 and P.resemblance(a, nothing) == 0.0


def test_awkward_rows(spark):
    rows = P.edited_fingerprints(awkward(spark)).collect()
    assert len(rows) == 9 and sum(r["doc_id"] is None for r in rows) == 2
    one = [r for r in rows if r["doc_id"] == 1]
    assert one[0]["fingerprint"] == one[1]["fingerprint"]
    assert 1.0 in {r["near_next"] for r in one}  # the first is followed by its copy
    assert P.edited_fingerprints(empty(spark)).count() == 0
    alone = P.edited_fingerprints(spark.createDataFrame([(7, "abcd")], "doc_id long, text string"))
    row = alone.first()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1.0
    assert P.fingerprints(awkward(spark), name="score").columns == awkward(spark).columns


@pytest.mark.parametrize("slice_bytes", [10**9, 400, 60])
def test_every_slice_meets_the_next(spark, slice_bytes):
    rows = [(i, f"text {i} " + "abc " * (i % 5)) for i in range(-50, 150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = P.edited_fingerprints(df, slice_bytes=slice_bytes).collect()
    assert {r["doc_id"]: r["edited_sha256"] for r in got} == {
        d: hashlib.sha256(e.encode()).hexdigest() for d, _, e, _ in brute(rows)}


@pytest.mark.parametrize("hot", [None, 40])
def test_a_third_of_the_ids_alike_spreads_over_slices(spark, hot):
    rows = [(hot if i % 3 == 0 else i, f"text {i * 7919 % 1000} of {i}") for i in range(900)]
    rows += [(hot, "the same"), (hot, "the same"), (7, "the same")] * 20  # equal rows, in one slice
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    ties = {r["text"]: r["t"] for r in df.selectExpr("text", "xxhash64(text) t").collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, ties[r[1]]))
    wanted = []
    for i, (doc, text) in enumerate(ordered):
        after, half = ordered[(i + 1) % len(ordered)][1], len(text) // 2
        wanted.append((doc, hashlib.sha256(((text[:-half] if half else text) + after[:half])
                                           .encode()).hexdigest()))
    out = P.edited_fingerprints(df, slice_bytes=1000)
    assert sorted(((r["doc_id"], r["edited_sha256"]) for r in out.collect()), key=str) == \
        sorted(wanted, key=str)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 2 * np.median(sizes) + 60


def test_word_hashes_depend_on_the_word_alone():
    words = ["a", "b", "ab", "ba", "abc", "Ünï", "x" * 300, "", "1", "a\x00", "a\x00\x00"]
    text = " ".join(words) + "\u3000tab\tnew\nline"
    found = word_hashes(text)
    assert len(found) == len(text.split()) == len(set(found.tolist()))
    for word, value in zip(text.split(), found.tolist(), strict=True):
        assert word_hashes(f"  {word.upper()} ").tolist() == [value] or word != word.upper().lower()
    assert np.array_equal(word_hashes(text * 50, block=64), word_hashes(text * 50))
    assert len(word_hashes("")) == len(word_hashes(" \n")) == 0
