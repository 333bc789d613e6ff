import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import ann as A
from tests.conftest import SF_CHECK


def brute(ids, vectors, queries, k):
    out = {}
    for q in queries:
        at = np.flatnonzero(ids == q)[0]
        d = np.sqrt(((vectors - vectors[at]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    rows = df.collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    wanted = brute(ids, vectors, [i for i in ids if i % 20 == 0], 10)
    found = {}
    for r in A.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(found) == set(wanted)
    hits = 0
    for q, mine in found.items():
        assert len(mine) == 10 and mine == sorted(mine, key=lambda x: (x[1], x[0]))
        hits += len({v for v, _ in mine} & {v for v, _ in wanted[q]})
        at = {int(i): n for n, i in enumerate(ids)}
        for v, score in mine:
            assert score == pytest.approx(np.sqrt(((vectors[at[v]] - vectors[at[q]]) ** 2).sum()), abs=1e-12)
    assert hits / (10 * len(wanted)) >= 0.9


@pytest.mark.parametrize("n", [300, 6000])
def test_recall_at_two_sizes(spark, n):
    """Vectors without clusters, as the given ones are."""
    rng = np.random.default_rng(n)
    vectors = rng.standard_normal((n, 48)).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)],
                               "vec_id long, embedding array<double>")
    wanted = brute(np.arange(n), vectors, range(0, n, n // 50), 10)
    rows = A.nearest(df, F.col("vec_id") % (n // 50) == 0).collect()
    hits = sum(any(r["vec_id"] == v for v, _ in wanted[r["query_id"]]) for r in rows)
    assert len(rows) == 10 * len(wanted) and hits / len(rows) >= 0.9


def test_scan_abandons_only_what_is_far():
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((3000, 32)) + 4 * rng.integers(0, 4, (3000, 1))
    ids = np.arange(3000) * 3
    wanted = brute(ids, vectors, ids[::100], 10)
    limits = np.array([wanted[q][-1][1] for q in ids[::100]])
    scanner = A.Scanner(vectors[::100], ids[::100], limits, A.rotation(32), 5, 10, columns=8)
    for low in range(0, 3000, 700):
        part = slice(low, low + 700)
        scanner.scan(np.arange(30), ids[part], vectors[part], np.ones(len(ids[part])))
    q, score, found, _ = scanner.reduce()
    hits = sum(any(v == w for w, _ in wanted[ids[::100][i]]) for i, v in zip(q, found))
    assert hits / 300 > 0.97 and np.all(np.diff(q) >= 0)
    assert scanner.looked_at < 0.5 * 4 * 30 * 3000  # of four blocks of columns


def test_large_and_small_components(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 6))
    for factor in (1e200, 1e-200, 1.0):
        vectors = base * factor
        out = A.nearest(spark.createDataFrame(
            [(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>"),
            F.col("vec_id") == 0).orderBy("rank").collect()
        wanted = brute(np.arange(40), base, [0], 10)[0]
        assert [r["vec_id"] for r in out] == [i for i, _ in wanted]
        assert [r["score"] / factor for r in out] == pytest.approx([d for _, d in wanted])
    mixed = spark.createDataFrame([(0, [1e200, 0.0]), (1, [1e200, 3e-200]), (2, [1e200, 1.0]),
                                   (3, [-1e308, 0.0])], "vec_id long, embedding array<double>")
    got = A.nearest(mixed, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, 3e-200), (2, 1.0), (3, 1e308)]


def test_rotation_keeps_distances():
    turn = A.rotation(24)
    assert np.allclose(turn @ turn.T, np.eye(24))


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "x"), (0, [1.0, 0.0], "x"), (100, [0.0, 1.0], None), (1, [1.0, 0.5], None),
            (2, [1.0, 0.5], None), (2, [1.0, 0.5], None), (3, None, None), (4, [0.0, 0.0], None),
            (5, [nan, 1.0], None), (6, [inf, 1.0], None), (7, [None, 1.0], None), (8, [1.0], None),
            (None, [1.0, 0.0], None), (9, [], None), (200, None, None), (300, [1.0, -inf], None)]
    out = A.nearest(frame(spark, rows), F.col("vec_id") % 100 == 0, k=10, probed=1.0)
    found = {}
    for r in out.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    # ties: smaller id; a repeated row is as many candidates
    assert found == {0: [(1, 1), (2, 2), (3, 2), (4, 100)], 100: [(1, 1), (2, 2), (3, 2), (4, 0), (5, 0)]}


def test_empty_and_single(spark):
    every = F.col("vec_id") >= 0
    assert A.nearest(frame(spark, []), every).count() == 0
    assert A.nearest(frame(spark, [(0, [1.0, 2.0], None)]), every).count() == 0
    assert A.nearest(frame(spark, [(1, [0.0], None)]), every).count() == 0


def test_one_vector_in_a_third_of_the_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0] * 8 if i % 3 == 0 else rng.standard_normal(8).tolist(), None) for i in range(900)]
    out = A.nearest(frame(spark, rows), F.col("vec_id") % 300 == 0).orderBy("query_id", "rank").collect()
    first = [r["vec_id"] for r in out if r["query_id"] == 0]
    assert first == [3 * i for i in range(1, 11)]


def test_few_candidates_are_all_found(spark):
    rng = np.random.default_rng(8)
    for n in (9, 12):  # each vector is a list of its own
        rows = [(i, rng.standard_normal(4).tolist(), None) for i in range(n)]
        vectors = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
        out = A.nearest(frame(spark, rows), F.col("vec_id") == 0).orderBy("rank").collect()
        wanted = brute(np.arange(n), vectors, [0], 10)[0]
        assert [r["vec_id"] for r in out] == [i for i, _ in wanted] and len(out) == min(10, n - 1)


def test_awkward_rows_as_registered(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0], "x"), (0, [1.0, 0.0], "x"), (100, [0.0, 1.0], None), (1, [1.0, 0.5], None),
            (2, [1.0, 0.5], None), (2, [1.0, 0.5], None), (3, None, None), (5, [nan, 1.0], None)]
    out = A.nearest(frame(spark, rows), F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in out] == [
        (0, 1), (0, 2), (0, 2), (0, 100), (100, 1), (100, 2), (100, 2), (100, 0), (100, 0)]


def test_copies_are_scanned_once_and_returned_each(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(4).tolist(), None) for i in range(60)]
    rows += [(7, rows[7][1], None)] * 30 + [(8, [0.0, 1.0, 1.0, 1.0], None),
                                          (8, [-0.0, 1.0, 1.0, 1.0], None)]
    sizes, matrix = [], A._matrix
    monkeypatch.setattr(A, "_matrix", lambda v, dims: sizes.append(len(v)) or matrix(v, dims))
    out = A.nearest(frame(spark, rows), F.col("vec_id") % 9 == 0)
    assert sizes[0] == 61  # the sample takes all: 60 and the second vector of id 8, once
    vectors = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    wanted = brute(np.array([r[0] for r in rows]), vectors, range(0, 60, 9), 10)
    got = {}
    for r in out.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {q: [v for v, _ in found] for q, found in wanted.items()}


def test_queries_in_blocks(spark):
    df = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    asked = F.col("vec_id") % 20 == 0
    assert sorted(A.nearest(df, asked, block=7).collect()) == sorted(A.nearest(df, asked).collect())
