"""Approximate nearest neighbours by an adaptive dimension scan.

All vectors are multiplied by one random rotation, so that any first columns
of a difference are a random sample of its squared length. An inverted-file
index (about ``4 * sqrt(rows)`` centroids by k-means on a bounded sample) names the
lists to probe for a query, nearest first. Inside a probed list the columns are
read block by block; after d of D columns a candidate is abandoned when its
partial squared distance is too large for its distance to be under the k-th
best so far, by the test

    partial * D / d  >  best_k * (1 + epsilon / sqrt(d)) ** 2

(at d = D the comparison is exact). Survivors get their exact Euclidean
distance in double precision from the original vectors.

All rows are indexed: dealt by list, a list of more than ``PART_VALUES`` components
over as many parts as it fills, and written. Queries are asked in blocks of about
``BLOCK``, whose vectors and lists every task holds; rows stay where they are.
A block takes two passes over the index: each query's nearest lists (``FIRST``
of them) give its k-th best so far, then the rest of its probed lists are
scanned against that. A task scans a list for all the block's queries that
probe it at once, and answers with its own k best for each; the k best of those
are kept.

Cases: vectors that are null, all zero, or hold a null, NaN or infinity take
no part, nor do rows without an id or vectors of another length than the
commonest (the longer of two equally common). Every row is a candidate: rows
equal in id and vector are scanned once and returned as often as they occur. A
query never meets rows of its own id; of several query rows with one id the
least vector is asked. Ties go to the smaller id. Components are scaled by a
power of two, so that squares of large or small ones neither overflow nor
vanish. A table with fewer candidates than k gives them all: queries that find
fewer in their probed lists are asked again in all lists. An empty table gives
an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.text import staged

SAMPLE = 20_000
PER_LIST = 16  # sampled vectors for each centroid, at least
PROBED = 0.55
FIRST = 0.04
PART_VALUES = 1 << 20  # components in a part of a list
BLOCK = 16_384
COLUMNS = 16
EPSILON = 2.1
SEED = 6
#: Components that a task compares at a time, and pairs it keeps, about.
VALUES = 4_000_000


def usable(vector: str) -> Column:
    """A vector without null, NaN or infinite components, not all zero."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2.0 * a @ b.T + (b * b).sum(1)[None, :], 0.0)


def centroids(sample: np.ndarray, lists: int, steps: int = 8, seed: int = SEED) -> np.ndarray:
    """k-means from ``lists`` different rows of the sample, taken at random."""
    rows = np.unique(sample, axis=0)
    k = min(lists, len(rows))
    found = rows[np.sort(np.random.default_rng(seed).choice(len(rows), k, replace=False))].copy()
    for _ in range(steps):
        nearest = squared_distances(rows, found).argmin(1)
        times = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, rows)
        found[times > 0] = sums[times > 0] / times[times > 0, None]
    return found


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows; squares are taken of differences scaled by
    a power of two, which changes no digit."""
    off = a - b
    _, power = np.frexp(np.abs(off).max(1, initial=0.0))
    return np.ldexp(np.sqrt(np.square(np.ldexp(off, -power[:, None])).sum(1)), power)


class Scanner:
    """Scans candidates for a block of queries, list by list, and keeps the
    ``k`` best for each query."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, limits: np.ndarray,
                 turn: np.ndarray, scale: int, k: int, columns: int = COLUMNS,
                 epsilon: float = EPSILON):
        self.queries, self.query_ids, self.k, self.scale = queries, query_ids, k, scale
        self.turn, dims = turn, queries.shape[1]
        self.rotated = np.ldexp(queries, -scale) @ turn
        # a limit is a distance; a hair more, for what rounding does to sums
        self.limits = np.square(np.ldexp(limits, -scale)) * (1 + 1e-9) + 1e-300
        self.blocks = [slice(d, min(d + columns, dims)) for d in range(0, dims, columns)]
        self.tests = [(dims / b.stop) / (1 + epsilon / math.sqrt(b.stop)) ** 2 if b.stop < dims
                      else 1.0 - 1e-9 for b in self.blocks]
        self.found: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0
        self.looked_at = 0  # blocks of columns read, over all candidates

    def scan(self, asking: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
             times: np.ndarray) -> None:
        """One list's candidates for the queries (by number) that probe it."""
        rotated = np.ldexp(vectors, -self.scale) @ self.turn
        step = max(1, VALUES // max(1, vectors.size))
        for low in range(0, len(asking), step):
            q = asking[low:low + step]
            first = self.blocks[0]
            partial = squared_distances(self.rotated[q][:, first], rotated[:, first])
            alive = partial * self.tests[0] <= self.limits[q][:, None]
            alive &= self.query_ids[q][:, None] != ids[None, :]
            at, row = np.nonzero(alive)
            partial, at = partial[at, row], q[at]
            self.looked_at += alive.size
            for block, test in zip(self.blocks[1:], self.tests[1:], strict=True):
                off = rotated[row, block] - self.rotated[at, block]
                partial = partial + np.einsum("ij,ij->i", off, off)
                stays = partial * test <= self.limits[at]
                self.looked_at += len(at)
                at, row, partial = at[stays], row[stays], partial[stays]
            if len(at):
                self.found.append((at, distances(vectors[row], self.queries[at]), ids[row],
                                   times[row]))
                self.waiting += len(at)
                if self.waiting > VALUES:
                    self.reduce()

    def reduce(self) -> tuple[np.ndarray, ...]:
        """The k best of what was found: query numbers, distances, ids, times."""
        if not self.found:
            return (np.empty(0, dtype=np.int64),) * 4
        q, score, ids, times = (np.concatenate(c) for c in zip(*self.found, strict=True))
        order = np.lexsort((ids, score, q))
        q, score, ids, times = q[order], score[order], ids[order], times[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        kept = place < self.k
        self.found = [(q[kept], score[kept], ids[kept], times[kept])]
        self.waiting = int(kept.sum())
        return self.found[0]


def _matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.empty((0, dims))


def _first(df: DataFrame, k: int, *order) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(*order)
    return df.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


class _Index:
    """The indexed rows (list, vec_id, v, times) and what a search needs of them."""

    def __init__(self, rows: DataFrame, n: int, dims: int, scale: int, sample: int):
        spark = rows.sparkSession
        self.dims, self.scale, self.turn = dims, scale, rotation(dims)
        unit = F.pmod(F.xxhash64(F.lit("sample"), "vec_id", "v"), F.lit(1_000_003)) / 1_000_003
        taken = rows.filter(unit < sample / n).select("v").toPandas()["v"]  # bounded
        if len(taken) == 0:
            taken = rows.select("v").limit(1).toPandas()["v"]
        taken = np.unique(np.ldexp(_matrix(taken, dims), -scale), axis=0)
        lists = min(round(4 * math.sqrt(n)), max(len(taken) // PER_LIST, min(len(taken), 128)))
        self.centres = centroids(taken, max(1, lists))
        shared = spark.sparkContext.broadcast(self.centres)

        @F.pandas_udf("int")
        def assigned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for vectors in batches:
                scaled = np.ldexp(_matrix(vectors, dims), -scale)
                yield pd.Series(squared_distances(scaled, shared.value).argmin(1), dtype="int32")

        listed = staged(rows.withColumn("list", assigned("v")), "listed-vectors")
        sizes = listed.groupBy("list").count().collect()  # a row for each list
        full = max(256, PART_VALUES // dims)
        parts = [(r["list"], -(-r["count"] // full)) for r in sizes]
        small = F.broadcast(spark.createDataFrame(parts, "list int, parts int"))
        part = F.pmod(F.xxhash64("vec_id", "v"), F.col("parts").cast("long"))
        width = max(1, -(-n // full))
        self.rows = staged(listed.join(small, "list").repartition(width, "list", part)
                           .sortWithinPartitions("list").drop("parts"), "vector-lists")

    def probes(self, queries: np.ndarray) -> np.ndarray:
        """Every list, nearest first, for each query."""
        scaled = np.ldexp(queries, -self.scale)
        return squared_distances(scaled, self.centres).argsort(1, kind="stable")

    def scan(self, ids: np.ndarray, queries: np.ndarray, limits: np.ndarray, probed: np.ndarray,
             k: int) -> DataFrame:
        """query_id, vec_id, score, times: each task's k best for each query
        in the lists ``probed`` (a row of list numbers for each query)."""
        numbers = np.repeat(np.arange(len(ids)), probed.shape[1])
        order = np.argsort(probed.ravel(), kind="stable")
        bounds = np.searchsorted(probed.ravel()[order], np.arange(len(self.centres) + 1))
        shared = self.rows.sparkSession.sparkContext.broadcast(
            (ids, queries, limits, self.turn, numbers[order], bounds))
        dims, scale = self.dims, self.scale

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, queries, limits, turn, asking, bounds = shared.value
            scanner = Scanner(queries, ids, limits, turn, scale, k)
            for batch in batches:
                for number, rows in batch.groupby("list"):
                    mine = asking[bounds[number]:bounds[number + 1]]
                    if len(mine):
                        scanner.scan(mine, rows["vec_id"].to_numpy(), _matrix(rows["v"], dims),
                                     rows["times"].to_numpy())
            q, score, found, times = scanner.reduce()
            yield pd.DataFrame({"query_id": ids[q], "vec_id": found, "score": score, "times": times})

        return self.rows.select("list", "vec_id", "v", "times").mapInPandas(
            search, "query_id long, vec_id long, score double, times long")


def nearest(df: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id",
            embedding: str = "embedding", sample: int = SAMPLE, probed: float = PROBED,
            block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score (the distance) of the ``k`` nearest
    found to each row of ``df`` that ``is_query`` (an expression over the
    column vec_id) selects.

    What reaches the driver: about ``sample`` vectors for the centroids, a
    count for each list and vector length, and about ``block`` queries at a time."""
    spark = df.sparkSession
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(
        F.col(embedding).cast("array<double>"), lambda x: x + 0.0).alias("v"))  # -0.0 is 0.0
    rows = rows.filter(F.col("vec_id").isNotNull() & usable("v"))
    # equal rows become one before anything is dealt, most of them before the shuffle
    rows = staged(rows.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("times")), "vectors")
    lengths = rows.groupBy(F.size("v").alias("dims")).agg(
        F.sum("times").alias("n"), F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.when(is_query, F.col("vec_id"))).alias("queries"),
        F.max(F.array_max(F.transform("v", F.abs))).alias("most")).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], schema)
    dims, _, n, asked, most = max(lengths, key=lambda r: (r["n"], r["dims"]))
    rows = rows.filter(F.size("v") == dims)
    index = _Index(rows, n, dims, math.frexp(most)[1] + 1, sample)
    blocks = max(1, -(-asked // block))
    asking = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    best = spark.createDataFrame([], "query_id long, vec_id long, score double, times long")
    for number in range(blocks):
        queries = asking.filter(F.col("block") == number).orderBy("vec_id").toPandas()  # a block
        if len(queries):
            best = best.unionByName(_ask(index, queries["vec_id"].to_numpy(),
                                         _matrix(queries["v"], dims), k, probed))
    # equal rows again, as many as there is place for
    each = best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("times", F.lit(k)))))
    return _first(each, k, "score", "vec_id", "copy").select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _ask(index: _Index, ids: np.ndarray, queries: np.ndarray, k: int, probed: float) -> DataFrame:
    """The k best (different) rows for a block of queries."""
    order = index.probes(queries)
    lists = order.shape[1]
    first, last = max(1, math.ceil(FIRST * lists)), max(1, math.ceil(probed * lists))
    unlimited = np.full(len(ids), np.inf)
    near = staged(_first(index.scan(ids, queries, unlimited, order[:, :first], k), k, "score",
                         "vec_id").drop("rank"), "nearest-lists")
    limits = _kth(near, ids, k)
    if first < last:
        rest = index.scan(ids, queries, limits, order[:, first:last], k)
        near = staged(_first(near.unionByName(rest), k, "score", "vec_id").drop("rank"),
                      "probed-lists")
        limits = _kth(near, ids, k)
    short = np.flatnonzero(np.isinf(limits))
    if len(short) and last < lists:  # too few found: all further lists
        more = index.scan(ids[short], queries[short], limits[short], order[short, last:], k)
        near = _first(near.unionByName(more), k, "score", "vec_id").drop("rank")
    return near


def _kth(found: DataFrame, ids: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th distance, copies counted; infinite while there are fewer."""
    rows = found.groupBy("query_id").agg(F.sum("times").alias("n"), F.max("score").alias("far"))
    known = {r["query_id"]: r["far"] for r in rows.filter(F.col("n") >= k).toLocalIterator()}
    return np.array([known.get(i, np.inf) for i in ids.tolist()], dtype=np.float64)
