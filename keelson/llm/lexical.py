"""Ranked lexical search by the Best Position Algorithm.

Terms are runs of ASCII letters and digits and all characters beyond ASCII,
A-Z lower-cased. A document's score for a query is the sum, over the query's
terms (repeats included), of an impact: ``w * ((10^9 tf) div (1000 tf + 12 m))``
with ``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` and
``m = 100 - 25 + (25 n N) div L``, all else in 64-bit integers; N, L and df
are counted over all documents.

``search`` reads the texts once: each document's occurrences of query terms
(``postings``) are written to the shared folder, far smaller than the texts.
N, L and df are sums over them. Then each task goes through its documents in
blocks of bounded size. In a block every term has an impact list, falling,
and a direct access by document. For each query the lists are read on from
their best positions; each document met is looked up in all lists of the
query, which marks its positions there as seen. A list's best position is the
end of the unbroken stretch of seen positions from its top; a document not
met scores at most the sum of the impacts at the best positions. Reading
stops when that sum is strictly below the k-th score so far (kept from block
to block), so ties are never lost. Each task emits k documents for each
query, and windows (first within salted parts) leave k of all.

Queries are dealt into blocks of ``QUERY_BYTES`` of text about, each of which
the tasks hold; a documents' pass is made for each. No posting list leaves
its task, so a frequent term or a hot source makes no large group.

Cases: a null or empty text, or one without a term, matches nothing and
counts nowhere; long texts are read whole; equal scores go by ascending id
(a null id last), repeated rows are documents of their own; a query without
terms, with null text or null id: no rows for the former two, a null
``item_id`` in the result for the latter, repeated queries each get their
rows; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.text import staged

K = 20
QUERY_BYTES = 8_000_000
#: Postings of a block of documents; one document may exceed it.
BLOCK_POSTINGS = 4_000_000
STEP = 64  # positions read of each list in the first round; doubled each round
SALTS = 64

#: A-Z lower-cased; what belongs to no term becomes a space.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in UTF-8."""
    return text.encode("utf-8").translate(_TERM_BYTES).split() if text else []


def postings(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """doc_id, n (all terms of the text), terms and tfs (those of the
    vocabulary, by number) of each document with a term."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, numbers, counts, ends = [], [], [], [], [0]
            for id_, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                  strict=True):
                found = terms(value)
                if not found:
                    continue
                held = Counter(map(vocabulary.get, found))
                held.pop(None, None)
                ids.append(id_)
                sizes.append(len(found))
                numbers.extend(held.keys())
                counts.extend(held.values())
                ends.append(len(numbers))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").alias("text")).mapInArrow(
        scan, "doc_id long, n long, terms array<int>, tfs array<long>")


class ImpactLists:
    """The falling impact list of every term in a block of documents, and
    direct access to a document's position in it."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int,
                 n_terms: int):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact, term = doc[order], impact[order], term[order]
        self.bounds = np.searchsorted(term, np.arange(n_terms + 1))
        by_doc = np.lexsort((self.doc, term))  # within a term: documents ascending
        self.sorted_doc = self.doc[by_doc]
        self.position = by_doc - self.bounds[term]  # its place in the term's list
        self.n_docs = n_docs

    def __getitem__(self, term: int) -> tuple[np.ndarray, ...]:
        """Documents and impacts by position; documents ascending and their positions."""
        part = slice(self.bounds[term], self.bounds[term + 1])
        return self.doc[part], self.impact[part], self.sorted_doc[part], self.position[part]


class Top:
    """The k best (score, document) so far: by falling score, rising id."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.empty(0, dtype=np.int64)
        self.doc = np.empty(0, dtype=np.int64)
        self.null = np.empty(0, dtype=bool)

    def floor(self) -> int:
        """The k-th score, 0 while there are fewer."""
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        good = (score > 0) & (score >= self.floor())
        score = np.concatenate([self.score, score[good]])
        doc, null = np.concatenate([self.doc, doc[good]]), np.concatenate([self.null, null[good]])
        best = np.lexsort((doc, null, -score))[:self.k]
        self.score, self.doc, self.null = score[best], doc[best], null[best]


def best_positions(lists: ImpactLists, query: list[tuple[int, int]], ids: np.ndarray,
                   null: np.ndarray, top: Top, step: int = STEP) -> int:
    """Bring ``top`` up to date with a block of documents for one query of
    (term, times). Returns how many documents were looked up."""
    parts = [(times, *lists[term]) for term, times in query]
    parts = [p for p in parts if len(p[1]) and p[2][0] > 0]
    seen = [np.zeros(len(p[1]) + 1, dtype=bool) for p in parts]  # a last place that is never seen
    best = [0] * len(parts)
    met = np.zeros(lists.n_docs, dtype=bool)
    looked_up = 0
    while parts:
        read = np.concatenate([p[1][b:b + step] for p, b in zip(parts, best, strict=True)])
        fresh = np.unique(read[~met[read]])
        met[fresh] = True
        looked_up += len(fresh)
        score = np.zeros(len(fresh), dtype=np.int64)
        bound = 0
        for i, (times, docs, impact, by_doc, position) in enumerate(parts):
            at = np.searchsorted(by_doc, fresh)
            at[at == len(by_doc)] = 0
            here = by_doc[at] == fresh  # direct access
            place = position[at[here]]
            score[here] += times * impact[place]
            seen[i][place] = True
            best[i] += int(np.argmin(seen[i][best[i]:]))
            if best[i] < len(docs):
                bound += times * int(impact[best[i] - 1])
        top.add(score, ids[fresh], null[fresh])
        if bound < max(top.floor(), 1):
            break  # an unseen document scores less than the k-th, or nothing
        step *= 2
    return looked_up


def _block(batches: list[pa.RecordBatch], weight: np.ndarray, n_all: int,
           length_all: int) -> tuple[ImpactLists, np.ndarray, np.ndarray]:
    """Impact lists of the documents of some batches, their ids and which are null."""
    table = pa.Table.from_batches(batches)
    ids = table.column("doc_id").combine_chunks()
    null = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    ids = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
    n = table.column("n").to_numpy()
    held = table.column("terms").combine_chunks()
    doc = np.repeat(np.arange(len(ids)), held.value_lengths().to_numpy(zero_copy_only=False))
    term = held.flatten().to_numpy(zero_copy_only=False)
    tf = table.column("tfs").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    m = 100 - 25 + (25 * n * n_all) // length_all
    impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
    return ImpactLists(doc, term, impact, len(ids), len(weight)), ids, null


def _search_block(docs: DataFrame, queries: list, k: int, doc_id: str, text: str) -> DataFrame:
    """The k best documents of each query (key, item_id, terms) of one block."""
    vocabulary: dict[bytes, int] = {}
    asked = []
    for key, item, found in queries:
        numbers = [vocabulary.setdefault(t, len(vocabulary)) for t in found]
        asked.append((key, item, sorted(Counter(numbers).items())))
    held = staged(postings(docs, vocabulary, doc_id, text), "postings")
    total = held.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("length")).first()
    n_all, length_all = total["docs"], total["length"] or 1
    weight = np.zeros(len(vocabulary), dtype=np.int64)  # of a term that no document holds: unused
    held_by = held.select(F.explode("terms").alias("term")).groupBy("term").count()
    for row in held_by.toLocalIterator():  # a row for each term of the block at most
        weight[row["term"]] = math.floor(1000 * math.log((2 * n_all + 2) / (2 * row["count"] + 1)))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [Top(k) for _ in asked]
        waiting, size = [], 0

        def flush() -> None:
            lists, ids, null = _block(waiting, weight, n_all, length_all)
            for (_, _, query), top in zip(asked, tops, strict=True):
                best_positions(lists, query, ids, null, top)

        for batch in batches:
            more = len(batch.column(2).flatten())
            if waiting and size + more > BLOCK_POSTINGS:
                flush()
                waiting, size = [], 0
            waiting.append(batch)
            size += more
        if waiting:
            flush()
        for (key, item, _), top in zip(asked, tops, strict=True):
            if len(top.score):
                count = len(top.score)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * count, pa.int64()), pa.array([item] * count, pa.int64()),
                     pa.array(top.doc, pa.int64(), mask=top.null), pa.array(top.score, pa.int64())],
                    names=["key", "item_id", "doc_id", "score"])

    return held.mapInArrow(rank, "key long, item_id long, doc_id long, score long")


def _first(df: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id",
           text: str = "text", item_id: str = "item_id", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents with a
    score above 0 of each item, equal scores by ascending id."""
    asked = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"),
                         F.col(f"`{text}`").alias("text")).filter("text is not null")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // query_bytes)
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1))))
    parts, key = [], 0
    for block in range(blocks):
        queries = []
        for row in dealt.filter(F.col("block") == block).toLocalIterator():
            queries.append((key, row["item_id"], terms(row["text"])))
            key += 1
        parts.append(_search_block(docs, queries, k, doc_id, text))
    schema = "key long, item_id long, doc_id long, score long"
    found = docs.sparkSession.createDataFrame([], schema)
    for part in parts:
        found = found.unionByName(part)
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    best = _first(_first(salted, k, "key", "salt").drop("rank"), k, "key")
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def oracle() -> str:
    """The same ranking for DuckDB."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def tokens(table: str, key: str) -> str:
        return (f"select {key}, unnest(regexp_extract_all(translate(text, '{upper}', "
                f"'{upper.lower()}'), '{pattern}')) as term from {table}")

    return f"""
with words as ({tokens("documents", "doc_id")}),
sizes as (select doc_id, count(*) as n from words group by doc_id),
corpus as (select count(*) as n_all, sum(n)::bigint as length_all from sizes),
asked as (select item_id, term, count(*) as times from ({tokens("benchmark", "item_id")})
          group by item_id, term),
held as (select doc_id, term, count(*) as tf from words
         where term in (select term from asked) group by doc_id, term),
weights as (select term, floor(1000 * ln((2 * n_all + 2)::double / (2 * df + 1)::double))::bigint as w
            from (select term, count(*) as df from held group by term), corpus),
marks as (select doc_id, 75 + (25 * n * n_all) // length_all as m from sizes, corpus),
scores as (select item_id, doc_id,
                  sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
           from asked join held using (term) join weights using (term) join marks using (doc_id)
           group by item_id, doc_id)
select item_id, rank, doc_id, score from (
  select item_id, doc_id, score,
         row_number() over (partition by item_id order by score desc, doc_id)::int as rank
  from scores where score > 0)
where rank <= {K}"""
