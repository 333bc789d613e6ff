"""Bottom-k sketches of shingle hashes.

A sketch keeps the ``k`` smallest 64-bit hashes of a text's different
five-word shingles (words: runs without white space, lower-cased; a shorter
text is one shingle). Sketches of parts merge into the sketch of the whole,
and estimate resemblance, containment and the number of different shingles.
With fewer than ``k`` hashes a sketch is the whole set and exact.

Neighbours by id: rows are dealt into slices of about ``SLICE_BYTES`` of text,
cut by (id, hash of the text), so rows that share an id, or have none, spread
over slices as others do. Each slice is one partition; the first row of the
next slice is copied behind it.

Cases: a null text counts as empty, with an empty sketch; two empty texts
are alike (1.0), an empty and another are not (0.0); repeated ids follow one
another by the hash of their text (equal rows, in any order, which gives the
same result, stay in one slice and are sketched once); null ids come last; a
lone row is its own next document; an empty table gives an empty result; very
long texts are sketched whole; the input's other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.text import shingle_hashes, word_hashes

K = 128
WIDTH = 5
SLICE_BYTES = 32_000_000  # of text in a slice, about; a slice is streamed
EMPTY = np.empty(0, dtype=np.uint64)


class Sketcher:
    def __init__(self, k: int = K, width: int = WIDTH):
        self.k, self.width = k, width

    def sketch(self, text: str | None) -> np.ndarray:
        """The sorted bottom-k hashes of a text, whatever its length."""
        if not text:
            return EMPTY
        found = shingle_hashes(word_hashes(text), self.width)
        if len(found) > 4 * self.k:
            # more than k different hashes may hide among repeats: widen till k are sure
            take = 2 * self.k
            while take < len(found):
                low = np.unique(np.partition(found, take)[:take])
                if len(low) >= self.k:
                    return low[:self.k]
                take *= 4
        return np.unique(found)[:self.k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union of two texts' shingles."""
    return np.union1d(a, b)[:k]


def distinct(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of different shingles (exact below k)."""
    if len(sketch) < k:
        return float(len(sketch))
    return (k - 1) / (float(sketch[-1]) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity of two texts' shingle sets."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    low = merge(a, b, k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(both, low[-1], side="right")) / len(low)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of ``a``'s shingles that ``b`` has too."""
    if len(a) == 0:
        return 1.0
    union = distinct(merge(a, b, k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct(a, k))


def to_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode("ascii")


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype="<u8")


def fingerprints(df: DataFrame, text: str = "text", k: int = K, width: int = WIDTH,
                 name: str = "fingerprint") -> DataFrame:
    """``df`` with each text's sketch as a string column ``name`` (which
    replaces an input column of that name)."""

    @F.pandas_udf("string")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        maker = Sketcher(k, width)
        for texts in batches:
            yield pd.Series([to_text(maker.sketch(t)) for t in texts], dtype=object)

    return df.withColumn(name, sketch(F.col(text)))


def with_half_of(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first
    as many (or all) of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_ORDER = ("last", "doc_id", "tie")  # null ids last, equal ids by their texts' hash


def _heads(rows: DataFrame, slice_bytes: int) -> list[tuple[int, int, int]]:
    """The least (last, doc_id, tie) of each slice: a narrow pass over the
    keys, of which a row for each slice reaches the driver."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = rows.select(*_ORDER).repartitionByRange(max(1, -(-size // slice_bytes)), *_ORDER)
    found = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(*_ORDER)).alias("h"))
    return sorted({tuple(r["h"]) for r in found.toLocalIterator()})


def _slice_of(heads: list[tuple[int, int, int]]):
    """(last, doc_id, tie) -> the slice: how many heads aren't greater, less
    one. A binary search by id, and by hash among the heads of that id."""
    lasts, ids, ties = (np.array(c, dtype=np.int64) for c in zip(*heads, strict=True))
    split = int(np.searchsorted(lasts, 1))

    @F.pandas_udf("int")
    def slices(last: pd.Series, doc_id: pd.Series, tie: pd.Series) -> pd.Series:
        last, x, t = last.to_numpy(), doc_id.to_numpy(), tie.to_numpy()
        low = np.where(last == 1, split, np.searchsorted(ids[:split], x, side="left"))
        high = np.where(last == 1, len(ids), np.searchsorted(ids[:split], x, side="right"))
        at = low.copy()
        for a in np.unique(low[low < high]):  # a stretch of heads that share an id
            mine = (low == a) & (low < high)
            b = high[mine][0]
            at[mine] = a + np.searchsorted(ties[a:b], t[mine], side="right")
        return pd.Series(np.maximum(at - 1, 0))

    return slices


def _slices(df: DataFrame, doc_id: str, text: str, slice_bytes: int) -> tuple[DataFrame, int]:
    """Rows dealt into slices, each followed by a copy of the row that comes
    next (halo): the first of the next slice, or of all after the last; and
    the number of slices. Only the slices' heads pass through the driver;
    every text is shuffled once."""
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select(
        F.col("doc_id").isNull().cast("long").alias("last"),
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    heads = _heads(rows, slice_bytes)
    if not heads:
        return rows.withColumn("slice", F.lit(0)).withColumn("halo", F.lit(False)), 1
    small = df.sparkSession.createDataFrame(
        [(i - 1 if i else len(heads) - 1, *head) for i, head in enumerate(heads)],
        "slice int, last long, doc_id long, tie long")
    first = rows.join(F.broadcast(small), list(_ORDER))  # a row for each slice
    halo = first.groupBy("slice", *_ORDER).agg(F.min("text").alias("text"))  # equal rows once
    names = ["text", *_ORDER, "slice", "halo"]
    dealt = rows.withColumn("slice", _slice_of(heads)(*_ORDER)).withColumn("halo", F.lit(False))
    return dealt.select(names).union(
        halo.withColumn("halo", F.lit(True)).select(names)), len(heads)


def edited_fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                        k: int = K, width: int = WIDTH,
                        slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_shingles: each document beside itself with half
    of the next document's text (``with_half_of``) and beside the next."""
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double, "
              "n_shingles double")
    names = [c.split()[0] for c in schema.split(", ")]
    rows, n = _slices(df, doc_id, text, slice_bytes)

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maker, before, seen, sketch = Sketcher(k, width), None, None, EMPTY
        for batch in batches:
            out = []
            for none, id_, value in zip(batch["last"], batch["doc_id"], batch["text"], strict=True):
                value = value if isinstance(value, str) else ""
                own = sketch if value == seen else maker.sketch(value)
                if before is not None:
                    edited = with_half_of(seen, value)
                    changed = sketch if edited == seen else maker.sketch(edited)
                    out.append((before[0], len(seen),
                                hashlib.sha256(edited.encode("utf-8")).hexdigest(),
                                to_text(sketch), to_text(changed),
                                resemblance(sketch, changed, k), resemblance(sketch, own, k),
                                distinct(sketch, k)))
                before, seen, sketch = (None if none else id_,), value, own
            if out:
                part = pd.DataFrame(out, columns=names)
                yield part.assign(doc_id=part["doc_id"].astype("Int64"))

    # a partition is a slice; its last row is the next slice's first
    dealt = rows.repartitionById(n, "slice").sortWithinPartitions("halo", *_ORDER)
    return dealt.select("last", "doc_id", "text").mapInPandas(follow, schema)
