"""Helpers shared by the text operators."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import scratch_path

_C1 = np.uint64(0xBF58476D1CE4E5B9)  # constants of the splitmix64 finaliser
_C2 = np.uint64(0x94D049BB133111EB)
#: Odd multipliers: of a word's bytes by place, and of a shingle's words by place.
_BYTE = 0x9E3779B97F4A7C15
_BYTE_INVERSE = pow(_BYTE, -1, 1 << 64)
_PLACES = [np.uint64((0xD6E8FEB86659FD93 + 2 * i * 0x94D049BB133111EB) & ((1 << 64) - 1))
           for i in range(64)]
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)
#: White space as ``str.split`` knows it: characters beyond ASCII, and bytes.
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACE = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over an array of uint64 (a bijection)."""
    x = x ^ (x >> _S30)
    x *= _C1
    x ^= x >> _S27
    x *= _C2
    x ^= x >> _S31
    return x


class WordHashes(dict):
    """word -> 64-bit hash, remembered for the words met lately. The memory
    is bounded: at ``limit`` words it starts afresh, and a word over 64
    characters is never kept."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode("utf-8"))
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value

    def array(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


class _Powers:
    """Powers of the byte multiplier and of its inverse, as many as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(1 << 12, 1 << (n - 1).bit_length())
            up, down = np.full(size, _BYTE, dtype=np.uint64), np.full(size, _BYTE_INVERSE,
                                                                      dtype=np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def word_hashes(text: str, block: int = 1 << 18) -> np.ndarray:
    """64-bit hashes of a text's words (runs without white space, lower-cased)
    in order. A word's hash is a polynomial of its bytes, taken from running
    sums over the whole text and then mixed; long texts go block by block."""
    lower = text.lower()
    if not lower.isascii():
        lower = _WIDE_SPACE.sub(" ", lower)
    data = lower.encode("utf-8")
    if len(data) > block:  # one space between words, to part blocks at
        data = " ".join(lower.split()).encode("utf-8")
    out, low = [], 0
    while low < len(data):
        high = len(data)
        if high - low > block:  # to the next space after the block
            high = data.find(b" ", low + block)
            high = len(data) if high < 0 else high
        part = np.frombuffer(data, dtype=np.uint8, count=high - low, offset=low)
        up, down = _powers(len(part) + 1)
        sums = np.empty(len(part) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        space = np.ones(len(part) + 2, dtype=bool)
        space[1:-1] = _SPACE[part]
        turns = np.flatnonzero(space[1:] != space[:-1])
        starts, ends = turns[::2], turns[1::2]
        out.append(mix64((sums[ends] - sums[starts]) * down[starts]))
        low = high + 1
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every run of ``width`` words, in text order; a text of
    fewer words (but at least one) has one shingle of all its words."""
    n = len(words)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    width = min(width, n)
    out = np.full(n - width + 1, width, dtype=np.uint64)
    for i in range(width):  # each place has a multiplier of its own; word hashes are well mixed
        out += words[i:n - width + 1 + i] * _PLACES[i % 64]
    return mix64(out)


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether a row is held out of learning: crc32(doc_id as text) mod
    ``modulus`` is ``remainder``. A null id is held out."""
    part = F.crc32(F.col(doc_id).cast("string")) % modulus
    return F.coalesce(part == remainder, F.lit(True))


def bounded_sample(df: DataFrame, id_col: str, by: Column, bound: int) -> DataFrame:
    """Rows of each value of ``by``, about ``bound`` of them at most: all of
    a value with fewer, else those whose hashed id falls under bound / count
    (the same rows in every run). ``by`` must have few values: one row for
    each goes to the driver."""
    counts = df.groupBy(by.alias("k")).count().collect()
    keep = F.lit(False)
    unit = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col).cast("string")),
                  F.lit(1_000_003)) / 1_000_003
    for row in counts:
        same = by.eqNullSafe(F.lit(row["k"]))
        keep = F.when(same, unit < bound / row["count"]).otherwise(keep)
    return df.filter(keep)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int,
                  sample: int) -> DataFrame:
    """(doc_id, y, text): about ``sample`` documents of each label (0, 1) at
    most, none of them held out.

    The sample is drawn from the labels, before any text is read: its ids
    (twice ``sample`` about) are broadcast, so only sampled texts are moved.
    An id that repeats counts once with each of its labels, with the least of
    its texts."""
    out = held_out("doc_id", modulus, remainder)
    marks = (labels.select("doc_id", F.col(label).cast("int").alias("y"))
             .filter(~out & F.col("y").isin(0, 1)).distinct())
    chosen = bounded_sample(marks, "doc_id", F.col("y"), sample)
    rows = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(
        F.broadcast(chosen), "doc_id")
    return staged(rows.groupBy("doc_id", "y").agg(F.min("text").alias("text")), "training-rows")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read
    back: the lineage ends here and a lost executor costs only a re-read."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
