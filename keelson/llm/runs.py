"""Periodic runs of words, by a dictionary of basic factors.

Words are runs without ASCII white space. The dictionary names, for every
power of two, the factor of that many words at each position (a pair of
names of the level below); a factor that occurs once has no name, and no
longer factor at its position is looked at. On every level the next
occurrence of each named factor is looked up; where three occurrences follow
one another at the same distance, at most twice the factor's length, that
distance is proposed as a period. A proposal is extended to both sides as
far as words one period apart are equal, and is kept once.

A run is a stretch of words with smallest period q and a length of at least
``max(least, times * q)`` that neither neighbour extends. ``times`` must be
4 or more: with L the least power of two that is q or more, L < 2q, so three
factors of L words at distance q fit into 4q words, and in such a run no
factor of q words or more occurs again at less than q. So no run is missed.
A stretch of that length which has a smaller period than the proposed one
would hold a nearer occurrence, so what is kept has its smallest period.

Texts of a batch share one dictionary (words are named by text, so no factor
is common to two texts). Memory: a few integers for each word of a batch.

Cases: a null, empty or white text has no words, no runs and the collapsed
text ""; texts of any length are read whole; equal texts have equal runs;
rows are neither dropped nor joined, so repeated rows and null ids stay; an
empty table gives an empty result; columns of the input named like a result
are replaced, others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 6
TIMES = 4
WORD = r"[^\x20\x09-\x0D]+"
#: Words that share one dictionary, about; a longer text has one of its own.
BATCH_WORDS = 400_000
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class _Names(dict):
    """Words numbered from 0 as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _rename(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Equal keys get equal names from 1, a key that occurs once gets 0."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    repeated = counts > 1
    names = np.where(repeated, np.cumsum(repeated), 0)
    return names[inverse], int(repeated.sum())


def _extent(symbols: np.ndarray, i: int, period: int) -> tuple[int, int]:
    """The longest stretch [low, high) around ``i`` in which symbols one
    period apart are equal, by comparing blocks that double."""
    n = len(symbols) - period
    high, step = i, 32
    while high < n:
        stop = min(n, high + step)
        off = np.flatnonzero(symbols[high:stop] != symbols[high + period:stop + period])
        if len(off):
            high += int(off[0])
            break
        high, step = stop, 2 * step
    low, step = i, 32
    while low > 0:
        stop = max(0, low - step)
        off = np.flatnonzero(symbols[stop:low] != symbols[stop + period:low + period])
        if len(off):
            low = stop + int(off[-1]) + 1
            break
        low, step = stop, 2 * step
    return low, high + period


def _proposals(at: np.ndarray, names: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """(position, period) by period and position, one for each row of
    neighbouring positions: ``names`` of the factors at ``at`` (ascending)."""
    order = np.argsort(names, kind="stable")
    gap = np.zeros(len(at), dtype=np.int64)  # to the next occurrence, 0: none
    same = names[order[1:]] == names[order[:-1]]
    gap[order[:-1][same]] = (at[order[1:]] - at[order[:-1]])[same]
    gap[gap > 2 * length] = 0
    follows = np.zeros(len(at), dtype=np.int64)  # the gap after the next occurrence
    follows[order[:-1][same]] = gap[order[1:][same]]
    found = np.flatnonzero((gap > 0) & (gap == follows))
    if len(found) == 0:
        return
    found = found[np.lexsort((at[found], gap[found]))]
    i, d = at[found], gap[found]
    first = np.ones(len(i), dtype=bool)
    first[1:] = (np.diff(i) != 1) | (np.diff(d) != 0)
    yield from zip(i[first].tolist(), d[first].tolist(), strict=True)


def runs_of(symbols: np.ndarray, least: int = LEAST,
            times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of an integer array, by start and period."""
    if times < 4:
        raise ValueError("times must be 4 or more")
    n, length = len(symbols), 1
    at = np.arange(n, dtype=np.int64)
    names, count = _rename(symbols)
    found = set()
    while True:
        named = names > 0
        at, names = at[named], names[named]
        if len(at) == 0:
            break
        last_period, last_end = 0, 0
        for i, period in _proposals(at, names, length):
            if period == last_period and i < last_end - period:
                continue  # inside the run proposed before
            low, high = _extent(symbols, i, period)
            last_period, last_end = period, high
            if high - low >= max(least, times * period):
                found.add((low, high - low, period))
        # the next level: factors of twice the length, where both halves have names
        dense = np.zeros(n + length, dtype=np.int64)
        dense[at] = names
        second = dense[at + length]
        both = second > 0
        at = at[both]
        names, count = _rename(names[both] * np.int64(count + 1) + second[both])
        length *= 2
    return sorted((s, m, q) for s, m, q in found)


def _batch_runs(texts: list[list[bytes]], least: int, times: int) -> list[list[tuple]]:
    """The runs of each text. The texts' words go through one dictionary, kept
    apart by naming them by (text, word); a symbol of its own ends each."""
    names = _Names()
    sizes = np.array([len(words) for words in texts], dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int((sizes + 1).sum()), dtype=np.int64)
    for words, low in zip(texts, starts.tolist(), strict=True):
        symbols[low:low + len(words)] = np.fromiter(map(names.__getitem__, words),
                                                    dtype=np.int64, count=len(words))
    symbols[starts + sizes] = len(names)  # no word's name, and once in each text
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), sizes + 1)
    symbols += owner * (len(names) + 1)
    out = [[] for _ in texts]
    for start, length, period in runs_of(symbols, least, times):
        text = int(owner[start])
        out[text].append((start - int(starts[text]), length, period))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period, joined by a space."""
    if runs:
        keep = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words).decode("utf-8", "replace")


def find_runs(df: DataFrame, text: str = "text", least: int = LEAST,
              times: int = TIMES) -> DataFrame:
    """``df`` with ``n_words``, ``runs`` (an array of start, length, period by
    start and period, in words from 0) and ``collapsed`` (the text without the
    repeats) of each text. One scan, no shuffle."""

    @F.pandas_udf(f"n_words bigint, runs {RUNS}, collapsed string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [t.encode("utf-8").split() if t else [] for t in batch]  # ASCII white space
            found, low = [], 0
            while low < len(words):
                high, held = low, 0
                while high < len(words) and (high == low or held + len(words[high]) <= BATCH_WORDS):
                    held += len(words[high])
                    high += 1
                found += _batch_runs(words[low:high], least, times)
                low = high
            yield pd.DataFrame({
                "n_words": [len(w) for w in words],
                "runs": [[{"start": s, "length": m, "period": q} for s, m, q in r] for r in found],
                "collapsed": [collapse(w, r) for w, r in zip(words, found, strict=True)]})

    names = ("n_words", "runs", "collapsed")
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    return df.select(*kept, scan(F.col(f"`{text}`")).alias("__scan")).select(
        *kept, *[F.col("__scan").getField(c).alias(c) for c in names])


def repeating(doc_id: Column, text: Column) -> Column:
    """The texts of the query: for every tenth document (by the CRC-32 of its
    id) the words from some place on are one passage over and over; the others,
    and those with a null id, are as given."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def over_and_over(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        passage = F.flatten(F.array_repeat(F.slice(words, a + 1, p), times))
        return F.concat_ws(" ", F.slice(words, F.lit(1), a), F.slice(passage, F.lit(1), n - a))

    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    # a name for the words, so that they are taken from the text once
    planted = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, over_and_over(w)))[0]
    return F.when(h % 10 == 0, F.coalesce(planted, text)).otherwise(text)


def run_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256, n_words: each document's longest run and digests of all."""
    rows = docs.select(F.col("doc_id"), repeating(F.col("doc_id"), F.col("text")).alias("text"))
    found = find_runs(rows)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"))))
    found = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"),
                         best.alias("best"),
                         F.sha2(lines, 256).alias("runs_sha256"),
                         F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.select(
        "doc_id", "n_runs", (-F.col("best.before")).alias("start"), "best.length",
        (-F.col("best.shorter")).alias("period"),
        F.expr("(1000 * best.length) div -best.shorter").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256", "n_words")
