"""Near-duplicate classes by consistent weighted sampling.

A text is the multiset of its five-word shingles (words: runs without white
space, lower-cased; a shorter text is one shingle). A shingle's weight is its
term frequency, 1 + log(count), times its inverse document frequency,
min(log(N / df), log(1 / COMMON)), counted over different texts: shingles in
more than the ``COMMON`` share of them weigh less (but half of the others'
at least), all others the same, and a line that a text repeats doesn't drown
the rest of it. In a text half of whose shingles are common or more, those
are the text, not a line that it shares: there all frequencies weigh the
same. Two texts are similar if their weighted Jaccard similarity (sum of
least weights over sum of largest) is at least ``threshold``, with these
weights or with all inverse frequencies equal, so no group, however large,
pushes its own texts apart; classes are the connected groups of similar texts.

1. Common shingles, exactly: every shingle is counted in one of ``BUCKETS``
   buckets (summed by Spark); those in buckets that reach the limit are
   counted one by one. At most 1 / COMMON times the mean number of shingles
   of a text can be common, whatever the size of the corpus: that bounds
   the table that is broadcast.
2. Each text gets BANDS x ROWS consistent weighted samples; equal bands make
   candidates. Equal texts (by MD5) are one node from here on. The weights of
   shingles are made of parts that weigh the same in every text, so a sample is
   the least of weighted hashes of parts (``Sampler.unit_samples``), exactly as
   often equal as the texts are similar; ``Sampler.samples`` (improved
   consistent weighted sampling, ICWS) does the same for weights of any kind.
3. Each band's nodes are compared with one of them, the leader, chosen by a
   hash, not with each other: nodes x bands comparisons at most. The two
   texts' weighted Jaccard similarity is computed exactly.
4. Similar pairs are joined into classes by large-star and small-star steps.
5. A leader was compared with all of its band and isn't compared there again.
   Where a band's other nodes aren't of one class yet, a second round takes
   another leader each. The nodes of large bands that are still of several classes
   (more than ``CROWD`` nodes: texts that share a passage, say) get
   ``FINE_BANDS`` bands of ``FINE_ROWS`` samples, in which texts that are far
   from similar part, and a leader there, so the work doesn't grow
   with the square of such a band. What is then still of several classes is
   compared completely, in
   blocks: a band's nodes are dealt into chunks of about ``CHUNK`` (or
   ``CHUNK_CHARS`` characters), and a task holds two chunks, multiplies their
   weights as matrices, and returns only the pairs that join classes (fewer
   than nodes), so neither all pairs nor a whole group ever stand in one place.
   A node is in a few blocks only, but where more than ``CROWD`` texts of several
   classes agree in six samples, that is, are nearly as similar as the threshold.

A pair at the threshold shares a band with probability
1 - (1 - threshold ** ROWS) ** BANDS, 0.99999 at 0.8, and a fine band with
0.999995.

Cases: null texts count as empty; texts without words are similar to texts
equal to them only; repeated rows are in one class; null ids are allowed (a
class of them alone has a null id); an empty table gives empty results; very
long texts are read whole, their shingles in blocks;
``keep_one`` returns the input's columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.text import mix64, shingle_hashes, staged, word_hashes

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 3
FINE_BANDS, FINE_ROWS = 40, 6
COMMON = 0.05
BUCKETS = 1 << 16
ROUNDS, FINE_ROUNDS = 1, 1
CHUNK, CHUNK_CHARS = 400, 2_000_000
CROWD = 4 * CHUNK
#: What marks the first occurrence of a shingle.
_FIRST = mix64(np.ones(1, dtype=np.uint64))
#: Rounding that two ways to add up the same weights may differ by.
NEAR = 1e-9


@cache
def _gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at the middles of n steps."""
    x = np.concatenate([np.geomspace(1e-6, 1e-2, 20_000), np.linspace(1e-2, 40, 400_000)[1:]])
    return np.interp((np.arange(n) + 0.5) / n, 1 - (1 + x) * np.exp(-x), x)


class Sampler:
    """Shingles and consistent weighted samples of texts."""

    def __init__(self, common: tuple[np.ndarray, np.ndarray], bands: int = BANDS, rows: int = ROWS,
                 width: int = WIDTH, share: float = COMMON):
        self.width, self.bands, self.rows = width, bands, rows
        self.common, self.idf = common
        self.rare = float(np.log(1 / share))
        seeds = np.random.default_rng(5).integers(0, 2**64, size=bands * rows, dtype=np.uint64)
        self.seeds = seeds[:, None] | np.uint64(1)

    def shingles(self, text: str | None) -> np.ndarray:
        return shingle_hashes(word_hashes(text or ""), self.width)

    def counted(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The different shingles, in order, and how often each stands in the text."""
        found = np.sort(self.shingles(text))
        first = np.ones(len(found), dtype=bool)
        np.not_equal(found[1:], found[:-1], out=first[1:])
        at = np.flatnonzero(first)
        return found[at], np.diff(at, append=len(found))

    def weighted(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The different shingles, in order, and their TF-IDF weights."""
        found, times = self.counted(text)
        return found, (1.0 + np.log(times)) * self.inverse_frequency(found)[0]

    def inverse_frequency(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each of a text's different shingles weighs in it, and what in
        a text few of whose shingles are common."""
        out = np.full(len(found), self.rare)
        if len(self.common) and len(found):
            at = np.minimum(np.searchsorted(self.common, found), len(self.common) - 1)
            known = self.common[at] == found
            out[known] = np.maximum(self.idf[at[known]], self.rare / 2)
            if 2 * known.sum() >= len(found):
                return np.full(len(found), self.rare), out
        return out, out

    def both(self, text: str | None) -> tuple:
        """The different shingles, their weights, and their weights with all
        inverse frequencies equal."""
        found, times = self.counted(text)
        often = 1.0 + np.log(times)
        return found, often * self.inverse_frequency(found)[0], often * self.rare

    def units(self, text: str | None, level: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The weights of ``weighted``, parted so that each part is in a text
        or not: the j-th occurrence of a shingle adds log(j) - log(j - 1)
        times its inverse frequency (the first adds that itself). With ``level``
        all inverse frequencies are equal."""
        found, times = self.counted(text)
        part, step = self._occurrences(found, times)
        return (part, self.rare * step) if level else self._parts(found, times, part, step)

    def both_units(self, text: str | None) -> tuple:
        """``units``, and those with all inverse frequencies equal where they
        differ (else None)."""
        found, times = self.counted(text)
        part, step = self._occurrences(found, times)
        uneven = len(self.common) and (self.inverse_frequency(found)[0] < self.rare).any()
        return (self._parts(found, times, part, step), (part, self.rare * step) if uneven else None)

    def _occurrences(self, found: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A part for each occurrence of a shingle, and what it adds to 1 + log(count)."""
        total = int(times.sum())
        if total == len(found):  # none is repeated
            return mix64(found + _FIRST), np.ones(total)
        turn = np.arange(1, total + 1) - np.repeat(np.cumsum(times) - times, times)
        step = np.where(turn > 1, np.log(turn / np.maximum(turn - 1, 1)), 1.0)
        return mix64(np.repeat(found, times) + mix64(turn.astype(np.uint64))), step

    def _parts(self, found: np.ndarray, times: np.ndarray, part: np.ndarray,
               step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mine, least = self.inverse_frequency(found)
        if mine is least:
            return part, (least * step if len(part) == len(found) else np.repeat(least, times) * step)
        # what a shingle weighs here above what it weighs elsewhere is a part of its own
        over = np.repeat(mine - least, times) * step
        more = over > 0
        return (np.concatenate([part, mix64(part[more])]),
                np.concatenate([np.repeat(least, times) * step, over[more]]))

    def unit_samples(self, part: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One hash for each of the bands x rows samples of a text's ``units``.

        A part weighs the same in every text that has it, so no weight has to
        be sampled: the part of the least -log(1 - hash) / weight is the sample,
        and two texts have the same one with the probability of their weighted
        Jaccard similarity. Of parts of one weight that is the one of the least
        hash, so only that one's logarithm is taken."""
        order = np.argsort(weights, kind="stable")
        part, weights = part[order], weights[order]
        first = np.flatnonzero(np.append(True, weights[1:] != weights[:-1]))
        least = np.full((len(self.seeds), len(first)), ~np.uint64(0))
        for low in range(0, len(part), 512):  # any length of text, in blocks
            x = part[None, low:low + 512] * self.seeds
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            some = slice(np.searchsorted(first, low, "right") - 1, np.searchsorted(first, low + 512))
            within = np.maximum(first[some] - low, 0)
            least[:, some] = np.minimum(least[:, some], np.minimum.reduceat(x, within, axis=1))
        if len(first) == 1:
            return least[:, 0]
        value = -np.log1p(least * -(2.0**-64)) / weights[first]
        return least[np.arange(len(least)), value.argmin(1)]

    def samples(self, found: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One hash for each of the bands x rows samples (ICWS), where a shingle's
        weights in two texts may be any two numbers."""
        gamma = _gamma_quantiles(1 << 16)
        r_of, log_c_of = gamma.astype(np.float32), np.log(gamma).astype(np.float32)
        best = np.full(len(self.seeds), np.inf, dtype=np.float32)
        out = np.zeros(len(self.seeds), dtype=np.uint64)
        every = np.arange(len(self.seeds))
        log_w = np.log(weights).astype(np.float32)
        for low in range(0, len(found), 512):  # any length of text, in blocks
            part = found[low:low + 512]
            # a product with an odd seed, then mixed; its bits choose r, c and beta
            x = part[None, :] * self.seeds
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(32)
            lanes = x.view(np.uint16).reshape(len(self.seeds), len(part), 4)
            r, log_c = r_of[lanes[:, :, 0]], log_c_of[lanes[:, :, 1]]
            beta = x.view(np.uint32)[:, 1::2].astype(np.float32)
            beta *= np.float32(2.0**-32)
            t = log_w[None, low:low + 512] / r
            t += beta
            np.floor(t, out=t)
            beta -= t
            beta -= np.float32(1)  # -(t - beta + 1)
            a = beta
            a *= r
            a += log_c
            at = a.argmin(1)
            value = a[every, at]
            new = value < best
            best[new] = value[new]
            out[new] = mix64(part[at[new]] + mix64(t[every, at][new].astype(np.int64)
                                                  .astype(np.uint64)))
        return out

    def band_keys(self, samples: np.ndarray) -> np.ndarray:
        key = np.arange(self.bands, dtype=np.uint64)
        for i in range(self.rows):
            key = mix64(key + samples[i::self.rows])
        return key


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the least weights over the sum of the largest; 0 for two empty sets."""
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = float(np.minimum(a[1][at_a], b[1][at_b]).sum())
    union = float(a[1].sum() + b[1].sum()) - least
    return least / union if union > 0 else 0.0


def similarity(a: tuple, b: tuple) -> float:
    """The larger of two texts' similarities (``Sampler.both``)."""
    found = weighted_jaccard(a[:2], b[:2])
    if np.array_equal(a[1], a[2]) and np.array_equal(b[1], b[2]):
        return found
    return max(found, weighted_jaccard(a[::2], b[::2]))


def block_similarities(units: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weighted Jaccard similarity of every two texts of a block."""
    n = len(units)
    sizes = np.array([w.sum() for _, w in units])
    owner = np.repeat(np.arange(n), [len(h) for h, _ in units])
    hashes, place = np.unique(np.concatenate([h for h, _ in units]), return_inverse=True)
    weight = np.zeros(len(hashes))
    weight[place] = np.concatenate([w for _, w in units])
    often = np.bincount(place, minlength=len(hashes)) > 1  # others are in no intersection
    column = np.cumsum(often) - 1
    some = often[place]
    owner, place, weight = owner[some], column[place[some]], weight[often]
    least = np.zeros((n, n))
    if n <= 32:  # few texts: one by one is cheaper than a matrix
        order = np.argsort(owner, kind="stable")
        parts = np.split(place[order], np.searchsorted(owner[order], np.arange(1, n)))
        for i in range(n):
            has = np.zeros(len(weight))
            has[parts[i]] = weight[parts[i]]
            for j in range(i):
                least[i, j] = least[j, i] = has[parts[j]].sum()
    else:
        least = _overlaps(n, owner, place, weight)
    union = sizes[:, None] + sizes[None, :] - least
    return np.divide(least, union, out=np.zeros((n, n)), where=union > 0)


def _overlaps(n: int, owner: np.ndarray, place: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The weight that every two of n texts share."""
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    least = np.zeros((n, n))
    for low in range(0, len(weight), 4096):
        part = slice(*np.searchsorted(place, [low, low + 4096]))
        has = np.zeros((n, min(4096, len(weight) - low)))
        has[owner[part], place[part] - low] = 1.0
        least += (has * weight[low:low + 4096]) @ has.T
    return least


def common_shingles(texts: DataFrame, text: str, n: int, share: float = COMMON,
                    buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, log(n / df)) of the shingles in at least ``share``
    of the ``n`` documents."""
    none = (np.empty(0, dtype=np.uint64), np.empty(0))

    def per_bucket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler, total = Sampler(none), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for low in range(0, len(batch), 256):
                found = [sampler.counted(v)[0] for v in batch[text][low:low + 256]]
                total += np.bincount((np.concatenate(found) % np.uint64(buckets)).astype(np.int64),
                                     minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    limit = share * n
    full = (texts.select(text).mapInPandas(per_bucket, "bucket long, n long").groupBy("bucket")
            .agg(F.sum("n").alias("n")).filter(F.col("n") >= limit).toPandas()["bucket"])
    if len(full) == 0:
        return none
    marked = np.zeros(buckets, dtype=bool)
    marked[full.to_numpy()] = True

    def per_shingle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = Sampler(none)
        for batch in batches:
            sums: dict[int, int] = {}
            for value in batch[text]:
                found = sampler.shingles(value)
                found = found[marked[(found % np.uint64(buckets)).astype(np.int64)]]
                for h in set(found.tolist()):
                    sums[h] = sums.get(h, 0) + 1
            yield pd.DataFrame({"h": np.array(list(sums), dtype=np.uint64).view(np.int64),
                                "n": np.array(list(sums.values()), dtype=np.int64)})

    counted = (texts.select(text).mapInPandas(per_shingle, "h long, n long").groupBy("h")
               .agg(F.sum("n").alias("n")).filter(F.col("n") >= limit).toPandas())
    hashes = counted["h"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.log(n / counted["n"].to_numpy(dtype=float)[order])


def _bands(shared, bands_: int = BANDS, rows: int = ROWS):
    @F.pandas_udf("array<long>")
    def bands(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sampler = Sampler(shared.value, bands_, rows)
        for texts in batches:
            out = []
            for value in texts:
                part, weights = sampler.units(value)
                out.append(sampler.band_keys(sampler.unit_samples(part, weights)).view(np.int64)
                           if len(part) else np.empty(0, dtype=np.int64))
            yield pd.Series(out, dtype=object)

    return bands


def _similar(pairs: DataFrame, texts: DataFrame, shared, threshold: float) -> DataFrame:
    """Of the pairs (a, b) those whose texts are similar; one row a pair.
    Both joins are on a node, so a node in many pairs is split by the skew
    handling of the join; nothing is gathered by node."""

    @F.pandas_udf("double")
    def alike(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        sampler, lately = Sampler(shared.value), {}

        def weighted(value: str | None):
            found = lately.get(value)
            if found is None:
                found = sampler.both(value)
                if value is None or len(value) < 100_000:
                    if len(lately) >= 32:
                        lately.pop(next(iter(lately)))
                    lately[value] = found
            return found

        for left, right in batches:
            yield pd.Series([similarity(weighted(a), weighted(b))
                             for a, b in zip(left, right, strict=True)], dtype=float)

    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b"))
    return both.filter(alike("ta", "tb") >= threshold - NEAR).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, class) of every node of the edges (a, b): class is the least
    node that it hangs together with. Large-star and small-star steps turn
    the edges into stars; each step is written out, so lineage stays short."""
    edges = staged(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(
            F.least(F.min("v"), F.first("u")).alias("m"), F.count_if(F.col("v") < F.col("u")).alias("lower"),
            F.count_if(F.col("v") > F.col("u")).alias("higher")), "least")
        # stars: a node hangs on one lesser node, its class, or others hang on it
        if least.filter("lower > 1 or lower = 1 and higher > 0").isEmpty():
            return least.select(F.col("u").alias("node"), F.col("m").alias("class"))
        large = (both.filter("v > u").join(least.filter("higher > 0").select("u", "m"), "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").unionByName(lower.select("u", F.col("m").alias("v"))).distinct())
        edges = staged(small, "edges")


def _merged(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, class) once the classes that the pairs (a, b) join are one: the
    components of classes, which are far fewer than nodes. A node that has no
    class yet is one of its own."""
    links = pairs
    for name in ("a", "b"):
        of = found.select(F.col("node").alias(name), F.col("class").alias(f"class_{name}"))
        links = links.join(of, name, "left")
    merged = components(links.select(F.coalesce("class_a", "a").alias("a"),
                                     F.coalesce("class_b", "b").alias("b")))
    known = found.join(merged.select(F.col("node").alias("class"), F.col("class").alias("into")),
                       "class", "left").select("node", F.coalesce("into", "class").alias("class"))
    return known.unionByName(merged.join(found, "node", "left_anti"))


def _by_band(members: DataFrame, *aggregates) -> DataFrame:
    """Aggregates of each band. They are dealt by a hash of the band, so that a
    join with the members deals them (a row for each band) anew: a crowded band
    is split only where nothing stands between its shuffle and the join."""
    return members.groupBy(F.xxhash64("band", "key").alias("dealt"), "band", "key").agg(
        *aggregates).drop("dealt")


def _members(exploded: DataFrame) -> DataFrame:
    """The nodes (node, band, key) of bands that hold several."""
    several = _by_band(exploded, F.count(F.lit(1)).alias("n"))
    return exploded.join(several.filter("n > 1").select("band", "key"), ["band", "key"])


def _rank(turn: int, *more: str):
    """Least for a band's leader of this turn."""
    return F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), "node", *more)


def _led(members: DataFrame) -> DataFrame:
    """The members and their band's first leader."""
    leaders = _by_band(members, F.min(_rank(0)).alias("l"))
    return members.join(leaders.select("band", "key", F.col("l.node").alias("lead")), ["band", "key"])


def _pairs(led: DataFrame) -> DataFrame:
    """(a, b): nodes and their leaders."""
    return led.filter("node <> lead").select(F.greatest("node", "lead").alias("a"),
                                             F.least("node", "lead").alias("b")).distinct()


def _followers(led: DataFrame) -> DataFrame:
    """The members that are left to be compared with each other, once the
    leader of their band was compared with all of them."""
    return led.filter("node <> lead").select("node", "band", "key")


def _unsettled(members: DataFrame, classes: DataFrame, turn: int) -> DataFrame:
    """The members, with their classes and this turn's leader, of bands that
    hold more than one class."""
    known = members.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    mixed = _by_band(known, F.min("class").alias("c0"), F.max("class").alias("c1"),
                     F.min(_rank(turn, "class")).alias("l"))
    return known.join(mixed.filter("c0 <> c1").select(
        "band", "key", F.col("l.node").alias("lead"), F.col("l.class").alias("lead_class")),
        ["band", "key"])


def _crowded(left: DataFrame) -> DataFrame:
    """The bands of more than ``CROWD`` nodes."""
    return _by_band(left, F.count(F.lit(1)).alias("n")).filter(F.col("n") > CROWD).select(
        "band", "key")


def _blockwise(left: DataFrame, texts: DataFrame, shared, threshold: float) -> DataFrame:
    """(a, b): similar pairs that join all classes of a band that hang
    together, found by comparing all nodes of each band block by block."""
    left = left.join(texts.select("node", F.length("text").alias("n_chars")), "node")
    size = left.groupBy("band", "key").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / CHUNK, F.sum("n_chars") / CHUNK_CHARS)).cast("int").alias("chunks"))
    dealt = left.join(size, ["band", "key"]).withColumn(
        "chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    block = ["band", "key", "low", "high"]
    dealt = dealt.select(
        "band", "key", F.least("chunk", "other").alias("low"),
        F.greatest("chunk", "other").alias("high"), "node", "class").join(texts, "node")
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler, now, held = Sampler(shared.value), None, []

        def joined() -> list[tuple[str, str]]:
            root = {c: c for _, c, _ in held}
            if len(root) < 2:
                return []

            def top(c: str) -> str:
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            out = []
            units = [sampler.both_units(text) for _, _, text in held]
            alike = block_similarities([u for u, _ in units])
            if any(level is not None for _, level in units):
                alike = np.maximum(alike, block_similarities(
                    [u if level is None else level for u, level in units]))
            kinds = np.unique([c for _, c, _ in held], return_inverse=True)[1]
            alike = (alike >= threshold - NEAR) & (kinds[:, None] > kinds[None, :])
            for i, j in np.argwhere(alike).tolist():
                a, b = top(held[i][1]), top(held[j][1])
                if a != b:
                    root[a] = b
                    out.append((max(held[i][0], held[j][0]), min(held[i][0], held[j][0])))
            return out

        for batch in batches:
            out = []
            for *at, node, kind, text in batch.itertuples(index=False, name=None):
                if at != now:
                    out.extend(joined())
                    now, held = at, []
                held.append((node, kind, text))
            yield pd.DataFrame(out, columns=["a", "b"])
        yield pd.DataFrame(joined(), columns=["a", "b"])

    dealt = dealt.repartition(n, *block).sortWithinPartitions(*block, "node")
    return dealt.select(*block, "node", "class", "text").mapInPandas(
        compare, "a string, b string").distinct()


def classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
            threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(rows, found): rows has doc_id and node (the text's MD5) of every
    document; found has node, rep (its least doc_id), class and class_id (the
    class's least doc_id) of every node."""
    spark = df.sparkSession
    docs = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.withColumn("node", F.md5("text"))
    signed = staged(docs.select("node", "doc_id"), "rows")
    # copies count once: no group of them is common by its size
    each = staged(docs.groupBy("node").agg(F.first("text").alias("text"), F.min("doc_id").alias("rep")),
                  "distinct-texts")
    shared = spark.sparkContext.broadcast(common_shingles(each, "text", max(1, each.count())))
    nodes = staged(each.select("node", "rep", _bands(shared)("text").alias("bands")), "nodes")
    members = staged(_members(nodes.select("node", F.posexplode("bands").alias("band", "key"))),
                     "members")
    texts = staged(each.select("node", "text").join(members.select("node").distinct(), "node"),
                   "texts")
    members = staged(_led(members), "led")
    tested = staged(_pairs(members), "pairs")
    found = components(_similar(tested, texts, shared, threshold))

    def joined_by(new: DataFrame) -> None:
        """The classes that more similar pairs make of those found."""
        nonlocal found
        if not new.isEmpty():
            found = staged(_merged(found, new), "classes")

    def led(members: DataFrame, turns: range) -> DataFrame:
        """What rounds of leaders leave of several classes, without the leaders."""
        nonlocal tested
        left = staged(_unsettled(members, found, turns[0]), "unsettled")
        for turn in turns:
            if left.isEmpty():
                break
            pairs = _pairs(left.filter("class <> lead_class"))
            pairs = staged(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
            tested = tested.unionByName(pairs)
            joined_by(staged(_similar(pairs, texts, shared, threshold), "similar"))
            left = staged(_unsettled(_followers(left), found, turn + 1), "unsettled")
        return left

    left = led(_followers(members), range(1, ROUNDS + 1))
    crowded = staged(_crowded(left), "crowded")
    if not crowded.isEmpty():
        among = texts.join(left.join(crowded, ["band", "key"]).select("node").distinct(), "node")
        fine = among.select("node", _bands(shared, FINE_BANDS, FINE_ROWS)("text").alias("bands"))
        finer = staged(_members(fine.select("node", F.posexplode("bands").alias("band", "key"))),
                       "members").withColumn("band", F.col("band") + BANDS)
        finest = led(finer, range(ROUNDS + 1, ROUNDS + FINE_ROUNDS + 1))
        rest = left.join(crowded, ["band", "key"], "left_anti").select("node", "band", "key")
        left = staged(_unsettled(rest.unionByName(finest.select(rest.columns)), found, 0), "unsettled")
    if not left.isEmpty():
        joined_by(staged(_blockwise(left, texts, shared, threshold), "similar"))
    named = nodes.select("node", "rep").join(found, "node", "left").withColumn(
        "class", F.coalesce("class", "node"))
    ids = named.groupBy("class").agg(F.min("rep").alias("class_id"))
    found = staged(named.join(ids, "class").select("node", "rep", "class", "class_id"), "classes")
    return signed, found


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class) and kept (whether it
    is that document) of every row."""
    rows, found = classes(df, doc_id, text, threshold)
    return rows.join(found, "node").select(
        "doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with one row of each class: that of the least doc_id (of rows
    with one id, that of the least text hash; of rows that share both, any)."""
    _, found = classes(df, doc_id, text, threshold)
    first = found.filter(F.col("rep").eqNullSafe(F.col("class_id"))).groupBy("class").agg(
        F.min("node").alias("node"), F.first("class_id").alias("class_id"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     F.col(doc_id).alias("doc_id"),
                     F.md5(F.coalesce(F.col(text), F.lit(""))).alias("node"))
    kept = rows.join(first.select("node", "class_id"), "node").filter(
        F.col("doc_id").eqNullSafe(F.col("class_id")))
    return kept.dropDuplicates(["node"]).select("row.*")
