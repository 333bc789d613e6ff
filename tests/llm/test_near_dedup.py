import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import near_dedup as N
from tests.conftest import SF_CHECK
from tests.llm.helpers import awkward, empty

NONE = (np.empty(0, dtype=np.uint64), np.empty(0))


def text_of(words, rng, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def corpus(seed=3, groups=25, each=6):
    """Groups of edited copies, from nearly equal to too different."""
    rng, out = random.Random(seed), []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([30, 120, 400]))]
        out += [text_of(base, rng, rng.choice([0, 1, 2, 4])) for _ in range(each)]
        out.append(" ".join(base[:6]) + f" other {rng.random()}")
    return out


def brute_classes(texts, similarity):
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if texts[i] == texts[j] or similarity(i, j) >= N.THRESHOLD - N.NEAR:
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(texts))]


def test_classes_against_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    common = N.common_shingles(df, "text", len(texts))
    sampler = N.Sampler(common)
    weighted = [sampler.weighted(t) for t in texts]
    wanted = brute_classes(texts, lambda i, j: N.weighted_jaccard(weighted[i], weighted[j]))
    rows = {r["doc_id"]: r for r in N.near_duplicates(df).collect()}
    assert [rows[i]["class_id"] for i in range(len(texts))] == wanted
    assert {i for i, r in rows.items() if r["kept"]} == set(wanted)
    kept = N.keep_one(df).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(wanted))


def test_a_large_group_at_the_threshold_is_compared_completely(spark, monkeypatch):
    monkeypatch.setattr(N, "CHUNK", 30)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    texts = [text_of(base, rng, rng.choice([1, 2, 3])) for _ in range(160)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sampler = N.Sampler(N.common_shingles(df, "text", len(texts)))
    weighted = [sampler.weighted(t) for t in texts]
    wanted = brute_classes(texts, lambda i, j: N.weighted_jaccard(weighted[i], weighted[j]))
    rows = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(df).collect()}
    lost = [i for i in range(len(texts)) if rows[i] != wanted[i]]
    assert len(lost) <= 2  # a pair at the threshold may share no band


def test_common_shingles_are_exact(spark):
    rng = random.Random(5)
    line = "this line stands in many of the documents here"
    texts = [" ".join(f"x{rng.randrange(10**6)}" for _ in range(30)) + (f" {line}" if i % 4 == 0 else "")
             for i in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    hashes, idf = N.common_shingles(df, "text", 400, buckets=256)
    sampler = N.Sampler(NONE)
    wanted = np.unique(sampler.shingles(line))
    assert np.array_equal(hashes, wanted) and np.allclose(idf, np.log(4))


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    sampler = N.Sampler(NONE, bands=400, rows=1)
    hashes = np.sort(rng.integers(0, 2**63, 300).astype(np.uint64))
    for overlap in (0.3, 0.8):
        wa, wb = rng.exponential(2, 300) + 0.1, None
        wb = np.where(rng.random(300) < overlap, wa, rng.exponential(2, 300) + 0.1)
        a, b = (hashes, wa), (hashes[40:], wb[40:])
        same = np.mean(sampler.samples(*a) == sampler.samples(*b))
        assert same == pytest.approx(N.weighted_jaccard(a, b), abs=0.09)


def test_blocks_agree_with_pairs():
    sampler = N.Sampler(NONE)
    texts = corpus(groups=4) + ["a a a a a a a a b b b", "a a a a a a a b b b b", ""]
    found = N.block_similarities([sampler.units(t) for t in texts])
    for i, j in itertools.combinations(range(len(texts)), 2):
        wanted = N.weighted_jaccard(sampler.weighted(texts[i]), sampler.weighted(texts[j]))
        assert found[i, j] == pytest.approx(wanted, abs=1e-9)


@pytest.mark.parametrize("edges", [
    [("b", "a"), ("c", "b"), ("d", "c"), ("e", "d"), ("f", "e")],
    [("z", "a"), ("z", "b"), ("z", "c"), ("q", "p")], [("a", "a")], []])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a string, b string")
    got = {r["node"]: r["class"] for r in N.components(df).collect()}
    root = {}
    for a, b in edges * 6:
        if a != b:
            low = min(root.get(a, a), root.get(b, b))
            root[a] = root[b] = low
    assert got == root


def test_awkward_rows(spark):
    rows = N.near_duplicates(awkward(spark)).collect()
    assert len(rows) == 9
    ids = {r["doc_id"]: r["class_id"] for r in rows if r["doc_id"] is not None}
    assert ids[1] == 1 and ids[2] == ids[3] == 2 and ids[4] == 4 and ids[5] == 5
    out = N.keep_one(awkward(spark).withColumn("node", F.lit(1)).withColumn("class", F.lit(2)))
    assert out.columns[-2:] == ["node", "class"]
    assert sorted(r["doc_id"] or -1 for r in out.collect()) == [-1, 1, 2, 4, 5, 6]
    assert N.near_duplicates(empty(spark)).count() == 0 and N.keep_one(empty(spark)).count() == 0


def test_a_repeated_line_does_not_join_texts(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"x{rng.randrange(10**6)}" for _ in range(150)) + " be so. all of it." * 60)
            for i in range(30)]
    out = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.select("class_id").distinct().count() == 30


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    out = N.near_duplicates(docs)
    joined = out.join(docs.select("doc_id", F.md5("text").alias("m")), "doc_id")
    assert joined.groupBy("m").agg(F.count_distinct("class_id").alias("n")).filter("n > 1").isEmpty()
    assert out.filter("kept").count() == out.select("class_id").distinct().count()


@pytest.mark.parametrize("copies", [True, False])
def test_a_large_group_keeps_its_near_copies(spark, copies):
    """A third of the rows are one group: copies of a text, or edits of it."""
    rng = random.Random(17)
    base = [f"w{i}" for i in range(300)]

    def edited(n):  # n words, far apart
        at = rng.sample(range(5, 295, 6), n)
        return " ".join(f"new{rng.randrange(10**9)}" if i in at else w for i, w in enumerate(base))

    near = [edited(n) for n in (3, 4, 5, 6)]  # against the base 0.90, 0.87, 0.84, 0.81
    group = [" ".join(base)] * 100 if copies else [" ".join(base)] + [edited(6) for _ in range(99)]
    texts = group + near + [text_of([f"x{rng.randrange(10**6)}" for _ in range(60)], rng, 0)
                            for _ in range(200)]
    sets = [set(N.Sampler(NONE).shingles(t).tolist()) for t in texts]
    plain = [len(sets[0] & s) / len(sets[0] | s) for s in sets[100:104]]
    assert all(0.8 <= p <= 0.92 for p in plain)
    wanted = brute_classes(texts, lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(df).collect()}
    assert [rows[i] for i in range(len(texts))] == wanted


def test_block_parts_agree_where_weights_differ():
    rng = random.Random(4)
    line = [f"c{i}" for i in range(40)]
    texts = [" ".join(line[:n] + [f"y{rng.randrange(10**6)}" for _ in range(40 - n)])
             for n in (0, 10, 20, 24, 30, 40) for _ in range(3)]
    common = np.unique(N.Sampler(NONE).shingles(" ".join(line)))
    sampler = N.Sampler((common, np.full(len(common), 1.7)))
    found = N.block_similarities([sampler.units(t) for t in texts])
    for i, j in itertools.combinations(range(len(texts)), 2):
        wanted = N.weighted_jaccard(sampler.weighted(texts[i]), sampler.weighted(texts[j]))
        assert found[i, j] == pytest.approx(wanted, abs=1e-9)


def test_a_crowded_band_is_parted_by_finer_bands(spark, monkeypatch):
    """Texts that share two thirds of their words fill bands together; near
    copies among them are found without comparing all of a band."""
    monkeypatch.setattr(N, "CHUNK", 20)
    monkeypatch.setattr(N, "CROWD", 20)
    rng = random.Random(12)
    words = [f"w{i}" for i in range(5000)]
    shared = rng.sample(words, 90)
    rows = []
    for i in range(160):
        text = shared + rng.sample(words, 30)
        rows.append((i, " ".join(text)))
        if i % 8 == 0:  # a near copy: one word of the own part is another
            text[100] = "else"
            rows.append((1000 + i, " ".join(text)))
    seen = {"_crowded": [], "_blockwise": []}

    def watch(name):
        own = getattr(N, name)

        def watched(left, *rest):
            seen[name].append(left.groupBy("band", "key").count().agg(F.max("count")).first()[0])
            return own(left, *rest)
        monkeypatch.setattr(N, name, watched)

    watch("_crowded")
    watch("_blockwise")
    found = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert seen["_crowded"][0] > 50  # there were such bands
    assert all(n < 0.7 * seen["_crowded"][0] for n in seen["_blockwise"])
    for i in range(160):
        assert found[i] == i and (i % 8 or found[1000 + i] == i)


def test_unit_samples_agree_as_often_as_texts_are_alike():
    """The samples of parts against the exact similarity: repeated shingles, common ones, a long text."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(300)}" for _ in range(900)] + ["a b c d e f"] * 30
    other = [f"z{i}" if i < 900 and i % 40 == 0 else w for i, w in enumerate(base)] + ["a b c d e f"] * 20
    texts = [" ".join(base), " ".join(other)]
    common = np.unique(N.Sampler(NONE).shingles(" ".join(base[:300])))
    for shared in (NONE, (common, np.full(len(common), 1.7))):
        sampler = N.Sampler(shared, bands=1000, rows=1)
        a, b = (sampler.units(t) for t in texts)
        wanted = N.weighted_jaccard(*(sampler.weighted(t) for t in texts))
        assert 0.6 < wanted < 0.9
        same = np.mean(sampler.unit_samples(*a) == sampler.unit_samples(*b))
        assert same == pytest.approx(wanted, abs=0.06)
        turned = np.random.default_rng(0).permutation(len(a[0]))
        assert np.array_equal(sampler.unit_samples(*a), sampler.unit_samples(a[0][turned], a[1][turned]))


def test_stars_take_no_further_step(spark, monkeypatch):
    steps, own = [], N.staged
    monkeypatch.setattr(N, "staged", lambda df, name: steps.append(name) or own(df, name))
    edges = [("b", "a"), ("c", "a"), ("c", "a"), ("e", "d"), ("f", "d")]
    df = spark.createDataFrame(edges[:2] + edges[3:], "a string, b string")
    found = sorted((r["node"], r["class"]) for r in N.components(df).collect())
    assert found == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "d"), ("f", "d")]
    assert steps.count("edges") == 1
    again = N.components(spark.createDataFrame(edges, "a string, b string"))
    assert sorted((r["node"], r["class"]) for r in again.collect()) == found


def test_leaders_are_not_compared_again(spark, monkeypatch):
    """Pairs of texts under the threshold share bands of two; their leader was
    compared with the other, so no block is left."""
    rng = random.Random(21)
    texts = []
    for _ in range(40):
        base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        texts += [" ".join(base), " ".join(base[:70] + [f"v{rng.randrange(10**6)}" for _ in range(30)])]
    given, members, blocks, own = [], [], N._blockwise, N._members
    monkeypatch.setattr(N, "_blockwise",
                        lambda left, *rest: given.append(left.count()) or blocks(left, *rest))
    monkeypatch.setattr(N, "_members", lambda df: members.append(own(df).count()) or own(df))
    out = N.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert out.filter("kept").count() == 80
    assert members[0] > 20 and not given


def test_words_of_any_white_space():
    """The words of a text are those of str.split, whatever parts them."""
    from keelson.llm.text import word_hashes
    spaces = "".join(c for c in map(chr, range(0x110000)) if c.isspace())
    words = ["Über", "漢字", "a\u200bb", "x"]
    wanted = [word_hashes(w).tolist() for w in words * len(spaces)]
    assert all(len(w) == 1 for w in wanted)
    text = "".join(space + word for space in spaces for word in words)
    assert word_hashes(text).tolist() == [w[0] for w in wanted]
    assert word_hashes(text + " ", block=16).tolist() == [w[0] for w in wanted]
