"""Mixing sources to target weights by Pareto order sampling.

Each source has a weight and so a share of all words; a share stops at
``max_repeats`` times the source's words, and what is over is shared among
the others by weight. A source that needs m times its words takes
floor(m) certain whole copies of each document, and the rest, R words, by an
order sample: every document has an inclusion probability p proportional to
its size, such that R words are expected (p = size * R / sum of size squared;
while that is 1 or more for the longest, those are certain, and the others'
follows from what they leave of R), and a random number u from its hashed id;
documents come, after the certain ones, in the order of

    (u / (1 - u)) / (p / (1 - p))

the odds of u divided by the odds of p, and the sample is the longest
beginning of that order within R words, and one closing document: of those
left, the one that brings the words nearest to R, if any does. Of rows equal
in id and text, which have one place, as many as fit are taken.

Only DataFrame functions are used. No source is gathered in one task: the
place where the sample ends is found from sums over narrow steps of the
order (at most ``STEPS`` a source), and only the documents of the one step
that holds the end are put in order, by source. What is left is a comparison
of each document with its source's last place. Equal rows of which only some
are taken are dealt into ``SPREAD`` buckets by row number and counted off
bucket by bucket, so however many they are, no task has them all.

Cases: a null source is a source (the last), a null text has size 0 and is
taken 0 words; a source without words has target 0. Texts of any length are
counted whole; a document longer than what its source still needs is taken only
if it closes the sample best. Null ids are hashed like an id of their own. Empty
tables give empty tables. Sources are a bounded number (a row for each is ordered
in one task and broadcast): tens or thousands, not a column of addresses.
``plan_mix`` reads the three named columns only; ``mixed`` returns the
input's columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.text import staged

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
STEPS = 1 << 14
SPREAD = 1 << 12
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)).cast("long"), F.lit(0).cast("long"))


def _uniform(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) from the hashed id."""
    return (F.pmod(F.xxhash64(F.lit(seed), doc_id.cast("string")), F.lit(1 << 52)) + 0.5) \
        / float(1 << 52)


def _targets(sizes: DataFrame, weights, max_repeats: int) -> DataFrame:
    """source, source_size, squares -> the same with target.

    A row for each source is all that is ordered here, never documents. The
    sources whose share is cut off are the first by limit / weight: with
    those before it cut off, a source is cut off too if its limit is under
    its share of what they leave."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn(
        "limit", F.col("source_size") * float(max_repeats))
    everything = Window.partitionBy(F.lit(0))
    first = everything.orderBy(F.col("limit") / F.col("weight"),
                               F.col("source").asc_nulls_last())
    before = first.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(first.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("each", left / weights_left)
    # what is offered for each unit of weight rises as sources are cut off, and
    # falls from the first that isn't: the highest is what that one and all after it get
    level = F.max("each").over(everything)
    return rows.select(
        "source", "source_size", "squares",
        F.least("limit", level * F.col("weight")).alias("target"))


def _inclusion(counts: DataFrame, plan: DataFrame) -> DataFrame:
    """s, certain (documents of that size and longer are; null: none is) and
    per_word (the other documents' inclusion probability by size), for the
    sources with a rest. ``counts`` has a row for each source and size, far
    fewer than documents: d different sizes take d * d / 2 words at least.

    A size is certain if it is with all longer ones taken off; if one isn't,
    no smaller one is."""
    chosen = plan.filter(F.col("rest") > 0).select(
        F.col("source").alias("s"), "source_size", "rest")
    up_to = Window.partitionBy("s").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    left = F.col("rest") - (F.col("source_size") - F.sum(F.col("size") * F.col("rows")).over(up_to))
    found = (counts.filter(F.col("size") > 0)
             .join(chosen, F.col("source").eqNullSafe(F.col("s")))
             .select("s", "size", (left / F.sum(_squares()).over(up_to).cast("double"))
                     .alias("per_word")))
    certain = F.col("size") * F.col("per_word") >= 1
    return found.groupBy("s").agg(
        F.min(F.when(certain, F.col("size"))).alias("certain"),
        F.max(F.when(~certain, F.struct("size", "per_word")))["per_word"].alias("per_word"))


def _squares() -> Column:
    """Of a row of counts; whole numbers, so that sums don't depend on their order."""
    return (F.col("size") * F.col("size")).cast("decimal(20,0)") * F.col("rows").cast("decimal(17,0)")


def _place(doc_id: Column, size: Column, seed: int) -> Column:
    """The odds of u over the odds of p, mapped to [0, 1] in their order; 1 for
    p = 0, and -1 for certain documents."""
    u = _uniform(doc_id, seed)
    p = F.least(F.lit(1.0), F.coalesce(size * F.col("per_word"), F.lit(0.0)))
    ratio = u * (1 - p)
    return (F.when(size >= F.col("certain"), F.lit(-1.0))
            .when(p > 0, ratio / (ratio + (1 - u) * p)).otherwise(F.lit(1.0)))


def _sizes(df: DataFrame, doc_id: str, text: str, source: str, *more: Column) -> DataFrame:
    """doc_id, source, size and tie (one for rows equal in id and text), and more."""
    return df.select(
        *more, F.col(source).cast("string").alias("source"), F.col(doc_id).alias("doc_id"),
        word_count(F.col(text)).alias("size"),
        F.xxhash64(F.col(text), F.col(doc_id).cast("string")).alias("tie"))


def plan_mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 20) -> DataFrame:
    """source, source_size, target, copies (certain whole ones), rest, squares,
    certain and per_word (see ``_inclusion``), last_place and last_tie (where the source's sample ends; null: there is
    none), part_place, part_tie and part_rows (equal rows after that, of which
    only so many fit), closing_place, closing_tie and closing_rows (its closing
    document, and how many rows are equal to it). One row for each source. The
    text is read once; the sizes are staged in the shared folder."""
    return _plan(staged(_sizes(df, doc_id, text, source), "mix-sizes"), weights, max_repeats, seed)


def _plan(docs: DataFrame, weights, max_repeats: int, seed: int) -> DataFrame:
    """``plan_mix`` from the sizes."""
    counts = staged(docs.groupBy("source", "size").agg(F.count(F.lit(1)).alias("rows")), "mix-counts")
    sizes = counts.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"),
        F.sum(_squares()).cast("double").alias("squares"))
    repeats = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = staged(
        _targets(sizes, weights, max_repeats)
        .withColumn("copies", F.floor(repeats + 1e-12).cast("long"))
        .withColumn("rest", F.greatest(F.lit(0.0),
                                       F.col("target") - F.col("copies") * F.col("source_size"))),
        "mix-shares")
    odds = _inclusion(counts, plan)
    plan = staged(plan.join(odds, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "mix-plan")
    chosen = plan.filter(F.col("rest") > 0).select(
        F.col("source").alias("s"), "rest", "certain", "per_word")
    placed = (docs.filter(F.col("size") > 0)
              .join(chosen, F.col("source").eqNullSafe(F.col("s")))
              .select("s", "rest", "size", "tie",
                      _place(F.col("doc_id"), F.col("size"), seed).alias("place"))
              .withColumn("step", F.floor(F.col("place") * STEPS)))
    by_step = placed.groupBy("s", "step").agg(F.sum("size").alias("n"), F.first("rest").alias("rest"))
    in_order = Window.partitionBy("s").orderBy("step")
    reached = F.sum("n").over(in_order)
    # the first step at whose end the words exceed the rest holds the end; the
    # certain documents, a step of their own, don't exceed it
    ends = (by_step.withColumn("reached", reached)
            .filter((F.col("reached") > F.col("rest"))
                    & (F.col("reached") - F.col("n") <= F.col("rest")))
            .select(F.col("s").alias("es"), F.col("step").alias("end_step"),
                    (F.col("reached") - F.col("n")).alias("passed")))
    last = (placed.join(ends, F.col("s").eqNullSafe(F.col("es")) & (F.col("step") == F.col("end_step")))
            .groupBy("s", "place", "tie").agg(  # rows that go together
                F.sum("size").alias("n"), F.first("size").alias("size"), F.first("rest").alias("rest"),
                F.first("passed").alias("passed")))
    order = Window.partitionBy("s").orderBy("place", "tie")
    total = F.col("passed") + F.sum("n").over(order)
    fits = F.col("total") <= F.col("rest")
    within = last.withColumn("total", total).groupBy("s").agg(
        F.max(F.when(fits, F.struct("place", "tie", "total"))).alias("end"),
        # the first equal rows that don't all fit
        F.min(F.when(~fits, F.struct("place", "tie", "size", F.floor(
            (F.col("rest") - F.col("total") + F.col("n")) / F.col("size")).cast("long").alias("rows"))))
        .alias("part"))
    # no document of the step may fit: then the sample ends before it
    lasts = ends.join(within, F.col("es").eqNullSafe(F.col("s")), "left").select(
        F.col("es").alias("ls"),
        F.coalesce("end.place", F.col("end_step") / STEPS).alias("last_place"),
        F.col("end.tie").alias("last_tie"),
        *(F.when(F.col("part.rows") > 0, F.col(f"part.{c}")).alias(f"part_{c}")
          for c in ("place", "tie", "rows")),
        (F.coalesce("end.total", "passed") + F.coalesce(
            F.col("part.rows") * F.col("part.size"), F.lit(0))).alias("words"))
    lasts = staged(lasts, "mix-lasts")
    # of what is left, the document that brings the words nearest to the rest
    gap = F.col("rest") - F.col("words")
    left = placed.join(lasts, F.col("s").eqNullSafe(F.col("ls"))).filter(~_in_sample())
    closing = left.filter(F.abs(F.col("size") - gap) < gap).groupBy("s").agg(
        F.min(F.struct(F.abs(F.col("size") - gap).alias("off"), "place", "tie")).alias("c")).select(
        F.col("s").alias("cs"), F.col("c.place").alias("closing_place"),
        F.col("c.tie").alias("closing_tie"))
    closing = staged(closing, "mix-closing")
    equal = (placed.join(F.broadcast(closing), F.col("s").eqNullSafe(F.col("cs"))  # a row a source
                         & (F.col("place") == F.col("closing_place"))
                         & (F.col("tie") == F.col("closing_tie")))
             .groupBy(F.col("s").alias("qs")).agg(F.count(F.lit(1)).alias("closing_rows")))
    closing = closing.join(equal, F.col("cs").eqNullSafe(F.col("qs")), "left")
    found = (plan.join(lasts, F.col("source").eqNullSafe(F.col("ls")), "left")
             .join(closing, F.col("source").eqNullSafe(F.col("cs")), "left"))
    return staged(found.drop("ls", "cs", "qs", "words"), "mix-ends")


def _in_sample() -> Column:
    """Whether a document stands before the end of its source's sample."""
    return (F.col("place") < F.col("last_place")) | F.coalesce(
        (F.col("place") == F.col("last_place")) & (F.col("tie") <= F.col("last_tie")), F.lit(False))


def _with_times(docs: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``docs`` (doc_id, source, size, tie) beside its source's row of the
    plan, with how often each document is taken."""
    found = docs.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    found = found.withColumn("place", _place(F.col("doc_id"), F.col("size"), seed))
    closes = F.coalesce((F.col("place") == F.col("closing_place"))
                        & (F.col("tie") == F.col("closing_tie")), F.lit(False))
    parts = F.coalesce((F.col("place") == F.col("part_place"))
                       & (F.col("tie") == F.col("part_tie")), F.lit(False))
    sampled = (F.col("size") > 0) & F.col("last_place").isNotNull()
    drawn = sampled & (parts | (closes & (F.col("closing_rows") > 1)))
    extra = sampled & (_in_sample() | closes)
    if plan.filter((F.col("part_rows") > 0) | (F.col("closing_rows") > 1)).isEmpty():
        return found.withColumn("times", F.col("copies") + extra.cast("long"))
    alone = found.filter(~drawn).withColumn("times", F.col("copies") + extra.cast("long"))
    quota = F.when(parts, F.col("part_rows")).otherwise(0) + closes.cast("long")
    some = staged(found.filter(drawn).withColumn("quota", quota).withColumn(
        "spread", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SPREAD))), "mix-drawn")
    same = ["s", "place", "tie"]
    counts = some.groupBy(*same, "spread").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*same).orderBy("spread").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(  # SPREAD rows for each of a source's two groups at most
        F.col("s").alias("bs"), F.col("place").alias("bp"), F.col("tie").alias("bt"),
        F.col("spread").alias("bucket"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy(*same, "spread").orderBy(F.lit(0)))
    some = (some.withColumn("number", number)
            .join(F.broadcast(counts), F.col("s").eqNullSafe(F.col("bs")) & (F.col("place") == F.col("bp"))
                  & (F.col("tie") == F.col("bt")) & (F.col("spread") == F.col("bucket")))
            .withColumn("times", F.col("copies") + (
                F.col("before") + F.col("number") <= F.col("quota")).cast("long")))
    return alone.unionByName(some.select(*alone.columns))


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 20) -> DataFrame:
    """doc_id, source, size, source_size, target, times and taken of every document."""
    docs = staged(_sizes(df, doc_id, text, source), "mix-sizes")
    plan = _plan(docs, weights, max_repeats, seed)
    return (_with_times(docs, plan, seed)
            .select("doc_id", "source", "size", "source_size", "target", "times",
                    (F.col("times") * F.col("size")).alias("taken")))


def mixed(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 20) -> DataFrame:
    """``df``'s rows, each as often as the mix takes it (documents without
    words add none to a mix and are left out of it)."""
    plan = plan_mix(df, doc_id, text, source, weights, max_repeats, seed)
    docs = _sizes(df, doc_id, text, source,
                  F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    found = _with_times(docs, plan, seed).filter((F.col("size") > 0) & (F.col("times") > 0))
    return (found.select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
            .select("row.*"))
