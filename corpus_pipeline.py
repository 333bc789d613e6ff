"""The corpus pipeline: documents that are toxic or of low quality go, one of
each group of near-duplicates stays, the sources are mixed to their target
weights, and the mix is encoded.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame;
all but the last return the columns of ``docs``. The classifiers learn from
the labelled documents among their input that aren't held out.

Cases, in every stage: null and empty texts are kept by the toxicity stage (they
match nothing) and judged by the quality stage's intercept, are near-duplicates
of each other only, add no words to a mix (which leaves them out) and have no
tokens; texts of any length are read whole; rows without an id are never taught
from, and otherwise treated as others; repeated rows get the same decision, and
one of them stays in the near-duplicate stage; of rows of a class that tie for
the least id that of the least text hash stays; an empty table, or one without
labels, gives an empty or unfiltered one; further columns are kept, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keelson.llm import bpe, mixing, near_dedup, quality, toxicity
from keelson.llm.text import staged, training_rows


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5 (one at the pivot scores 0.5 and goes)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    lexicon = toxicity.fit(training_rows(docs, labels, "toxic", 5, 0, toxicity.SAMPLE))
    return docs.filter(~toxicity.is_toxic(docs, lexicon))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more (all of them where nothing is labelled)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(training_rows(docs, labels, "quality", 3, 1, quality.SAMPLE))
    return docs.filter(quality.score_udf(docs, model)("text") >= 0.5)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that of the least id."""
    return near_dedup.keep_one(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as the mix takes it (0 to 3 times)."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the mixed documents, a row for each copy."""
    return bpe.encode_documents(docs)


STAGES = [
    ("toxicity", not_toxic),
    ("quality", good_quality),
    ("near-dedup", one_of_each),
    ("source mix", mixed_sources),
    ("bpe", encoded),
]

#: The classifiers, the sampling and the encoder are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage keeps is written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
