"""Registered queries of the operators, and their oracle SQL where SQL can
express them. Each reads whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import (
    ann,
    bpe,
    fingerprint,
    html_extract,
    langid,
    lexical,
    mixing,
    near_dedup,
    quality,
    runs,
    toxicity,
    url_filter,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules, else by the vocabulary."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix of the sources takes."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from labelled documents."""
    return quality.learn_and_score(table(spark, sf_dir, "documents"),
                                   table(spark, sf_dir, "labels"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate class."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors found nearest to each whose id is divisible by 100."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.main_text(pages).drop("html")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, by a lexicon learned from labelled documents."""
    return toxicity.learn_and_score(table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "labels"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from two thirds of them."""
    found = langid.learn_and_predict(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score",
                        F.size("mixture").alias("n_languages"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's sketch beside its edited text's and its successor's."""
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty documents that rank highest for each benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written into WARC archives and read back."""
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs, a tenth of them with planted ones."""
    return runs.run_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_filter, op2_source_mix, op3_quality, op4_bpe, op5_near_duplicates,
        op6_nearest_neighbours, op7_html_extraction, op8_toxicity, op9_language_id,
        op10_fingerprints, op11_lexical_search, op12_warc, op13_periodic_runs)}

ORACLES: dict[str, str] = {
    "op1_url_filter": url_filter.oracle(),
    "op11_lexical_search": lexical.oracle(),
    "op12_warc": warc.oracle(),
}
