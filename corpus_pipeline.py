"""From raw documents to a training mix: each stage calls one operator on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import decontaminate, lines, mixing, quality, simhash
from quayside.llm.shared import reachable, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rated_well(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the rated ones among them, expects to be good.

    The text alone decides, so repeated rows go or stay together; a NULL text counts as empty. Without usable ratings
    every document stays. An empty table stays empty. Columns beyond ``COLUMNS`` end here.
    """
    reachable(spark)
    ratings = quality.ratings(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.graded(docs, quality.train(docs, ratings), keep_grade=2).where("keep").select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 25 words or more that occur earlier; ``n_chars`` follows an edited text.

    Earlier goes by ``doc_id``, NULL last, then by place. Repeated rows are edited alike. A NULL or empty text stays as it is;
    a text that is a copy throughout becomes empty, its row stays. An empty table stays empty.
    """
    edited = lines.dedup_lines(docs)
    return edited.selectExpr("doc_id", "text", "lang", "source", "IF(n_deleted > 0, CAST(length(text) AS BIGINT), n_chars) AS n_chars")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest ``doc_id``, of repeated rows one.

    NULL and empty texts are near-duplicates of each other. A row without id stays only if its group has no other. An empty
    table stays empty.
    """
    reachable(spark)
    return simhash.keep_one(docs, size=3, bits=3).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items, by the text alone.

    A NULL or empty text is not; without benchmark items no document is. Repeated rows go or stay together. An empty
    table stays empty.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contamination(docs, benchmark).where("NOT contaminated").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled documents, with topic, tokens and probability.

    A NULL source, language or topic (an id without vector or label) is a value like any other. A NULL or empty text has
    no tokens, which weighs nothing, and stays by its cell's probability. Whether a row stays follows from its id and
    text, so repeated rows agree. An empty table stays empty.
    """
    labelled = mixing.with_topic(docs, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    found = mixing.mix(labelled, {"source": 0.5, "lang": 0.7, "topic": 0.7})
    return found.where("sampled").select(*COLUMNS, "topic", "tokens", "probability")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", rated_well),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]

#: Training, connected components and proportional fitting are loops that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, each stage's result written to the shared folder and read again."""
    reachable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
