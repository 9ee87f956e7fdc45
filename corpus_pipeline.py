"""The corpus pipeline: five stages over the table of documents, each on all that its
predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a table with the columns of ``docs``; the last
adds how often each document is taken. Rows that are equal in id and text are one document to
the stages that drop or count documents, and NULL texts pass all filters until the mix, which
takes documents with words only. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm import toxicity
from runledger.llm.common import (
    KEY,
    attach,
    document_key,
    fold,
    read_table,
    set_apart,
    without_repeats,
    written,
)
from runledger.llm.decontamination import contamination
from runledger.llm.jaccard_join import one_of_each
from runledger.llm.line_dedup import dedup_lines
from runledger.llm.mixing import mix


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def own_columns(stage: Stage) -> Stage:
    """The stage for tables that have columns named like those it uses inside."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        docs, back = set_apart(docs)
        return stage(spark, docs, sf_dir).withColumnsRenamed(back)

    return run_stage


@own_columns
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not take for toxic."""
    network = toxicity.learn(docs, read_table(spark, sf_dir, "labels"), fold("_id", 5) != 0)
    scored = toxicity.toxicity(docs, network, score="_toxicity", predicted="_toxic")
    return scored.where(F.col("_toxic") == 0).select(docs.columns)


@own_columns
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier one; lengths follow the texts."""
    kept = dedup_lines(docs)
    if "n_chars" in docs.columns:
        shorter = F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
        kept = kept.withColumn("n_chars", F.coalesce(shorter, "n_chars"))
    return kept.select(docs.columns)


@own_columns
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


@own_columns
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a notable share of benchmark text."""
    found = contamination(docs, read_table(spark, sf_dir, "benchmark"))
    dirty = found.where("contaminated").select(*document_key("doc_id", "text_key")).distinct()
    keyed = docs.select("*", *document_key("doc_id", F.xxhash64("text")))
    return attach(keyed, written(dirty, "contaminated"), KEY, KEY, "left_anti").select(docs.columns)


@own_columns
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``copies``, ``taken`` (words) and ``place`` (words
    of the mix up to the first copy)."""
    mixed = mix(docs).select(*document_key("doc_id", "text_key"), "copies", "taken", "first_place")
    shares = written(
        mixed.where(F.col("copies") > 0).groupBy(KEY).agg(
            F.sum("copies").alias("_copies"), F.sum("taken").alias("_taken"),
            F.min("first_place").alias("_place"), F.count("*").alias("_n"),
        ),
        "shares",
    )
    keyed = docs.drop("copies", "taken", "place").select(
        "*", *document_key("doc_id", F.xxhash64("text"))
    )
    rows = without_repeats(keyed, shares.where("_n > 1").select(KEY))
    rows = attach(rows, shares.drop("_n"), KEY, KEY, "inner")
    renamed = {"_copies": "copies", "_taken": "taken", "_place": "place"}
    return rows.drop(*KEY).withColumnsRenamed(renamed)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
]

# Trained models, hashes and groups of links are not for SQL to express: see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
