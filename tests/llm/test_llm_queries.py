import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from runledger.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), compare.connect(sf_dir), ORACLE[name]) == []


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry_point.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry_point.queries() and "pipeline" not in entry_point.oracle_sql()


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf_dir)
        last = name == corpus_pipeline.STAGES[-1][0]
        assert after.columns[: len(docs.columns)] == docs.columns
        assert last or after.columns == docs.columns
        if name == "line_dedup":
            assert after.count() == before.count()
        else:
            assert 0 < after.count() <= before.count()
        if name == "ngram_jaccard_join":
            assert after.count() < docs.count()
        before = after
    assert before.agg(F.min("copies")).first()[0] >= 1


def test_stages_of_odd_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("_d", F.lit("mine"))
    odd = docs.limit(3).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("long").alias("n_chars"),
    )
    plain = docs.drop("_d")
    for name, stage in corpus_pipeline.STAGES:
        mixed = stage(spark, plain.limit(20).unionByName(odd).unionByName(plain.limit(5)), sf_dir)
        nulls = mixed.where(F.col("doc_id").isNull()).count()
        assert nulls == (0 if name == "source_mixing" else 3), name
        assert stage(spark, plain.limit(0), sf_dir).count() == 0, name


def test_stages_keep_clashing_columns(spark, sf_dir):
    names = ["_d", "_none", "_k", "_toxicity", "_dropped", "_copies", "own_d"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    docs = docs.withColumns({c: F.lit(f"mine{c}") for c in names})
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, sf_dir)
        assert found.columns[: len(docs.columns)] == docs.columns, name
        rows = found.select(names).distinct().collect()
        assert [tuple(r) for r in rows] == [tuple(f"mine{c}" for c in names)], name
