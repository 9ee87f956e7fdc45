"""Run and cluster tables bucketed by task, so that the daily join needs no shuffle.

Rows are dealt to buckets by (job, task) when they are stored, once; joins by these keys then
read bucket by bucket. A job with many rows would fill one bucket, so the rows of such jobs are
stored apart, as are rows without a key, which match nothing. Only jobs apart go through the
join that splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.operators.skew import SPLIT_ROWS, fits_broadcast, hot_keys
from runledger.operators.usage import MATCH_KEYS, run_usage

KEYS = MATCH_KEYS["task"]
TABLES = ("job_run_info", "job_run_cluster_info")
APART = "_apart"


def write_bucketed(
    spark: SparkSession,
    runs: DataFrame,
    clusters: DataFrame,
    schema: str,
    buckets: int,
    split_rows: int = SPLIT_ROWS,
) -> None:
    """Store both tables in ``schema``, each as bucketed rows and rows apart. A job is kept
    apart if either table has more than ``split_rows`` rows of it. ``buckets`` should leave
    about a partition's worth of rows in each."""
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    large = [hot_keys(df, ["job_id"], split_rows).select("job_id") for df in (runs, clusters)]
    hot = large[0].union(large[1]).distinct().withColumn("_hot", F.lit(True))
    hot = F.broadcast(hot) if fits_broadcast(hot) else hot
    for name, df in zip(TABLES, (runs, clusters), strict=True):
        marked = df.join(hot, "job_id", "left")
        apart = F.col("_hot").isNotNull() | F.col("job_id").isNull() | F.col("task_key").isNull()
        rows = marked.where(~apart).select(*df.columns)
        rows.repartition(buckets, *KEYS).write.mode("overwrite").format("parquet").bucketBy(
            buckets, *KEYS
        ).sortBy(*KEYS).saveAsTable(f"`{schema}`.`{name}`")
        marked.where(apart).select(*df.columns).write.mode("overwrite").format(
            "parquet"
        ).saveAsTable(f"`{schema}`.`{name}{APART}`")


def read_bucketed(spark: SparkSession, schema: str) -> dict[str, DataFrame]:
    """Both tables whole, and under names that end in ``_apart`` the rows kept apart."""
    out = {}
    for name in TABLES:
        apart = spark.table(f"`{schema}`.`{name}{APART}`")
        out[name] = spark.table(f"`{schema}`.`{name}`").unionByName(apart)
        out[name + APART] = apart
    return out


def bucketed_usage(
    spark: SparkSession,
    schema: str,
    sizes: DataFrame,
    match: str = "task",
    normalize_size: bool = False,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Run usage over the stored tables: equal to that over the tables as they were given. No
    job has rows in both parts, so neither have the results."""
    runs, clusters = (spark.table(f"`{schema}`.`{name}`") for name in TABLES)
    stored = run_usage(runs, clusters, sizes, match, normalize_size, split_rows=None)
    runs, clusters = (spark.table(f"`{schema}`.`{name}{APART}`") for name in TABLES)
    return stored.unionByName(run_usage(runs, clusters, sizes, match, normalize_size, split_rows))
