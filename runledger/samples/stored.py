"""Queries over tables that are stored first: buckets, refreshed days, daily sets."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.functions.expr import epoch_day, epoch_ms, task_type
from runledger.functions.fields import variant_field
from runledger.operators import counts, reports, usage, workload
from runledger.operators.skew import SPLIT_ROWS, TASK_ROWS
from runledger.plans.estimate import window_runs
from runledger.samples import orders
from runledger.sources.buckets import bucketed_usage, write_bucketed
from runledger.sources.scratch import scratch_path
from runledger.sources.tables import merge_runs, write_tables

BUCKETS = 8  # at least
# A first fetch of these days, of which the last ones' runs are still going, and a second one
# that looks back over those.
FETCHED_FROM, FETCHED_UNTIL, LOOK_BACK = dt.date(1998, 5, 1), dt.date(1998, 6, 1), 3
RANDOM_SEED = 11


def stored_run_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run usage over bucketed tables; a bucket has about ``TASK_ROWS`` tasks."""
    schema = f"buckets_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{scratch_path(spark, 'buckets')}'")
    tasks = orders.read(spark, sf_dir, "lineitem").count()
    write_bucketed(
        spark, orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir), schema,
        max(BUCKETS, -(-tasks // TASK_ROWS)),
    )
    return bucketed_usage(spark, schema, orders.sizes(spark))


def refreshed_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result states by day after a look-back was fetched again and merged: at first its runs
    were unfinished and every fifth was not listed."""
    since = FETCHED_UNTIL - dt.timedelta(days=LOOK_BACK)
    runs = window_runs(orders.runs(spark, sf_dir), FETCHED_FROM, FETCHED_UNTIL)
    late = F.col("run_starttime") >= epoch_ms(since)
    first = runs.where(~late | (F.col("run_id") % 5 != 0)).withColumn(
        "run_result_state", F.when(late, "PENDING").otherwise(F.col("run_result_state"))
    )
    path = scratch_path(spark, "refreshed")
    write_tables(spark, {"job_run_info": first}, path=path, runs_by_day=True)
    merged = merge_runs(spark, path, "job_run_info", runs.where(late), since)
    return merged.groupBy("run_day", "run_result_state").agg(F.count(F.lit(1)).alias("counts"))


def _numbers(spark: SparkSession, rows: DataFrame, measures: dict) -> dict[str, DataFrame]:
    return {
        name: counts.number_values(
            counts.first_days(rows, value), scratch_path(spark, f"numbers-{name}")
        )
        for name, value in measures.items()
    }


def _partials(spark: SparkSession, rows: DataFrame, dims: list[str], measures: dict) -> DataFrame:
    """Daily sets, stored as they would be from day to day."""
    partials = counts.daily_partials(rows, dims, measures, _numbers(spark, rows, measures))
    return counts.store_partials(partials, scratch_path(spark, "partials"))


def _daily_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.runs(spark, sf_dir).select(
        "job_id", "run_id", "task_key", "run_name", "run_type",
        epoch_day("run_starttime").alias(counts.DAY), task_type().alias("task_type"),
    )


def _stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written once: each measure reads them twice."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _daily_pairs(spark: SparkSession, sf_dir: str, column: str, known: str = "true") -> DataFrame:
    """Run tasks with the values of a cluster ``column`` that are ``known``."""
    clusters = orders.with_cluster(spark, sf_dir).where(known)
    pairs = usage.join_clusters(_daily_runs(spark, sf_dir), clusters, [column])
    return _stored(pairs.select(counts.DAY, "run_type", "run_name", "task_key", "run_id", column), "pairs")


def window_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job tasks and runs of a window by run type and kind of compute, from daily sets."""
    pairs = _daily_pairs(spark, sf_dir, "compute_definition")
    dims = ["run_type", "compute_definition"]
    partials = _partials(spark, pairs, dims, reports.TASK_AND_RUN)
    return counts.window_counts(partials, dims, list(reports.TASK_AND_RUN), *orders.WINDOW)


def window_pool_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job tasks and runs of a window by pool id, from daily sets."""
    pairs = _daily_pairs(spark, sf_dir, "instance_pool_id", "instance_pool_id <> 'None'")
    dims = ["instance_pool_id"]
    partials = _partials(spark, pairs, dims, reports.TASK_AND_RUN)
    return counts.window_counts(partials, dims, list(reports.TASK_AND_RUN), *orders.WINDOW)


def window_submits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs and jobs of a window by kind of task, from daily sets. Only that a task has a
    cluster matters."""
    known = orders.with_cluster(spark, sf_dir).select("job_id", "task_key").distinct()
    found = usage.split_by_job(_daily_runs(spark, sf_dir), known, SPLIT_ROWS, "left_semi")
    pairs = _stored(found.select(counts.DAY, "task_type", "run_id", "job_id"), "submits")
    measures = {
        "distinct_run_ids": "CAST(run_id AS STRING)", "distinct_job_ids": "CAST(job_id AS STRING)"
    }
    partials = _partials(spark, pairs, ["task_type"], measures)
    return counts.window_counts(partials, ["task_type"], list(measures), *orders.WINDOW)


def estimate_by_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The estimate of a window from daily sets and sums."""
    rows = usage.run_usage(
        orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir), orders.sizes(spark), "run"
    ).withColumn(counts.DAY, epoch_day("run_starttime"))
    path = scratch_path(spark, "usage")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    partials = _partials(spark, rows, [], reports.JOBS_AND_RUNS)
    start, end = orders.WINDOW
    return reports.estimate_from_days(
        partials, reports.daily_core_hours(rows), start, end, (end - start).days
    )


def random_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three random columns beside every line, from its order key."""
    lines = orders.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return workload.random_columns(lines, 3, RANDOM_SEED, row_id="l_orderkey")


def wide_random_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many rows of random columns as there are orders."""
    n = orders.read(spark, sf_dir, "orders").count()
    return workload.wide_random(spark, n, 3, RANDOM_SEED)


def xor_series_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expensive function called by name in SQL text."""
    workload.register_xor_series(spark, "complex_operation", 1000)
    lines = orders.read(spark, sf_dir, "lineitem")
    return spark.sql(
        "SELECT l_orderkey, l_linenumber, bucket, round(complex_operation(bucket), 6) AS"
        " factorial_value FROM (SELECT l_orderkey, l_linenumber,"
        " CAST(floor(l_quantity / 5) AS INT) AS bucket FROM {lines})",
        lines=lines,
    )


def unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of records whose shape differs from row to row and is in no schema."""
    text = F.expr(
        "'{\"run_id\":' || o_orderkey || ',\"extra\":{' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE"
        " '\"owner\":\"u' || o_custkey || '\",' END || '\"level\":' || CASE WHEN o_orderkey % 4 = 0"
        " THEN '\"high\"' ELSE CAST(o_orderkey % 9 AS STRING) END || '},\"tags\":[' ||"
        " CASE WHEN o_orderkey % 2 = 0 THEN '{\"k\":\"a\"}' ELSE '' END || ']}'"
    )
    records = orders.read(spark, sf_dir, "orders").select(F.parse_json(text).alias("record"))
    return records.select(
        variant_field("record", "run_id", 0).alias("run_id"),
        variant_field("record", "extra.owner", "None").alias("owner"),
        variant_field("record", "extra.level", 0).alias("level"),
        variant_field("record", "tags[0].k").alias("tag"),
        variant_field("record", "extra").alias("extra"),
    )


STORED_QUERIES = {
    f.__name__: f
    for f in (
        stored_run_usage, refreshed_states, window_usage, window_pool_usage, window_submits,
        estimate_by_days, random_lines, wide_random_rows, xor_series_sql, unknown_fields,
    )
}
