"""Reports over the usage tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions.expr import epoch_day, in_window, task_type
from runledger.operators.counts import window_counts
from runledger.operators.skew import BROADCAST_ROWS, SPLIT_ROWS, fits_broadcast, lookup
from runledger.operators.usage import join_clusters, match_keys, split_by_job
from runledger.schemas import NONE

CORE_HOUR_RATE = 0.006


def _labelled(label: str, counts: str) -> Column:
    return F.struct(F.lit(label).alias("label"), F.col(counts).alias("counts"))


# Labels of the audit: fixed values.
ALL_TASKS = "all runs tasks"
WITH_CLUSTER = "tasks with cluster definition"
WITHOUT_CLUSTER = "tasks with no cluster definition"
NOT_FOUND = "clusters we couldnt look up"


def coverage_audit(
    runs: DataFrame, with_cluster: DataFrame, without_cluster: DataFrame
) -> DataFrame:
    """Four labelled distinct counts: do the two cluster tables cover all run tasks?
    A (run, task) pair with a NULL part is not counted."""
    pair = F.countDistinct("run_id", "task_key")
    return (
        runs.agg(pair.alias("counts"))
        .select(F.lit(ALL_TASKS).alias("label"), "counts")
        .union(
            with_cluster.agg(pair.alias("counts")).select(
                F.lit(WITH_CLUSTER), "counts"
            )
        )
        .union(
            without_cluster.agg(
                pair.alias("tasks"), F.countDistinct("cluster_id").alias("clusters")
            ).select(
                F.inline(
                    F.array(
                        _labelled(WITHOUT_CLUSTER, "tasks"),
                        _labelled(NOT_FOUND, "clusters"),
                    )
                )
            )
        )
    )


def result_states(runs: DataFrame) -> DataFrame:
    """Task rows per result state of their run."""
    return runs.groupBy("run_result_state").agg(F.count(F.lit(1)).alias("counts"))


# The key of a job task is run name and task key put together without a separator; it is
# NULL, and so not counted, if either part is.
def _task_and_run_counts() -> tuple[Column, Column]:
    return (
        F.countDistinct(F.concat("run_name", "task_key")).alias("job_task_count"),
        F.countDistinct("run_id").alias("run_count"),
    )


# The same values as texts, in SQL, as the daily sets count them.
TASK_AND_RUN = {
    "job_task_count": "concat(run_name, task_key)", "run_count": "CAST(run_id AS STRING)"
}
JOBS_AND_RUNS = {"jobs": "run_name", "runs": "CAST(run_id AS STRING)"}


def pool_usage(
    runs: DataFrame,
    clusters: DataFrame,
    pools: DataFrame,
    match: str = "task",
    split_rows: int = SPLIT_ROWS,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Job tasks and runs per instance pool."""
    keys = match_keys(match)
    pooled = lookup(
        # Clusters without a pool are most, and match none.
        clusters.where(F.col("instance_pool_id") != NONE).select(*keys, "instance_pool_id").distinct(),
        pools.select("instance_pool_id", "instance_pool_name", "node_type_id").distinct(),
        "instance_pool_id",
        by=keys,
        how="inner",
        max_rows=max_rows,
        split_rows=split_rows,
    )
    pool = ["instance_pool_id", "instance_pool_name", "node_type_id"]
    return (
        join_clusters(
            runs.select("job_id", "run_id", "task_key", "run_name"), pooled, pool, match, split_rows
        )
        .groupBy(*pool)
        .agg(*_task_and_run_counts())
    )


def daily_usage(
    runs: DataFrame, clusters: DataFrame, match: str = "task", split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """Job tasks and runs per day, run type and kind of compute, in order of day."""
    run_rows = runs.select(
        "job_id", "run_id", "task_key", "run_name", "run_type",
        epoch_day("run_starttime").alias("day"),
    )
    return (
        join_clusters(run_rows, clusters, ["compute_definition"], match, split_rows)
        .groupBy("day", "run_type", "compute_definition")
        .agg(*_task_and_run_counts())
        .orderBy("day")
    )


def submit_groups(
    runs: DataFrame, clusters: DataFrame, match: str = "task", split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """Runs and jobs per day and kind of task, of tasks that have a cluster.

    Only the existence of a cluster matters to distinct counts, hence the semi join."""
    keys = match_keys(match)
    run_rows = runs.select(
        "job_id", "run_id", "task_key",
        epoch_day("run_starttime").alias("day"),
        task_type().alias("task_type"),
    )
    known = clusters.select(*keys).distinct()
    if match == "run":
        matched = run_rows.join(known, keys, "left_semi")
    else:
        matched = split_by_job(run_rows, known, split_rows, how="left_semi")
    return matched.groupBy("day", "task_type").agg(
        F.countDistinct("run_id").alias("distinct_run_ids"),
        F.countDistinct("job_id").alias("distinct_job_ids"),
    )


def annual_factor(days_back: int) -> int:
    """How often a window of ``days_back`` days fits into a year."""
    if days_back < 1:
        raise ValueError("days_back must be at least 1")
    return 365 // days_back


def usage_estimate(
    usage: DataFrame,
    start: dt.date,
    end: dt.date,
    days_back: int,
    rate: float = CORE_HOUR_RATE,
) -> DataFrame:
    """One row: what ran in ``[start, end)`` and what a year at that pace takes and costs.
    ``jobs`` counts run names. An empty window gives zero counts and NULL sums."""
    annual_factor(days_back)
    totals = usage.where(in_window("run_starttime", start, end)).agg(
        F.countDistinct("run_name").alias("jobs"),
        F.countDistinct("run_id").alias("runs"),
        _core_hours().cast("double").alias("total"),
    )
    return _estimate(totals, start, end, days_back, rate)


def _core_hours() -> Column:
    """Core-hours have two decimals; as decimals their sum is exact in whatever order the
    partial sums arrive."""
    return F.sum(F.col("core_hrs").cast("decimal(18,2)"))


def _estimate(
    totals: DataFrame, start: dt.date, end: dt.date, days_back: int, rate: float
) -> DataFrame:
    factor = annual_factor(days_back)
    return totals.select(
        F.lit(f"{start} - {end}").alias("period"),
        "jobs",
        "runs",
        F.round("total", 2).alias("core_hrs"),
        F.round(F.col("total") * factor, 2).alias("est_annual_core_hrs"),
        F.round(F.col("total") * factor * F.lit(float(rate)), 2).alias("est_annual_core_hr_cost"),
    )


def daily_core_hours(usage: DataFrame) -> DataFrame:
    """Core-hours of each ``day`` of usage rows, which belong to one day each."""
    return usage.groupBy("day").agg(_core_hours().alias("total"))


def estimate_from_days(
    partials: DataFrame,
    sums: DataFrame,
    start: dt.date,
    end: dt.date,
    days_back: int,
    rate: float = CORE_HOUR_RATE,
) -> DataFrame:
    """:func:`usage_estimate` of any window from the daily sets of ``JOBS_AND_RUNS`` and the
    daily core-hours; the runs are not read again."""
    inside = sums.where((F.col("day") >= F.lit(start)) & (F.col("day") < F.lit(end)))
    total = inside.agg(F.sum("total").cast("double").alias("total"))
    counted = window_counts(partials, [], list(JOBS_AND_RUNS), start, end)
    # One row each.
    return _estimate(counted.join(F.broadcast(total)), start, end, days_back, rate)


def instance_coverage(usage: DataFrame, instances: DataFrame) -> DataFrame:
    """Usage rows that :func:`dbu_usage` leaves out, per role and instance type that the
    catalogue does not list; NULL types are among them."""
    roles = F.array(
        *(
            F.struct(F.lit(role).alias("role"), F.col(f"{role}_node").alias("instance_type"))
            for role in ("driver", "worker")
        )
    )
    counted = (
        usage.select(F.explode(roles).alias("r"))
        .groupBy("r.role", "r.instance_type")
        .agg(F.count(F.lit(1)).alias("usage_rows"))
    )
    listed = instances.select("instance_type")
    listed = F.broadcast(listed) if fits_broadcast(listed) else listed
    return counted.join(listed, "instance_type", "left_anti").select(
        "role", "instance_type", "usage_rows"
    )


def dbu_usage(usage: DataFrame, instances: DataFrame, rate: float) -> DataFrame:
    """DBUs (dbus x hours x nodes) and their price per driver and worker type, of the usage
    rows whose instance types the catalogue lists."""
    small = fits_broadcast(instances)
    # Hours and DBUs are decimals, so the sums do not depend on the order of rows.
    hours = (F.col("duration_min") / 60).cast("decimal(18,6)")
    workers = F.when(
        F.col("node_provision_method") == "Autoscale", F.col("autoscale_max")
    ).otherwise(F.col("worker_nodes"))
    shapes = usage.groupBy("driver_node", "worker_node").agg(
        F.sum(hours).alias("driver_hours"), F.sum(hours * workers).alias("worker_hours")
    )
    for role in ("driver", "worker"):
        dbus = instances.select(
            F.col("instance_type").alias(f"{role}_node"),
            F.col("dbus").cast("decimal(10,2)").alias(f"{role}_dbus"),
        )
        shapes = shapes.join(F.broadcast(dbus) if small else dbus, f"{role}_node")
    # Rounded as decimals too: a half cent has no exact double.
    total = F.col("driver_hours") * F.col("driver_dbus") + F.col("worker_hours") * F.col(
        "worker_dbus"
    )
    return shapes.select(
        "driver_node",
        "worker_node",
        F.round(total, 2).cast("double").alias("dbus"),
        F.round(total * F.lit(Decimal(str(rate))), 2).cast("double").alias("dbu_cost"),
    )
