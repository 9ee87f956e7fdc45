"""The main question end to end: what did the jobs of a window use, and what is that a year?"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions.expr import epoch_ms, in_window
from runledger.operators.normalize import (
    normalize_clusters,
    normalize_jobs,
    normalize_pools,
    normalize_runs,
    scan_runs,
)
from runledger.operators.reports import CORE_HOUR_RATE, usage_estimate
from runledger.operators.resolve import resolve_tasks
from runledger.operators.skew import SPLIT_ROWS, lookup
from runledger.operators.usage import run_usage
from runledger.sources.tables import RUN_DAY


def window_runs(runs: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Run rows of ``[start, end)``; also by partition, if the table is stored by day."""
    inside = in_window("run_starttime", start, end)
    if RUN_DAY in runs.columns:
        inside &= _stored_days(start, end)
    return runs.where(inside)


def _stored_days(start: dt.date, end: dt.date) -> Column:
    return (F.col(RUN_DAY) >= F.lit(start)) & (F.col(RUN_DAY) < F.lit(end))


def window_clusters(
    clusters: DataFrame, runs: DataFrame, start: dt.date, end: dt.date,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Cluster rows of the runs of ``[start, end)``: by partition if the table is stored by day,
    by the start of the run if it has that, else by run id. A run borrows shapes only of runs of
    its own period."""
    if RUN_DAY in clusters.columns:
        return clusters.where(_stored_days(start, end))
    if "run_starttime" in clusters.columns:
        return clusters.where(in_window("run_starttime", start, end))
    ids = window_runs(runs, start, end).select("run_id").distinct()
    return lookup(
        clusters, ids, "run_id", ["job_id", "task_key"], "left_semi", split_rows=split_rows
    )


def annual_estimate(
    runs: DataFrame,
    clusters: DataFrame,
    sizes: DataFrame,
    start: dt.date,
    end: dt.date,
    days_back: int | None = None,
    rate: float = CORE_HOUR_RATE,
    match: str = "task",
    normalize_size: bool = False,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """The usage estimate from the stored tables. The window is applied to runs and clusters
    before anything else: only what it keeps is counted, shuffled and joined, and a run is
    charged for shapes that its task had in the window, however much history is stored."""
    if days_back is None:
        days_back = (end - start).days
    if match == "task":
        # By run, the join with the runs of the window says the same.
        clusters = window_clusters(clusters, runs, start, end, split_rows)
    elif RUN_DAY in clusters.columns:
        clusters = clusters.where(_stored_days(start, end))
    usage = run_usage(
        window_runs(runs, start, end), clusters.drop(RUN_DAY), sizes, match, normalize_size,
        split_rows,
    )
    return usage_estimate(usage, start, end, days_back, rate)


def usage_tables(
    runs: DataFrame,
    clusters: DataFrame,
    pools: DataFrame,
    jobs: DataFrame,
    since: dt.date,
    fetched: DataFrame | None = None,
    missing_workers: str = "0",
) -> dict[str, DataFrame]:
    """Usage tables from nested exports. ``resolved_tasks`` holds the tasks with and without
    a cluster; ``write_tables`` splits it into the two tables after it is written."""
    finished = scan_runs(runs, epoch_ms(since))
    cluster_info = normalize_clusters(clusters, missing_workers)
    pools_info = normalize_pools(pools)
    return {
        "cluster_info": cluster_info,
        "pools_info": pools_info,
        "job_info": normalize_jobs(jobs),
        "job_run_info": normalize_runs(finished),
        "resolved_tasks": resolve_tasks(
            finished, cluster_info, pools_info, fetched, missing_workers
        ),
    }
