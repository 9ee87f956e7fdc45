"""Run usage: which cluster shapes each run used, and the core-hours they took."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions.expr import provision_method, sentinel_long, size_key
from runledger.operators.skew import (
    BROADCAST_ROWS,
    MIN_SPLIT_ROWS,
    SPLIT_ROWS,
    fits_broadcast,
    lookup,
    measured_keys,
    split_join,
)
from runledger.schemas import DEFINITION_COLUMNS

MATCH_KEYS = {"task": ["job_id", "task_key"], "run": ["job_id", "run_id", "task_key"]}

RUN_COLUMNS = ["run_name", "run_type", "run_starttime", "run_result_state"]
SHAPE_COLUMNS = [
    "driver_node",
    "worker_node",
    "num_workers",
    "autoscale_min",
    "autoscale_max",
]


def match_keys(match: str) -> list[str]:
    if match not in MATCH_KEYS:
        raise ValueError(f"match must be one of {sorted(MATCH_KEYS)}, not {match!r}")
    return MATCH_KEYS[match]


def all_job_clusters(clusters: DataFrame, keep_run_id: bool = False) -> DataFrame:
    """Cluster rows with their provision method; the run id is left out unless asked for."""
    described = [
        F.col(name).cast("string") if name == "enable_local_disk_encryption" else F.col(name)
        for name in DEFINITION_COLUMNS
        if name not in ("spark_conf", "custom_tags")
    ]
    return clusters.select(
        "job_id",
        *(["run_id"] if keep_run_id else []),
        "task_key",
        "cluster_identifier",
        "compute_definition",
        *described,
        provision_method().alias("node_provision_method"),
        "custom_tags",
        "spark_conf",
    )


def split_by_job(
    runs: DataFrame, side: DataFrame, split_rows: int, how: str = "inner"
) -> DataFrame:
    """Join of run tasks by job and task, in which the runs of a large job are split, and
    so are the ``side`` rows of a task that has many."""
    rest = [c for c in side.columns if c not in MATCH_KEYS["task"]]
    hot, rows = _jobs(runs, split_rows)
    return split_join(
        runs, side, MATCH_KEYS["task"], by=["run_id"], how=how, split_rows=split_rows,
        key=["job_id"], right_by=rest or None, hot=hot, rows=rows,
    )


def _jobs(runs: DataFrame, split_rows: int) -> tuple[DataFrame | None, int]:
    """Large jobs and the number of rows, where the bound makes that list short."""
    if split_rows < MIN_SPLIT_ROWS:
        return None, 0
    return measured_keys(runs, ["job_id"], split_rows)


def join_clusters(
    runs: DataFrame,
    clusters: DataFrame,
    columns: Sequence[str],
    match: str = "task",
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Run-task rows with the distinct ``columns`` of the clusters of the same task.

    ``match='task'`` pairs by job and task, so a run meets the clusters of every run of its
    task; ``match='run'`` pairs by run as well. Cluster rows are made distinct on what the
    caller reads before the join, so k runs of a task do not meet k equal cluster rows.
    """
    keys = match_keys(match)
    side = clusters.select(*keys, *columns).distinct()
    if match == "run":
        return runs.join(side, keys)
    return split_by_job(runs, side, split_rows)


def core_hours(hours: Column, driver: Column, worker: Column, workers: Column) -> Column:
    return F.round(hours * driver + hours * worker * workers, 2)


def sized_shapes(
    clusters: DataFrame,
    sizes: DataFrame,
    match: str,
    normalize_size: bool = False,
    split_rows: int = SPLIT_ROWS,
    max_rows: int = BROADCAST_ROWS,
    distinct: bool = True,
) -> DataFrame:
    """Cluster shapes per key with the vcpus of driver and worker. Shapes whose size the
    catalogue does not list are left out.

    Shapes of a task over all its runs are made distinct. Those of one run are not: they
    hardly repeat, and a shuffle to find that out would cost as much as the join. A caller that
    groups the shapes of tasks anyway asks for rows that are not ``distinct``.
    """
    keys = match_keys(match)
    small = fits_broadcast(sizes, max_rows)
    shapes = clusters.select(*keys, *SHAPE_COLUMNS).dropna(subset=keys)
    if match == "task" and distinct:
        shapes = shapes.distinct()
    for role in ("driver", "worker"):
        vcpus = sizes.select(
            F.col("instance_size").alias("_size"), F.col("vcpus").alias(f"{role}_vcps")
        )
        shapes = shapes.withColumn("_size", size_key(f"{role}_node", normalize_size))
        shapes = lookup(
            shapes, vcpus, "_size", keys, "inner", split_rows=split_rows, small=small
        ).drop("_size")
    method = provision_method()
    workers = F.when(method == "Autoscale", F.col("autoscale_max")).otherwise(F.col("num_workers"))
    return shapes.select(
        *keys,
        "driver_node",
        "driver_vcps",
        method.alias("node_provision_method"),
        "worker_node",
        sentinel_long("num_workers").alias("worker_nodes"),
        sentinel_long("autoscale_min").alias("autoscale_min"),
        sentinel_long("autoscale_max").alias("autoscale_max"),
        "worker_vcps",
        workers.try_cast("double").alias("_workers"),
    )


_USAGE_COLUMNS = [
    "job_id", "run_id", *RUN_COLUMNS, "driver_node", "driver_vcps", "node_provision_method",
    "worker_node", "worker_nodes", "autoscale_min", "autoscale_max", "worker_vcps", "duration_min",
]


def run_usage(
    runs: DataFrame,
    clusters: DataFrame,
    sizes: DataFrame,
    match: str = "task",
    normalize_size: bool = False,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Distinct (run, cluster shape) rows with duration and core-hours.

    Rows carry neither task nor cluster id, so tasks of a run on equal shapes give one row,
    and each shape is charged for the whole run. Shapes are made distinct and sized before
    they meet the runs. With ``match='task'`` a run and a shape meet once, by job, if they have
    a task in common, so no two pairs are equal. Otherwise the join forms only pairs that
    differ, but for tasks of the same run, and those the final DISTINCT removes.

    Jobs of more than ``split_rows`` rows are split; None says that there are none, so that
    tables stored in buckets can be joined as they lie.
    """
    keys = match_keys(match)
    shapes = sized_shapes(
        clusters, sizes, match, normalize_size, split_rows or SPLIT_ROWS, distinct=split_rows is None
    )
    # What depends on the run alone is computed here, not for every pair.
    minutes = (F.col("run_endtime") - F.col("run_starttime")) / 1000 / 60
    run_rows = runs.select(
        "job_id",
        "run_id",
        "task_key",
        *RUN_COLUMNS,
        F.round(minutes, 2).alias("duration_min"),
        (minutes / 60).alias("_hours"),
    )
    if match == "run" or split_rows is None:
        pairs = run_rows.dropna(subset=keys).join(shapes, keys)
        hours = core_hours(
            F.col("_hours"), F.col("driver_vcps"), F.col("worker_vcps"), F.col("_workers")
        )
        return pairs.select(*_USAGE_COLUMNS, hours.alias("core_hrs")).distinct()
    of_run = [c for c in run_rows.columns if c not in ("task_key", "_hours")]
    of_shape = ["job_id", *(c for c in shapes.columns if c not in (*keys, "_workers"))]
    hot, rows = _jobs(run_rows, split_rows)
    pairs = split_join(
        _by_tasks(run_rows.dropna(subset=keys), of_run, "_hours"),
        _by_tasks(shapes, of_shape, "_workers"), ["job_id"], by=["run_id"],
        split_rows=split_rows, right_by=of_shape[1:], hot=hot, rows=rows,
    ).where(F.arrays_overlap("_hours_tasks", "_workers_tasks"))

    def charged(hours: Column, workers: Column) -> Column:
        return core_hours(hours, F.col("driver_vcps"), F.col("worker_vcps"), workers)

    # Nearly always a run has one duration and a shape one number of workers.
    usual = (F.size("_hours_values") == 1) & (F.size("_workers_values") == 1)
    every = F.transform("_hours_rows", lambda r: F.transform(
        F.filter("_workers_rows", lambda s: s["task_key"] == r["task_key"]),
        lambda s: charged(r["_hours"], s["_workers"]),
    ))
    all_hours = F.when(
        usual, F.array(charged(F.get("_hours_values", F.lit(0)), F.get("_workers_values", F.lit(0))))
    ).otherwise(F.array_distinct(F.flatten(every)))
    return pairs.select(*_USAGE_COLUMNS, F.explode(all_hours).alias("core_hrs"))


def _by_tasks(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """One row for each ``by``, with the tasks and the ``value`` that it has there (``_rows``),
    and different tasks and values (``_tasks``, ``_values``)."""
    grouped = rows.groupBy(*by).agg(
        F.collect_set(F.struct(value, "task_key")).alias(f"{value}_rows")
    )
    return grouped.withColumns({
        f"{value}_tasks": F.array_distinct(F.col(f"{value}_rows")["task_key"]),
        f"{value}_values": F.array_distinct(F.col(f"{value}_rows")[value]),
    })


def size_coverage(
    clusters: DataFrame, sizes: DataFrame, normalize_size: bool = False
) -> DataFrame:
    """Cluster rows that run usage leaves out, per role and size key not in the catalogue."""
    # Roles are counted before the catalogue is consulted: few rows reach the anti join.
    roles = F.array(
        *(
            F.struct(
                F.lit(role).alias("role"),
                F.col(f"{role}_node").alias("node"),
                size_key(f"{role}_node", normalize_size).alias("instance_size"),
            )
            for role in ("driver", "worker")
        )
    )
    counted = (
        clusters.select(F.explode(roles).alias("r"))
        .groupBy("r.role", "r.node", "r.instance_size")
        .agg(F.count(F.lit(1)).alias("cluster_rows"))
    )
    listed = sizes.select("instance_size")
    listed = F.broadcast(listed) if fits_broadcast(listed) else listed
    return counted.join(listed, "instance_size", "left_anti").select(
        "role", "node", "instance_size", "cluster_rows"
    )
