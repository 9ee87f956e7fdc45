"""Which cluster did each task run on?

A task names its cluster in one of several ways. The first that applies decides:

1. an existing cluster: its row in the cluster listing, else a definition fetched singly;
2. a shared cluster of the run, by key (every entry with that key counts);
3. a definition in the task itself;
4. a cluster instance: a definition fetched singly.

Definitions that name a pool take node types, availability, spot price and zone from the
pool. Everything is one pass over the tasks with left joins to three lookup tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from runledger.functions.fields import conformed, explode_fields
from runledger.operators.normalize import cluster_columns
from runledger.operators.skew import (
    BROADCAST_ROWS,
    SPLIT_ROWS,
    fits_broadcast,
    lookup,
    split_join,
)
from runledger.schemas import (
    ALL_PURPOSE,
    CLUSTER_DEFINITION,
    DEFINITION_COLUMNS,
    JOB_RUN_CLUSTER_INFO,
    JOB_RUN_NO_CLUSTER_INFO,
    JOBS_COMPUTE,
    NONE,
    POOL_DEFINED,
    RUN,
    TASK_DEFINED,
)
from runledger.sources.scratch import scratch_path

# Status texts of tasks without a cluster: fixed values, but for the last, which the table
# of causes had no row for.
NOT_RETRIEVED = "APC not in cluster list and can't be retrieved"
NOT_SERIALIZED = "Unable to serialize"
NOT_LOOKED_UP = "Unable to lookup job cluster"
NOT_DEFINED = "Not defined and no cluster instance"
NO_SHARED_KEY = "Shared cluster key not found"

# Pool columns that replace columns of the definition.
_POOL_COLUMNS = {
    "aws_attributes_availability": "aws_attributes_availability",
    "aws_attributes_spot_bid_price_percent": "aws_attributes_spot_bid_price_percent",
    "aws_attributes_zone_id": "aws_attributes_zone_id",
    "worker_node": "node_type_id",
}


_TASK_FIELDS = (
    "task_key", "existing_cluster_id", "job_cluster_key", "new_cluster", "cluster_instance",
)


def run_tasks(runs: DataFrame) -> DataFrame:
    """One row per task and candidate definition: a shared cluster that has the task's key,
    or the definition in the task.

    Only the task fields named here are read, and the run's list of shared clusters is
    searched but not copied. Fields that an export lacks count as unset.
    """
    runs = conformed(runs, RUN)
    shared = F.filter(
        "job_clusters", lambda c: c["job_cluster_key"] == F.col("task.job_cluster_key")
    )
    is_shared = F.col("task.job_cluster_key").isNotNull()
    is_new = F.col("task.new_cluster").isNotNull()
    definitions = (
        F.when(F.col("task.existing_cluster_id").isNotNull(), None)
        .when(is_shared, shared["new_cluster"])
        .when(is_new, F.array("task.new_cluster"))
    )
    return (
        runs.select(
            "job_id", "run_id", "start_time", "job_clusters",
            explode_fields("tasks", _TASK_FIELDS).alias("task"),
        )
        .select(
            "job_id",
            "run_id",
            F.col("start_time").alias("run_starttime"),
            F.col("task.task_key").alias("task_key"),
            F.col("task.existing_cluster_id").alias("existing_id"),
            F.col("task.cluster_instance.cluster_id").alias("instance_id"),
            F.col("task.cluster_instance").isNotNull().alias("is_instance"),
            is_shared.alias("is_shared"),
            is_new.alias("is_new"),
            definitions.alias("definitions"),
        )
        .select(
            "*",
            F.explode_outer("definitions").alias("definition"),
        )
        .drop("definitions")
    )


def _one_per_key(df: DataFrame, key: str, columns: Column) -> DataFrame:
    """One row per key, the same on every run: the smallest."""
    return df.dropna(subset=[key]).groupBy(key).agg(F.min(columns).alias("_row"))


def _known_clusters(
    clusters: DataFrame, fetched: DataFrame | None, missing_workers: str
) -> DataFrame:
    """Definitions by cluster id: ``_listed`` from the listing, ``_fetched`` fetched singly."""
    listed = _one_per_key(clusters, "cluster_id", F.struct(*DEFINITION_COLUMNS)).withColumnRenamed(
        "_row", "_listed"
    )
    row = F.struct(*(F.col(f"_listed.{name}") for name in DEFINITION_COLUMNS))
    if fetched is None:
        return listed.withColumn("_fetched", F.when(F.lit(False), row))
    columns = cluster_columns(fetched.schema, missing_workers=missing_workers)
    flat = fetched.select("cluster_id", *(c.alias(name) for name, c in columns.items()))
    single = _one_per_key(flat, "cluster_id", F.struct(*DEFINITION_COLUMNS)).withColumnRenamed(
        "_row", "_fetched"
    )
    return listed.join(single, "cluster_id", "full")


_LOOKUP_KEYS = ["cluster_id", "_pool_id", "_driver_pool_id"]
_FOUND = ["_listed", "_fetched", "_pool", "_driver_pool"]


def _with_definitions(
    df: DataFrame, known: DataFrame, one_pool: DataFrame,
    attach: Callable[[DataFrame, DataFrame, str], DataFrame],
) -> DataFrame:
    """``df`` with the definitions (``_FOUND``) of its three lookup keys."""
    df = attach(df, known, "cluster_id")
    for key, row in (("_pool_id", "_pool"), ("_driver_pool_id", "_driver_pool")):
        side = one_pool.select(F.col("instance_pool_id").alias(key), F.col("_row").alias(row))
        df = attach(df, side, key)
    return df


def _by_combination(
    tasks: DataFrame, known: DataFrame, one_pool: DataFrame, spread: list[str], split_rows: int
) -> DataFrame:
    """The same where the lookup tables are large. Tasks name few combinations of cluster and
    pools, so these are counted, once for all keys, and looked up; then the tasks are joined,
    and so shuffled, once. Combinations of many tasks are split."""
    keyed = tasks.withColumn("_lookup", F.to_json(F.struct(*_LOOKUP_KEYS)))
    # A task without any key needs no lookup; left joins spread rows whose key is NULL.
    none = reduce(lambda a, b: a & b, (F.col(key).isNull() for key in _LOOKUP_KEYS))
    keyed = keyed.withColumn("_lookup", F.when(~none, F.col("_lookup")))
    counted = keyed.where(F.col("_lookup").isNotNull()).groupBy("_lookup", *_LOOKUP_KEYS).agg(
        F.count(F.lit(1)).alias("_tasks")
    )
    path = scratch_path(tasks.sparkSession, "combinations")
    counted.write.parquet(path)
    counted = tasks.sparkSession.read.schema(counted.schema).parquet(path)
    hot = counted.where(F.col("_tasks") > split_rows).select(
        "_lookup", F.ceil(F.col("_tasks") / split_rows).cast("int").alias("_parts")
    )
    found = _with_definitions(counted, known, one_pool, lambda df, side, key: lookup(
        df, side, key, ["_lookup"], split_rows=split_rows)).select("_lookup", *_FOUND)
    return split_join(
        keyed, found, ["_lookup"], spread, "left", split_rows, hot=hot
    ).drop("_lookup")


def resolve_tasks(
    runs: DataFrame,
    clusters: DataFrame,
    pools: DataFrame,
    fetched: DataFrame | None = None,
    missing_workers: str = "0",
    broadcast_rows: int = BROADCAST_ROWS,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Every task with its cluster columns or, in ``status``, the reason it has none.

    ``runs`` and ``fetched`` are nested, ``clusters`` and ``pools`` normalized tables.
    """
    tasks = run_tasks(runs)
    existing = F.col("existing_id").isNotNull()
    by_instance = ~existing & ~F.col("is_shared") & ~F.col("is_new") & F.col("is_instance")
    pool_id = F.col("definition.instance_pool_id")
    tasks = tasks.select(
        "*",
        F.when(existing, F.col("existing_id")).when(by_instance, F.col("instance_id")).alias(
            "cluster_id"
        ),
        pool_id.alias("_pool_id"),
        F.when(
            pool_id.isNotNull(), F.coalesce("definition.driver_instance_pool_id", pool_id)
        ).alias("_driver_pool_id"),
    )

    spread = ["run_id", "task_key"]
    # The tables as given are measured, each once: they bound what is made of them.
    few_clusters = fits_broadcast(clusters, broadcast_rows) and (
        fetched is None or fits_broadcast(fetched, broadcast_rows)
    )
    few_pools = fits_broadcast(pools, broadcast_rows)
    known = _known_clusters(clusters, fetched, missing_workers)
    one_pool = _one_per_key(pools, "instance_pool_id", F.struct(*_POOL_COLUMNS.values()))
    if few_clusters and few_pools:
        tasks = _with_definitions(tasks, known, one_pool, lambda df, side, key: df.join(
            F.broadcast(side), key, "left"))
    else:
        tasks = _by_combination(tasks, known, one_pool, spread, split_rows)

    defined = F.col("definition").isNotNull()
    pooled = defined & F.col("_pool_id").isNotNull()
    listed, fetched_ok = F.col("_listed").isNotNull(), F.col("_fetched").isNotNull()
    status = (
        F.when(existing, F.when(~listed & ~fetched_ok, NOT_RETRIEVED))
        .when(defined, F.when(pooled & F.col("_pool").isNull(), NOT_SERIALIZED))
        .when(F.col("is_shared"), NO_SHARED_KEY)
        .when(by_instance, F.when(~fetched_ok, NOT_LOOKED_UP))
        .otherwise(NOT_DEFINED)
    )

    own = cluster_columns(
        StructType([StructField("definition", CLUSTER_DEFINITION)]), "definition.", missing_workers
    )

    def column(name: str) -> Column:
        of_definition = own[name]
        if name in _POOL_COLUMNS:
            of_definition = F.when(pooled, F.col(f"_pool.{_POOL_COLUMNS[name]}")).otherwise(
                of_definition
            )
        elif name == "driver_node":
            of_definition = F.when(pooled, F.col("_driver_pool.node_type_id")).otherwise(
                of_definition
            )
        elif name == "instance_pool_id":
            of_definition = F.coalesce("_pool_id", F.lit(NONE))
        return (
            F.when(existing & listed, F.col(f"_listed.{name}"))
            .when(existing | by_instance, F.col(f"_fetched.{name}"))
            .when(defined, of_definition)
            .alias(name)
        )

    identifier = (
        F.when(existing | by_instance, F.col("cluster_id"))
        .when(pooled, POOL_DEFINED)
        .when(defined, TASK_DEFINED)
    )
    return tasks.select(
        "job_id",
        "run_id",
        "run_starttime",
        "task_key",
        identifier.alias("cluster_identifier"),
        F.when(existing, ALL_PURPOSE).otherwise(JOBS_COMPUTE).alias("compute_definition"),
        *(column(name) for name in DEFINITION_COLUMNS),
        F.coalesce("existing_id", "instance_id", F.lit("unknown")).alias("cluster_id"),
        status.alias("status"),
    )


def with_cluster(resolved: DataFrame) -> DataFrame:
    """``job_run_cluster_info`` out of resolved tasks."""
    return resolved.where(F.col("status").isNull()).select(*JOB_RUN_CLUSTER_INFO.names)


def without_cluster(resolved: DataFrame) -> DataFrame:
    """``job_run_no_cluster_info`` out of resolved tasks."""
    return resolved.where(F.col("status").isNotNull()).select(
        *(F.col(name).cast("string").alias(name) for name in JOB_RUN_NO_CLUSTER_INFO.names)
    )


def resolve_clusters(
    runs: DataFrame,
    clusters: DataFrame,
    pools: DataFrame,
    fetched: DataFrame | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """The two cluster tables. To write both, write :func:`resolve_tasks` once and split
    what was written, so that the joins run once."""
    resolved = resolve_tasks(runs, clusters, pools, fetched, **options)
    return with_cluster(resolved), without_cluster(resolved)
