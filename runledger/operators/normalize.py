"""Flattening of nested exports into the usage tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from runledger.functions.expr import is_terminal
from runledger.functions.fields import explode_fields, field, field_type
from runledger.schemas import (
    CLUSTER_INFO,
    DEFINITION_COLUMNS,
    JOB_INFO,
    JOB_RUN_INFO,
    NONE,
    NOT_AVAILABLE,
    POOLS_INFO,
    UNKNOWN_STATE,
    UNKNOWN_TYPE,
)

# Where each text column of a task row is found: fixed names.
TASK_TEXT = {
    "notebook_task_base_params": "notebook_task.base_parameters",
    "notebook_task_path": "notebook_task.notebook_path",
    "notebook_task_source": "notebook_task.source",
    "spark_python_task_params": "spark_python_task.parameters",
    "spark_python_task_python_file": "spark_python_task.python_file",
    "spark_python_task_source": "spark_python_task.source",
    "spark_jar_task_parameters": "spark_jar_task.parameters",
    "spark_jar_task_jar_uri": "spark_jar_task.jar_uri",
    "spark_jar_task_main_class_name": "spark_jar_task.main_class_name",
    "spark_submit_task_parameters": "spark_submit_task.parameters",
    "dbt_task_as_dict": "dbt_task",
    "git_source_git_url": "git_source.git_url",
    "git_source_job_source": "git_source.job_source",
    "sql_task_parameters": "sql_task.parameters",
    "sql_task_query": "sql_task.query",
    "sql_task_warehouse_id": "sql_task.warehouse_id",
    "run_job_task_job_parameters": "run_job_task.job_parameters",
    "run_job_task_job_id": "run_job_task.job_id",
}

TASK_NUMBERS = {
    "task_duration": "execution_duration",
    "task_starttime": "start_time",
    "task_endtime": "end_time",
    "task_setup_duration": "setup_duration",
    "task_cleanup_duration": "cleanup_duration",
    "task_execution_duration": "execution_duration",
}


def _shaped(schema: StructType, columns: dict[str, Column]) -> list[Column]:
    """Columns in the order and types of a table; one that is not given is NULL."""
    return [
        columns.get(f.name, F.lit(None)).cast(f.dataType.simpleString()).alias(f.name)
        for f in schema.fields
    ]


def _attributes(get: Callable[..., Column], missing_workers: str) -> dict[str, Column]:
    """Definition columns that are read the same way from every source."""
    volume = "aws_attributes.ebs_volume_"
    workers = get("num_workers", to="bigint").cast("string")
    return {
        "aws_attributes_availability": get("aws_attributes.availability", NONE),
        "enable_elastic_disk": get("enable_elastic_disk", NONE),
        "enable_local_disk_encryption": get("enable_local_disk_encryption").cast("string"),
        "workload_type_jobs": get("workload_type.clients.jobs", NONE),
        "aws_attributes_ebs_volume_count": get(volume + "count", 0),
        "aws_attributes_ebs_volume_iops": get(volume + "iops", 0),
        "aws_attributes_ebs_volume_size": get(volume + "size", 0),
        "aws_attributes_ebs_volume_throughput": get(volume + "throughput", 0),
        "aws_attributes_ebs_volume_type": get(volume + "type", NONE),
        "aws_attributes_first_on_demand": get("aws_attributes.first_on_demand"),
        "aws_attributes_spot_bid_price_percent": get("aws_attributes.spot_bid_price_percent"),
        "aws_attributes_instance_profile_arn": get("aws_attributes.instance_profile_arn"),
        "aws_attributes_zone_id": get("aws_attributes.zone_id"),
        "driver_node": get("driver_node_type_id"),
        "worker_node": get("node_type_id"),
        "num_workers": F.coalesce(workers, F.lit(missing_workers)),
        "autoscale_min": get("autoscale.min_workers", 0),
        "autoscale_max": get("autoscale.max_workers", 0),
        "spark_version": get("spark_version"),
        "policy_id": get("policy_id"),
        "autotermination_minutes": get("autotermination_minutes"),
        "runtime_engine": get("runtime_engine", NONE),
        "spark_conf": get("spark_conf", NONE),
        "custom_tags": get("custom_tags", NONE),
    }


def cluster_columns(
    schema: StructType, prefix: str = "", missing_workers: str = "0"
) -> dict[str, Column]:
    """Definition columns of a single cluster record, by name.

    The driver node defaults to the worker node. The pool id is not read: where it matters
    the caller sets it. ``prefix`` is the dotted path of the record, ``missing_workers`` the
    text for a cluster without a worker count: ``'0'`` makes it a fixed cluster of no
    workers, ``'None'`` an autoscaling one.
    """
    get = partial(_get, schema, prefix)
    columns = _attributes(get, missing_workers)
    columns["driver_node"] = F.coalesce(columns["driver_node"], columns["worker_node"])
    columns["autotermination_minutes"] = get("autotermination_minutes", NONE)
    return {
        name: columns.get(name, F.lit(None)).cast(CLUSTER_INFO[name].dataType.simpleString())
        for name in DEFINITION_COLUMNS
    }


def _get(
    schema: StructType, prefix: str, path: str, default=None, to: str | None = None
) -> Column:
    return field(schema, prefix + path, default, to)


def normalize_clusters(clusters: DataFrame, missing_workers: str = "0") -> DataFrame:
    """``cluster_info`` from a cluster listing. Unlike in :func:`cluster_columns` the driver
    node is not defaulted here."""
    get = partial(_get, clusters.schema, "")
    columns = _attributes(get, missing_workers) | {
        "cluster_id": get("cluster_id"),
        "name": get("cluster_name"),
        "creator_user_name": get("creator_user_name"),
        "workload_type_notebooks": get("workload_type.clients.notebooks", NONE),
        "aws_attributes_spot_bid_price_percent": get(
            "aws_attributes.spot_bid_price_percent", NONE
        ),
        "aws_attributes_instance_profile_arn": get("aws_attributes.instance_profile_arn", NONE),
        "aws_attributes_zone_id": get("aws_attributes.zone_id", NONE),
        "cluster_memory_mb": get("cluster_memory_mb", NONE),
        "cluster_cores": get("cluster_cores"),
        "cluster_source": get("cluster_source"),
        "instance_pool_id": get("instance_pool_id", NONE),
    }
    return clusters.select(*_shaped(CLUSTER_INFO, columns))


def normalize_pools(pools: DataFrame) -> DataFrame:
    """``pools_info`` from a pool listing; every column is the pool's own."""
    get = partial(_get, pools.schema, "")
    columns = {
        "instance_pool_id": get("instance_pool_id"),
        "instance_pool_name": get("instance_pool_name"),
        "aws_attributes_availability": get("aws_attributes.availability", NONE),
        "aws_attributes_spot_bid_price_percent": get(
            "aws_attributes.spot_bid_price_percent", NONE
        ),
        "aws_attributes_zone_id": get("aws_attributes.zone_id", NONE),
        "node_type_id": get("node_type_id"),
        "custom_tags": get("custom_tags", NONE),
    }
    return pools.select(*_shaped(POOLS_INFO, columns))


def normalize_jobs(jobs: DataFrame) -> DataFrame:
    """``job_info`` from a job listing."""
    schema = jobs.schema
    get = partial(_get, schema, "")

    def entries(path: str) -> Column:
        if field_type(schema, path) is None:
            return F.lit(0)
        return F.coalesce(F.when(F.col(path).isNotNull(), F.size(path)), F.lit(0))

    columns = {
        "job_id": get("job_id"),
        "created_time": get("created_time"),
        "creator_user_name": get("creator_user_name", NONE),
        "name": get("settings.name"),
        "schedule_paused_status": get("settings.schedule.pause_status", NONE),
        "schedule_quartz_cron_expression": get(
            "settings.schedule.quartz_cron_expression", NONE
        ),
        "schedule_timezone_id": get("settings.schedule.timezone_id", NONE),
        "task_count": entries("settings.tasks"),
        "job_clusters": entries("settings.job_clusters"),
    }
    if field_type(schema, "settings.parameters") is not None:
        columns["parameters"] = F.transform("settings.parameters", lambda p: F.to_json(p))
    return jobs.select(*_shaped(JOB_INFO, columns))


def scan_runs(runs: DataFrame, start_ms: int) -> DataFrame:
    """Finished runs that started at or after ``start_ms``."""
    return runs.where(
        (F.col("start_time") >= start_ms) & is_terminal("state.life_cycle_state")
    )


def normalize_runs(runs: DataFrame) -> DataFrame:
    """``job_run_info`` from a run listing: one row per task, run columns repeated."""
    listed = field_type(runs.schema, "tasks").elementType
    paths = ["task_key", "state", *TASK_TEXT.values(), *TASK_NUMBERS.values()]
    read = [name for name in dict.fromkeys(p.split(".")[0] for p in paths) if name in listed.names]
    task_type = StructType([listed[name] for name in read])
    schema = StructType([*runs.schema.fields, StructField("task", task_type)])
    get = partial(_get, schema, "")
    task = partial(_get, schema, "task.")
    columns = {
        "run_id": get("run_id"),
        "job_id": get("job_id"),
        "task_key": task("task_key"),
        "run_name": get("run_name"),
        "task_state": task("state.result_state"),
        "run_starttime": get("start_time"),
        "run_endtime": get("end_time"),
        "run_type": get("run_type", UNKNOWN_TYPE),
        "run_execution_duration": get("execution_duration"),
        "run_life_cycle_state": get("state.life_cycle_state", UNKNOWN_STATE),
        "run_result_state": get("state.result_state", UNKNOWN_STATE),
    }
    columns |= {name: task(path, NOT_AVAILABLE) for name, path in TASK_TEXT.items()}
    columns |= {name: task(path) for name, path in TASK_NUMBERS.items()}
    tasks = runs.withColumn("task", explode_fields("tasks", read))
    return tasks.select(*_shaped(JOB_RUN_INFO, columns))
