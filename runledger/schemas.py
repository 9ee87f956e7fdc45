"""Schemas of the eight usage tables and of the nested exports they come from."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Sentinels: fixed values that the reports test for.
NONE = "None"
NOT_AVAILABLE = "N/A"
UNKNOWN_TYPE = "Unknown"
UNKNOWN_STATE = "UNKNOWN"

ALL_PURPOSE = "All Purpose Compute"
JOBS_COMPUTE = "Jobs Compute"
TASK_DEFINED = "Task Defined"
POOL_DEFINED = "Pool Defined"

STRING, LONG, INT = StringType(), LongType(), IntegerType()
DOUBLE, BOOL, TIMESTAMP = DoubleType(), BooleanType(), TimestampType()
STRING_MAP = MapType(STRING, STRING)


def table(*groups: tuple[DataType, str]) -> StructType:
    """Schema from ``(type, "name name ...")`` groups, in the order given."""
    return StructType(
        [StructField(name, dtype) for dtype, names in groups for name in names.split()]
    )


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields.items()])


# --- flat tables: column names, order and types are fixed values -----------------

INSTANCES = table(
    (STRING, "instance_type"), (LONG, "vcpus memory"), (DOUBLE, "dbus"), (STRING, "cloud")
)

FLEET_SIZE = table((STRING, "instance_size"), (LONG, "vcpus"))

CLUSTER_INFO = table(
    (
        STRING,
        "cluster_id name creator_user_name aws_attributes_availability enable_elastic_disk"
        " enable_local_disk_encryption workload_type_jobs workload_type_notebooks",
    ),
    (
        LONG,
        "aws_attributes_ebs_volume_count aws_attributes_ebs_volume_iops"
        " aws_attributes_ebs_volume_size aws_attributes_ebs_volume_throughput",
    ),
    (
        STRING,
        "aws_attributes_ebs_volume_type aws_attributes_first_on_demand"
        " aws_attributes_spot_bid_price_percent aws_attributes_instance_profile_arn"
        " aws_attributes_zone_id cluster_memory_mb cluster_cores cluster_source driver_node"
        " worker_node num_workers autoscale_min autoscale_max spark_version policy_id"
        " instance_pool_id custom_tags autotermination_minutes spark_conf runtime_engine",
    ),
)

POOLS_INFO = table(
    (
        STRING,
        "instance_pool_id instance_pool_name aws_attributes_availability"
        " aws_attributes_spot_bid_price_percent aws_attributes_zone_id node_type_id custom_tags",
    )
)

JOB_INFO = table(
    (LONG, "job_id created_time"),
    (STRING, "creator_user_name name"),
    (ArrayType(STRING), "parameters"),
    (
        STRING,
        "schedule_paused_status schedule_quartz_cron_expression schedule_timezone_id",
    ),
    (INT, "task_count job_clusters"),
)

JOB_RUN_INFO = table(
    (LONG, "run_id job_id"),
    (
        STRING,
        "task_key run_name notebook_task_base_params notebook_task_path notebook_task_source"
        " spark_python_task_params spark_python_task_python_file spark_python_task_source"
        " spark_jar_task_parameters spark_jar_task_jar_uri spark_jar_task_main_class_name"
        " spark_submit_task_parameters dbt_task_as_dict git_source_git_url"
        " git_source_job_source sql_task_parameters sql_task_query sql_task_warehouse_id"
        " run_job_task_job_parameters run_job_task_job_id",
    ),
    (LONG, "task_duration"),
    (STRING, "task_state"),
    (
        LONG,
        "task_starttime task_endtime task_setup_duration task_cleanup_duration"
        " task_execution_duration run_starttime run_endtime",
    ),
    (STRING, "run_type"),
    (LONG, "run_execution_duration"),
    (STRING, "run_life_cycle_state run_result_state"),
)

# The 25 columns that describe a cluster, whatever place the definition came from.
DEFINITION_COLUMNS = (
    "aws_attributes_availability enable_elastic_disk enable_local_disk_encryption"
    " workload_type_jobs aws_attributes_ebs_volume_count aws_attributes_ebs_volume_iops"
    " aws_attributes_ebs_volume_size aws_attributes_ebs_volume_throughput"
    " aws_attributes_ebs_volume_type aws_attributes_first_on_demand"
    " aws_attributes_spot_bid_price_percent aws_attributes_instance_profile_arn"
    " aws_attributes_zone_id driver_node worker_node num_workers autoscale_min autoscale_max"
    " spark_version policy_id instance_pool_id autotermination_minutes runtime_engine"
    " spark_conf custom_tags"
).split()

JOB_RUN_CLUSTER_INFO = StructType(
    [
        *table(
            (LONG, "job_id run_id"), (STRING, "task_key cluster_identifier compute_definition")
        ),
        *(CLUSTER_INFO[name] for name in DEFINITION_COLUMNS),
    ]
)

JOB_RUN_NO_CLUSTER_INFO = table((STRING, "job_id run_id task_key cluster_id status"))

ONLINE_RETAIL = table(
    (STRING, "InvoiceNo StockCode Description"),
    (LONG, "Quantity"),
    (TIMESTAMP, "InvoiceDate"),
    (DOUBLE, "UnitPrice"),
    (STRING, "CustomerID Country"),
)

# --- nested exports --------------------------------------------------------------

AWS_ATTRIBUTES = table(
    (STRING, "availability"),
    (LONG, "ebs_volume_count ebs_volume_iops ebs_volume_size ebs_volume_throughput"),
    (STRING, "ebs_volume_type"),
    (LONG, "first_on_demand spot_bid_price_percent"),
    (STRING, "instance_profile_arn zone_id"),
)

AZURE_ATTRIBUTES = table(
    (STRING, "availability"), (LONG, "first_on_demand"), (DOUBLE, "spot_bid_max_price")
)

AUTOSCALE = table((LONG, "min_workers max_workers"))

STORAGE = struct(destination=STRING)
INIT_SCRIPT = struct(workspace=STORAGE, dbfs=STORAGE, s3=STORAGE)

# What usage needs of a cluster; a scan of runs reads no more than this.
CLUSTER_DEFINITION = struct(
    aws_attributes=AWS_ATTRIBUTES,
    enable_elastic_disk=BOOL,
    enable_local_disk_encryption=BOOL,
    workload_type=struct(clients=struct(jobs=BOOL, notebooks=BOOL)),
    driver_node_type_id=STRING,
    node_type_id=STRING,
    instance_pool_id=STRING,
    driver_instance_pool_id=STRING,
    num_workers=LONG,
    autoscale=AUTOSCALE,
    spark_version=STRING,
    policy_id=STRING,
    autotermination_minutes=LONG,
    runtime_engine=STRING,
    spark_conf=STRING_MAP,
    custom_tags=STRING_MAP,
)

# What the checks and rewrites of job definitions need on top.
EDITABLE_DEFINITION = StructType(
    [
        *CLUSTER_DEFINITION,
        *struct(
            azure_attributes=AZURE_ATTRIBUTES,
            cluster_log_conf=struct(dbfs=STORAGE),
            init_scripts=ArrayType(INIT_SCRIPT),
            spark_env_vars=STRING_MAP,
        ),
    ]
)

LISTED_CLUSTER = StructType(
    [
        *table(
            (STRING, "cluster_id cluster_name creator_user_name"),
            (LONG, "cluster_memory_mb"),
            (DOUBLE, "cluster_cores"),
            (STRING, "cluster_source"),
        ),
        *CLUSTER_DEFINITION,
    ]
)

LISTED_POOL = struct(
    instance_pool_id=STRING,
    instance_pool_name=STRING,
    aws_attributes=struct(availability=STRING, spot_bid_price_percent=LONG, zone_id=STRING),
    node_type_id=STRING,
    custom_tags=STRING_MAP,
)

JOB_CLUSTER = struct(job_cluster_key=STRING, new_cluster=CLUSTER_DEFINITION)

RUN_TASK = StructType(
    [
        *struct(
            task_key=STRING,
            existing_cluster_id=STRING,
            job_cluster_key=STRING,
            new_cluster=CLUSTER_DEFINITION,
            cluster_instance=struct(cluster_id=STRING),
        ),
        *table((LONG, "start_time end_time setup_duration cleanup_duration execution_duration")),
        *struct(
            state=struct(result_state=STRING),
            git_source=struct(git_url=STRING, job_source=STRING),
            notebook_task=struct(notebook_path=STRING, source=STRING, base_parameters=STRING_MAP),
            spark_python_task=struct(
                python_file=STRING, source=STRING, parameters=ArrayType(STRING)
            ),
            spark_jar_task=struct(
                jar_uri=STRING, main_class_name=STRING, parameters=ArrayType(STRING)
            ),
            spark_submit_task=struct(parameters=ArrayType(STRING)),
            dbt_task=struct(commands=ArrayType(STRING), project_directory=STRING),
            sql_task=struct(
                query=struct(query_id=STRING), warehouse_id=STRING, parameters=STRING_MAP
            ),
            run_job_task=struct(job_id=LONG, job_parameters=STRING_MAP),
        ),
    ]
)

RUN = struct(
    run_id=LONG,
    job_id=LONG,
    run_name=STRING,
    start_time=LONG,
    end_time=LONG,
    run_type=STRING,
    execution_duration=LONG,
    state=struct(life_cycle_state=STRING, result_state=STRING),
    job_clusters=ArrayType(JOB_CLUSTER),
    tasks=ArrayType(RUN_TASK),
)

HOOKS = ArrayType(struct(id=STRING))
WEBHOOKS = struct(on_start=HOOKS, on_success=HOOKS, on_failure=HOOKS)

EDITABLE_JOB_CLUSTER = struct(job_cluster_key=STRING, new_cluster=EDITABLE_DEFINITION)

JOB_TASK = struct(
    task_key=STRING,
    depends_on=ArrayType(struct(task_key=STRING)),
    existing_cluster_id=STRING,
    job_cluster_key=STRING,
    new_cluster=EDITABLE_DEFINITION,
    notebook_task=struct(notebook_path=STRING, source=STRING, base_parameters=STRING_MAP),
    timeout_seconds=LONG,
    webhook_notifications=WEBHOOKS,
)

JOB = struct(
    job_id=LONG,
    created_time=LONG,
    creator_user_name=STRING,
    settings=struct(
        name=STRING,
        format=STRING,
        parameters=ArrayType(struct(name=STRING, default=STRING)),
        schedule=struct(
            pause_status=STRING, quartz_cron_expression=STRING, timezone_id=STRING
        ),
        new_cluster=EDITABLE_DEFINITION,
        tasks=ArrayType(JOB_TASK),
        job_clusters=ArrayType(EDITABLE_JOB_CLUSTER),
        webhook_notifications=WEBHOOKS,
    ),
)

RECOMMENDATION = struct(
    prediction_id=STRING,
    project_id=STRING,
    created_at=TIMESTAMP,
    configuration=struct(
        driver_node_type_id=STRING,
        node_type_id=STRING,
        num_workers=LONG,
        autoscale=AUTOSCALE,
        spark_conf=STRING_MAP,
    ),
)

PROJECT = struct(project_id=STRING, auto_apply_recs=BOOL)
