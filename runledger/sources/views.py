"""The derived tables as catalog views, for sessions that ask by name in SQL.

The texts are put together from the lists and constants that the DataFrame operators use, so a
view and its operator have the same columns. Shapes are made distinct before they meet the runs,
as there; jobs of very many runs are better served by the operator, which splits them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from runledger.operators.usage import RUN_COLUMNS, SHAPE_COLUMNS
from runledger.schemas import DEFINITION_COLUMNS, NONE

RUNS, CLUSTERS, SIZES = "job_run_info", "job_run_cluster_info", "fleet_size"
AUTOSCALE, FIXED = "Autoscale", "Fixed"


def all_job_clusters_sql(schema: str) -> str:
    """Cluster rows with their provision method; the run id is left out."""
    described = [
        f"CAST({name} AS STRING) AS {name}" if name == "enable_local_disk_encryption" else name
        for name in DEFINITION_COLUMNS if name not in ("spark_conf", "custom_tags")
    ]
    method = f"IF(num_workers <=> '{NONE}', '{AUTOSCALE}', '{FIXED}') AS node_provision_method"
    columns = [
        "job_id", "task_key", "cluster_identifier", "compute_definition", *described, method,
        "custom_tags", "spark_conf",
    ]
    return f"SELECT {', '.join(columns)} FROM `{schema}`.{CLUSTERS}"


def _count(name: str) -> str:
    """A count held as text."""
    return f"IF({name} = '{NONE}', 0L, try_cast({name} AS BIGINT))"


def run_usage_sql(schema: str) -> str:
    """Distinct (run, cluster shape) rows with duration and core-hours, by job and task."""
    shape = ", ".join(["job_id", "task_key", *SHAPE_COLUMNS, "node_provision_method"])
    minutes = "(run_endtime - run_starttime) / 1000 / 60"
    hours = f"({minutes} / 60)"
    workers = f"try_cast(IF(node_provision_method = '{AUTOSCALE}', autoscale_max, num_workers) AS DOUBLE)"
    hrs = f"round({hours} * d.vcpus + {hours} * w.vcpus * {workers}, 2)"
    run = ", ".join(f"r.{name}" for name in ["job_id", "run_id", *RUN_COLUMNS])
    return (
        f"WITH shapes AS (SELECT DISTINCT {shape} FROM `{schema}`.all_job_clusters) "
        f"SELECT DISTINCT {run}, driver_node, d.vcpus AS driver_vcps, node_provision_method, "
        f"worker_node, {_count('num_workers')} AS worker_nodes, "
        f"{_count('autoscale_min')} AS autoscale_min, {_count('autoscale_max')} AS autoscale_max, "
        f"w.vcpus AS worker_vcps, round({minutes}, 2) AS duration_min, {hrs} AS core_hrs "
        f"FROM `{schema}`.{RUNS} r JOIN shapes USING (job_id, task_key) "
        f"JOIN `{schema}`.{SIZES} d ON d.instance_size = substring_index(driver_node, '.', -1) "
        f"JOIN `{schema}`.{SIZES} w ON w.instance_size = substring_index(worker_node, '.', -1)"
    )


def create_views(spark: SparkSession, schema: str) -> None:
    """Create or replace the views ``all_job_clusters`` and ``run_usage`` over the tables of
    ``schema``, which has ``job_run_info``, ``job_run_cluster_info`` and ``fleet_size``. Every
    session of the catalog sees them."""
    for name, text in (
        ("all_job_clusters", all_job_clusters_sql(schema)), ("run_usage", run_usage_sql(schema)),
    ):
        spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.{name} AS {text}")
