"""The same results in DuckDB SQL, over the same order tables. Written from the meaning of
each operator, not from its plan: joins are plain joins, lookups are scalar joins."""

from __future__ import annotations

from collections.abc import Sequence

from runledger.functions.expr import epoch_ms
from runledger.operators.jobdefs import (
    NO_AUTO_APPLY,
    NO_CLUSTER,
    NO_DBFS_LOGS,
    NO_PROJECT,
    NOT_ONE_CLUSTER,
)
from runledger.operators.workload import HASH_FACTORS, column_key
from runledger.operators.resolve import (
    NO_SHARED_KEY,
    NOT_DEFINED,
    NOT_LOOKED_UP,
    NOT_RETRIEVED,
    NOT_SERIALIZED,
)
from runledger.samples.orders import (
    DRIVER_NODES,
    INSTANCE_ROWS,
    SIZES,
    TASK_COLUMNS,
    WORKER_NODES,
)
from runledger.samples.queries import (
    END,
    EXPORT_END,
    SINCE,
    START,
    XOR_I,
    XOR_J,
)
from runledger.samples.stored import FETCHED_FROM, FETCHED_UNTIL, RANDOM_SEED
from runledger.schemas import DEFINITION_COLUMNS, JOB_RUN_INFO


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def choose(values: Sequence[str], index: str) -> str:
    return f"([{', '.join(map(quoted, values))}])[1 + ({index})]"


def driver(index: str) -> str:
    return choose(DRIVER_NODES, f"({index}) % 6")


def worker(index: str) -> str:
    return choose(WORKER_NODES, f"({index}) % 5")


def rows(table: str, columns: str, values: Sequence[tuple]) -> str:
    body = ", ".join(
        "(" + ", ".join(quoted(v) if isinstance(v, str) else str(v) for v in row) + ")"
        for row in values
    )
    return f"{table}({columns}) AS (VALUES {body})"


# --- derived run tables ----------------------------------------------------------

_KINDS = ",\n    ".join(
    f"CASE WHEN n = {i} THEN 'x' ELSE 'N/A' END AS {name}"
    for i, name in enumerate(TASK_COLUMNS, start=1)
)

RUNS = f"""
items AS (
  SELECT l_orderkey, l_linenumber AS n, min(l_partkey) AS mp
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
run_lines AS (
  SELECT o_custkey AS job_id, o_orderkey AS run_id, 't' || n AS task_key,
    'job_' || (o_custkey % 97) AS run_name,
    epoch_ms(o_orderdate) + (o_orderkey % 96) * 900000 AS run_starttime,
    (1 + o_orderkey % 16) * 900000 AS duration,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'SUBMIT_RUN' WHEN '2-HIGH' THEN 'WORKFLOW_RUN'
      ELSE 'JOB_RUN' END AS run_type,
    CASE WHEN o_orderkey % 5 = 0 THEN 'INTERNAL_ERROR' WHEN o_orderkey % 7 = 0 THEN 'RUNNING'
      ELSE 'TERMINATED' END AS run_life_cycle_state,
    CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILED' ELSE 'CANCELED' END
      AS run_result_state,
    n, mp
  FROM orders JOIN items ON o_orderkey = l_orderkey),
job_runs AS (
  SELECT *, run_starttime + duration AS run_endtime,
    {_KINDS}
  FROM run_lines),
shapes AS (
  SELECT job_id, run_id, task_key, 'c' || mp AS cluster_identifier,
    CASE WHEN mp % 3 = 0 THEN 'All Purpose Compute' ELSE 'Jobs Compute' END
      AS compute_definition,
    CASE WHEN mp % 2 = 0 THEN 'true' END AS enable_local_disk_encryption,
    mp % 4 AS aws_attributes_ebs_volume_count,
    {driver("mp")} AS driver_node, {worker("mp")} AS worker_node,
    CASE WHEN mp % 7 = 0 THEN 'None' ELSE CAST(mp % 9 AS VARCHAR) END AS num_workers,
    '0' AS autoscale_min,
    CASE WHEN mp % 7 = 0 THEN CAST(2 + mp % 8 AS VARCHAR) ELSE '0' END AS autoscale_max,
    CASE WHEN mp % 4 = 0 THEN 'pool_' || (mp % 10) ELSE 'None' END AS instance_pool_id,
    CASE WHEN mp % 7 = 0 THEN 'Autoscale' ELSE 'Fixed' END AS node_provision_method
  FROM run_lines WHERE mp % 11 <> 0),
no_shapes AS (
  SELECT run_id, task_key, CASE WHEN mp % 2 = 0 THEN 'unknown' ELSE 'c' || mp END AS cluster_id
  FROM run_lines WHERE mp % 11 = 0),
{rows("sizes", "instance_size, vcpus", SIZES)}
"""


def _usage(match: str, where: str = "true") -> str:
    """Run usage of the runs that meet a condition, on shapes of such runs."""
    by_run = "AND r.run_id = s.run_id" if match == "run" else ""
    return f"""
own_shapes AS (
  SELECT * FROM shapes WHERE run_id IN (SELECT run_id FROM job_runs WHERE {where})),
paired AS (
  SELECT r.*, s.driver_node, s.worker_node, s.node_provision_method,
    CAST(CASE s.num_workers WHEN 'None' THEN '0' ELSE s.num_workers END AS BIGINT)
      AS worker_nodes,
    CAST(s.autoscale_min AS BIGINT) AS autoscale_min,
    CAST(s.autoscale_max AS BIGINT) AS autoscale_max,
    CAST(d.vcpus AS BIGINT) AS driver_vcps, CAST(w.vcpus AS BIGINT) AS worker_vcps,
    duration / 3600000.0::DOUBLE AS hours
  FROM job_runs r
  JOIN own_shapes s ON r.job_id = s.job_id AND r.task_key = s.task_key {by_run}
  JOIN sizes d ON d.instance_size = split_part(s.driver_node, '.', -1)
  JOIN sizes w ON w.instance_size = split_part(s.worker_node, '.', -1)
  WHERE {where}),
usage AS (
  SELECT DISTINCT job_id, run_id, run_name, run_type, run_starttime, run_result_state,
    driver_node, driver_vcps, node_provision_method, worker_node, worker_nodes,
    autoscale_min, autoscale_max, worker_vcps,
    round(hours * 60, 2) AS duration_min,
    round(hours * driver_vcps + hours * worker_vcps
      * greatest(worker_nodes, autoscale_max), 2) AS core_hrs
  FROM paired)"""


_NORMALIZED = f"""
WITH {RUNS},
named AS (
  SELECT job_id, run_id, task_key, num_workers, autoscale_min, autoscale_max,
    node_provision_method, split_part(driver_node, '.', -1) AS ds,
    split_part(worker_node, '.', -1) AS ws,
    CASE WHEN run_id % 3 = 0 THEN 'Standard_' || split_part(driver_node, '.', -1) || '_v2'
      ELSE driver_node END AS driver_node,
    CASE WHEN run_id % 3 = 0 THEN 'Standard_' || split_part(worker_node, '.', -1) || '_v2'
      ELSE worker_node END AS worker_node
  FROM shapes),
paired AS (
  SELECT r.job_id, r.run_id, run_name, run_type, run_starttime, run_result_state, driver_node,
    worker_node, node_provision_method, duration / 3600000.0::DOUBLE AS hours,
    CAST(CASE num_workers WHEN 'None' THEN '0' ELSE num_workers END AS BIGINT) AS worker_nodes,
    CAST(autoscale_min AS BIGINT) AS autoscale_min, CAST(autoscale_max AS BIGINT) AS autoscale_max,
    CAST(d.vcpus AS BIGINT) AS driver_vcps, CAST(w.vcpus AS BIGINT) AS worker_vcps
  FROM job_runs r JOIN named s USING (job_id, run_id, task_key)
  JOIN sizes d ON d.instance_size = ds JOIN sizes w ON w.instance_size = ws)
SELECT DISTINCT job_id, run_id, run_name, run_type, run_starttime, run_result_state,
  driver_node, driver_vcps, node_provision_method, worker_node, worker_nodes,
  autoscale_min, autoscale_max, worker_vcps, round(hours * 60, 2) AS duration_min,
  round(hours * driver_vcps + hours * worker_vcps * greatest(worker_nodes, autoscale_max), 2)
    AS core_hrs
FROM paired"""


def _estimate(match: str) -> str:
    factor = 365 // (END - START).days
    window = f"run_starttime >= {epoch_ms(START)} AND run_starttime < {epoch_ms(END)}"
    return f"""
WITH {RUNS}, {_usage(match, window)}
SELECT '{START} - {END}' AS period, count(DISTINCT run_name) AS jobs,
  count(DISTINCT run_id) AS runs, round(sum(core_hrs), 2) AS core_hrs,
  round(sum(core_hrs) * {factor}, 2) AS est_annual_core_hrs,
  round(sum(core_hrs) * {factor} * 0.006::DOUBLE, 2) AS est_annual_core_hr_cost
FROM usage"""


_NULL = "CAST(NULL AS VARCHAR)"

_ALL_JOB_CLUSTERS = f"""
WITH {RUNS}
SELECT job_id, task_key, cluster_identifier, compute_definition,
  {_NULL} AS aws_attributes_availability, {_NULL} AS enable_elastic_disk,
  enable_local_disk_encryption, {_NULL} AS workload_type_jobs, aws_attributes_ebs_volume_count,
  CAST(NULL AS BIGINT) AS aws_attributes_ebs_volume_iops,
  CAST(NULL AS BIGINT) AS aws_attributes_ebs_volume_size,
  CAST(NULL AS BIGINT) AS aws_attributes_ebs_volume_throughput,
  {_NULL} AS aws_attributes_ebs_volume_type, {_NULL} AS aws_attributes_first_on_demand,
  {_NULL} AS aws_attributes_spot_bid_price_percent,
  {_NULL} AS aws_attributes_instance_profile_arn, {_NULL} AS aws_attributes_zone_id,
  driver_node, worker_node, num_workers, autoscale_min, autoscale_max,
  {_NULL} AS spark_version, {_NULL} AS policy_id, instance_pool_id,
  {_NULL} AS autotermination_minutes, {_NULL} AS runtime_engine, node_provision_method,
  {_NULL} AS custom_tags, {_NULL} AS spark_conf
FROM shapes"""

_TASK_KIND = """
CASE n WHEN 1 THEN 'Notebook Task' WHEN 2 THEN 'Job Run Task' WHEN 3 THEN 'Spark Jar Task'
  WHEN 4 THEN 'Spark Python Task' WHEN 5 THEN 'SQL Task' WHEN 6 THEN 'DBT Task' END"""

_DBU = f"""
WITH {RUNS}, {_usage("run")},
{rows("instances", "instance_type, vcpus, memory, dbus, cloud", INSTANCE_ROWS)},
hours AS (
  SELECT driver_node, worker_node, sum(CAST(duration_min / 60 AS DECIMAL(18,6))) AS d,
    sum(CAST(duration_min / 60 AS DECIMAL(18,6)) * greatest(worker_nodes, autoscale_max)) AS w
  FROM usage GROUP BY driver_node, worker_node),
priced AS (
  SELECT driver_node, worker_node,
    h.d * CAST(i.dbus AS DECIMAL(10,2)) + h.w * CAST(j.dbus AS DECIMAL(10,2)) AS total
  FROM hours h JOIN instances i ON i.instance_type = driver_node
  JOIN instances j ON j.instance_type = worker_node)
SELECT driver_node, worker_node, CAST(round(total, 2) AS DOUBLE) AS dbus,
  CAST(round(total * 0.2, 2) AS DOUBLE) AS dbu_cost
FROM priced"""

# --- nested exports --------------------------------------------------------------

# Clusters apc_<k>: columns of the listing, and those that differ when fetched singly.
_APC = f"""
numbered AS (
  SELECT s_suppkey AS k, true AS is_listed FROM supplier
  UNION ALL SELECT 100 + n_nationkey, false FROM nation),
apc AS (
  SELECT k, is_listed, 'apc_' || k AS cluster_id,
    CASE WHEN k % 5 <> 0 THEN 'ON_DEMAND' ELSE 'None' END AS aws_attributes_availability,
    CASE WHEN k % 3 = 0 THEN 'None' WHEN k % 2 = 0 THEN 'True' ELSE 'False' END
      AS enable_elastic_disk,
    CASE WHEN k % 3 = 1 THEN NULL WHEN k % 2 = 0 THEN 'true' ELSE 'false' END
      AS enable_local_disk_encryption,
    CASE WHEN k % 2 = 0 THEN 'True' ELSE 'False' END AS workload_type_jobs,
    CAST(CASE WHEN k % 5 <> 0 THEN k % 3 ELSE 0 END AS BIGINT)
      AS aws_attributes_ebs_volume_count,
    CAST(0 AS BIGINT) AS aws_attributes_ebs_volume_iops,
    CAST(0 AS BIGINT) AS aws_attributes_ebs_volume_size,
    CAST(0 AS BIGINT) AS aws_attributes_ebs_volume_throughput,
    'None' AS aws_attributes_ebs_volume_type,
    CASE WHEN k % 5 <> 0 THEN CAST(k % 2 AS VARCHAR) END AS aws_attributes_first_on_demand,
    CASE WHEN k % 5 <> 0 AND k % 2 = 0 THEN '100' WHEN is_listed THEN 'None' END
      AS aws_attributes_spot_bid_price_percent,
    CASE WHEN is_listed THEN 'None' END AS aws_attributes_instance_profile_arn,
    CASE WHEN is_listed THEN 'None' END AS aws_attributes_zone_id,
    CASE WHEN k % 2 = 1 THEN {driver("k")} WHEN NOT is_listed THEN {worker("k")} END
      AS driver_node,
    {worker("k")} AS worker_node,
    CASE WHEN k % 4 <> 0 THEN CAST(k % 9 AS VARCHAR) ELSE '0' END AS num_workers,
    CASE WHEN k % 4 = 0 THEN '1' ELSE '0' END AS autoscale_min,
    CASE WHEN k % 4 = 0 THEN CAST(2 + k % 8 AS VARCHAR) ELSE '0' END AS autoscale_max,
    {_NULL} AS spark_version, {_NULL} AS policy_id,
    CASE WHEN is_listed THEN 'None' END AS instance_pool_id,
    CASE WHEN k % 2 = 0 THEN CAST(k % 60 AS VARCHAR) WHEN NOT is_listed THEN 'None' END
      AS autotermination_minutes,
    'None' AS runtime_engine, 'None' AS spark_conf,
    CASE WHEN k % 2 = 0 THEN '{{"team":"t' || (k % 10) || '"}}' ELSE 'None' END AS custom_tags
  FROM numbered)"""

_POOLS = f"""
pools AS (
  SELECT s_suppkey AS k, 'pool_' || s_suppkey AS instance_pool_id,
    s_name AS instance_pool_name,
    CASE WHEN s_suppkey % 3 <> 0 THEN 'SPOT' ELSE 'None' END AS aws_attributes_availability,
    CASE WHEN s_suppkey % 2 = 0 THEN '100' ELSE 'None' END
      AS aws_attributes_spot_bid_price_percent,
    'zone-' || (s_suppkey % 4) AS aws_attributes_zone_id,
    {worker("s_suppkey")} AS node_type_id,
    CASE WHEN s_suppkey % 2 = 0 THEN '{{"team":"t' || (s_suppkey % 10) || '"}}' ELSE 'None' END
      AS custom_tags
  FROM supplier)"""

# How each task names its cluster, then the value of every definition column per way.
_WAYS = """
named AS (
  SELECT job_id, run_id, task_key, mp, mp % 9 AS way, (mp // 9) % 3 AS shared,
    CASE WHEN mp % 9 IN (0, 1, 7) THEN mp % 150 END AS apc,
    CASE WHEN mp % 9 = 6 THEN mp % 120
      WHEN mp % 9 IN (2, 3) AND (mp // 9) % 3 = 1 AND run_id % 13 <> 0 THEN run_id % 120 END
      AS pool,
    CASE WHEN mp % 9 = 6 AND mp % 2 = 0 THEN (mp + 1) % 120 WHEN mp % 9 = 6 THEN mp % 120
      WHEN mp % 9 IN (2, 3) AND (mp // 9) % 3 = 1 AND run_id % 13 <> 0 THEN run_id % 120 END
      AS driver_pool
  FROM run_lines),
ways AS (
  SELECT t.*,
    CASE WHEN way <= 1 AND a.k IS NOT NULL THEN 'listed'
      WHEN (way <= 1 OR way = 7) AND f.k IS NOT NULL THEN 'fetched'
      WHEN mp IS NULL THEN 'nothing'
      WHEN way <= 1 THEN 'lost' WHEN way = 7 THEN 'no instance' WHEN way = 8 THEN 'nothing'
      WHEN way IN (4, 5) THEN 'plain'
      WHEN way = 6 THEN CASE WHEN p.k IS NULL THEN 'no pool' ELSE 'pooled' END
      WHEN run_id % 13 = 0 OR shared = 2 THEN 'no key'
      WHEN shared = 0 THEN 'shared plain'
      WHEN p.k IS NULL THEN 'no pool' ELSE 'shared pooled' END AS found
  FROM named t
  LEFT JOIN apc a ON a.is_listed AND a.k = t.apc
  LEFT JOIN apc f ON NOT f.is_listed AND f.k = t.apc
  LEFT JOIN pools p ON p.k = t.pool)"""

_OF_DEFINITION = {
    "aws_attributes_availability": """CASE found WHEN 'plain' THEN 'SPOT'
      WHEN 'shared plain' THEN 'None' ELSE p.aws_attributes_availability END""",
    "enable_elastic_disk": """CASE WHEN found <> 'shared plain' THEN 'None'
      WHEN run_id % 2 = 0 THEN 'True' ELSE 'False' END""",
    "enable_local_disk_encryption": _NULL,
    "workload_type_jobs": "'None'",
    "aws_attributes_ebs_volume_count": "CAST(0 AS BIGINT)",
    "aws_attributes_ebs_volume_iops": "CAST(0 AS BIGINT)",
    "aws_attributes_ebs_volume_size": "CAST(0 AS BIGINT)",
    "aws_attributes_ebs_volume_throughput": "CAST(0 AS BIGINT)",
    "aws_attributes_ebs_volume_type": "'None'",
    "aws_attributes_first_on_demand":
        "CASE WHEN found = 'plain' THEN CAST(mp % 3 AS VARCHAR) END",
    "aws_attributes_spot_bid_price_percent": "p.aws_attributes_spot_bid_price_percent",
    "aws_attributes_instance_profile_arn": _NULL,
    "aws_attributes_zone_id": """CASE WHEN found = 'plain' THEN 'zone-' || (mp % 4)
      ELSE p.aws_attributes_zone_id END""",
    "driver_node": f"""CASE WHEN found = 'plain' AND mp % 2 = 0 THEN {driver("mp")}
      WHEN found = 'plain' THEN {worker("mp")} WHEN found = 'shared plain' THEN
      {worker("run_id")} ELSE d.node_type_id END""",
    "worker_node": f"""CASE found WHEN 'plain' THEN {worker("mp")} WHEN 'shared plain' THEN
      {worker("run_id")} ELSE p.node_type_id END""",
    "num_workers": """CASE WHEN found = 'plain' OR (found = 'pooled' AND mp % 7 <> 0)
      THEN CAST(mp % 9 AS VARCHAR) WHEN found = 'shared plain' THEN CAST(run_id % 9 AS VARCHAR)
      ELSE '0' END""",
    "autoscale_min": "CASE WHEN found = 'shared pooled' THEN '1' ELSE '0' END",
    "autoscale_max":
        "CASE WHEN found = 'shared pooled' THEN CAST(run_id % 8 AS VARCHAR) ELSE '0' END",
    "spark_version": _NULL,
    "policy_id": _NULL,
    "instance_pool_id": "CASE WHEN pool IS NULL THEN 'None' ELSE 'pool_' || pool END",
    "autotermination_minutes": """CASE WHEN found = 'plain' AND mp % 4 = 0
      THEN CAST(mp % 60 AS VARCHAR) ELSE 'None' END""",
    "runtime_engine": "'None'",
    "spark_conf": "'None'",
    "custom_tags": """CASE WHEN found = 'shared plain'
      THEN '{"team":"t' || (run_id % 10) || '"}' ELSE 'None' END""",
}

_DEFINED_SQL = ",\n    ".join(f"{_OF_DEFINITION[c]} AS {c}" for c in DEFINITION_COLUMNS)
_KNOWN_SQL = ", ".join(f"a.{c}" for c in DEFINITION_COLUMNS)

_RESOLVED = f"""
{RUNS}, {_APC}, {_POOLS}, {_WAYS},
resolved AS (
SELECT job_id, run_id, task_key, a.cluster_id AS cluster_identifier,
  CASE WHEN way <= 1 THEN 'All Purpose Compute' ELSE 'Jobs Compute' END AS compute_definition,
  {_KNOWN_SQL}
FROM ways JOIN apc a ON a.k = apc AND a.is_listed = (found = 'listed')
WHERE found IN ('listed', 'fetched')
UNION ALL
SELECT job_id, run_id, task_key,
  CASE WHEN pool IS NULL THEN 'Task Defined' ELSE 'Pool Defined' END, 'Jobs Compute',
  {_DEFINED_SQL}
FROM ways LEFT JOIN pools p ON p.k = pool LEFT JOIN pools d ON d.k = driver_pool
WHERE found IN ('plain', 'shared plain', 'pooled', 'shared pooled'))"""

def _from_exports(workers: str) -> str:
    return f"""
WITH {_RESOLVED},
charged AS (
  SELECT DISTINCT r.job_id, r.run_id, run_name, r.run_type, run_starttime, run_result_state,
    driver_node, worker_node, num_workers, autoscale_min, autoscale_max, duration,
    round(duration / 3600000.0::DOUBLE * d.vcpus
      + duration / 3600000.0::DOUBLE * w.vcpus * {workers}, 2) AS core_hrs
  FROM job_runs r
  JOIN resolved c USING (job_id, run_id, task_key)
  JOIN sizes d ON d.instance_size = split_part(driver_node, '.', -1)
  JOIN sizes w ON w.instance_size = split_part(worker_node, '.', -1)
  WHERE run_starttime >= {epoch_ms(SINCE)} AND run_starttime < {epoch_ms(EXPORT_END)}
    AND run_life_cycle_state <> 'RUNNING')
SELECT '{SINCE} - {EXPORT_END}' AS period, count(DISTINCT run_name) AS jobs,
  count(DISTINCT run_id) AS runs, round(sum(core_hrs), 2) AS core_hrs,
  round(sum(core_hrs) * {365 // (EXPORT_END - SINCE).days}, 2) AS est_annual_core_hrs,
  round(sum(core_hrs) * {365 // (EXPORT_END - SINCE).days} * 0.006::DOUBLE, 2)
    AS est_annual_core_hr_cost
FROM charged"""

_UNRESOLVED = f"""
WITH {RUNS}, {_APC}, {_POOLS}, {_WAYS}
SELECT CAST(job_id AS VARCHAR) AS job_id, CAST(run_id AS VARCHAR) AS run_id, task_key,
  CASE WHEN apc IS NOT NULL THEN 'apc_' || apc ELSE 'unknown' END AS cluster_id,
  CASE found WHEN 'lost' THEN {quoted(NOT_RETRIEVED)} WHEN 'no instance' THEN
    {quoted(NOT_LOOKED_UP)} WHEN 'nothing' THEN {quoted(NOT_DEFINED)} WHEN 'no pool' THEN
    {quoted(NOT_SERIALIZED)} WHEN 'no key' THEN {quoted(NO_SHARED_KEY)} END AS status
FROM ways WHERE found IN ('lost', 'no instance', 'nothing', 'no pool', 'no key')"""

_CLUSTER_INFO = f"""
WITH {_APC}
SELECT cluster_id, 'cluster ' || k AS name,
  CASE WHEN k % 3 = 0 THEN 'user' || (k % 7) END AS creator_user_name,
  CASE WHEN k % 2 = 0 THEN CAST(k * 1024 AS VARCHAR) ELSE 'None' END AS cluster_memory_mb,
  CASE WHEN k % 4 <> 0 THEN CAST(CAST(k % 64 AS DOUBLE) AS VARCHAR) END AS cluster_cores,
  'UI' AS cluster_source, 'True' AS workload_type_notebooks, {", ".join(DEFINITION_COLUMNS)}
FROM apc WHERE is_listed"""

_SINGLE_CLUSTER = f"""
WITH {_APC.replace("true AS is_listed", "false AS is_listed").replace(
    "UNION ALL SELECT 100 + n_nationkey, false FROM nation", "")}
SELECT cluster_id, {", ".join(DEFINITION_COLUMNS)} FROM apc"""

_JOB_INFO = """
SELECT c_custkey AS job_id, 1700000000000 + c_custkey AS created_time,
  CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE 'None' END AS creator_user_name,
  c_name AS name,
  CASE WHEN c_custkey % 5 = 0
    THEN '{"name":"day","default":"' || (c_custkey % 31) || '"}' END AS parameters,
  CASE WHEN c_custkey % 4 = 0 THEN 'PAUSED' ELSE 'None' END AS schedule_paused_status,
  CASE WHEN c_custkey % 2 = 0 THEN '0 0 * * * ?' ELSE 'None' END
    AS schedule_quartz_cron_expression,
  CASE WHEN c_custkey % 2 = 0 THEN 'UTC' ELSE 'None' END AS schedule_timezone_id,
  CAST(CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 + c_custkey % 3 END AS INTEGER) AS task_count,
  CAST(CASE WHEN c_custkey % 4 = 0 OR c_custkey % 7 = 0 THEN 0
    WHEN c_custkey % 3 = 2 THEN 2 ELSE 1 END AS INTEGER) AS job_clusters
FROM customer"""

# Columns of the flattened runs that hold something; all other texts are 'N/A'.
_RUN_COLUMNS = {
    "run_id": "run_id",
    "job_id": "job_id",
    "task_key": "task_key",
    "run_name": "run_name",
    "notebook_task_base_params":
        """CASE WHEN n = 1 THEN '{"k":"' || (mp % 5) || '"}' ELSE 'N/A' END""",
    "notebook_task_path": "CASE WHEN n = 1 THEN '/nb/' || mp ELSE 'N/A' END",
    "notebook_task_source": "CASE WHEN n = 1 THEN 'WORKSPACE' ELSE 'N/A' END",
    "run_job_task_job_id": "CASE WHEN n = 2 THEN CAST(mp AS VARCHAR) ELSE 'N/A' END",
    "spark_jar_task_parameters": """CASE WHEN n = 3 THEN '["a","b"]' ELSE 'N/A' END""",
    "spark_jar_task_jar_uri": "CASE WHEN n = 3 THEN 'jar' || mp ELSE 'N/A' END",
    "spark_python_task_python_file": "CASE WHEN n = 4 THEN 'p' || mp ELSE 'N/A' END",
    "sql_task_query":
        """CASE WHEN n = 5 THEN '{"query_id":"q' || mp || '"}' ELSE 'N/A' END""",
    "dbt_task_as_dict":
        """CASE WHEN n = 6 THEN '{"project_directory":"d' || mp || '"}' ELSE 'N/A' END""",
    "task_duration": "duration",
    "task_state": "run_result_state",
    "task_starttime": "run_starttime",
    "task_endtime": "CAST(NULL AS BIGINT)",
    "task_setup_duration": "CAST(NULL AS BIGINT)",
    "task_cleanup_duration": "CAST(NULL AS BIGINT)",
    "task_execution_duration": "duration",
    "run_starttime": "run_starttime",
    "run_endtime": "run_endtime",
    "run_type": "CASE WHEN run_id % 10 = 0 THEN 'Unknown' ELSE run_type END",
    "run_execution_duration": "duration",
    "run_life_cycle_state": "run_life_cycle_state",
    "run_result_state": "run_result_state",
}
_RUN_INFO = f"""
WITH {RUNS}
SELECT {", ".join(f"{_RUN_COLUMNS.get(c, quoted('N/A'))} AS {c}" for c in JOB_RUN_INFO.names)}
FROM job_runs"""

# --- job definitions -------------------------------------------------------------


def _definition(shift: str, prefix: str = "") -> str:
    """Columns of the cluster that job ``k`` has at a shift."""
    j = f"(k + {shift})"
    columns = {
        "driver": driver(j),
        "worker": worker(j),
        "workers": f"CASE WHEN {j} % 2 = 1 AND k % 11 <> 0 THEN {j} % 9 END",
        "scale_max": f"CASE WHEN {j} % 2 = 0 THEN {j} % 8 END",
        "attributes":
            "CASE WHEN k % 10 <> 9 THEN 'aws_attributes' ELSE 'azure_attributes' END",
        "on_demand": f"CASE WHEN k % 10 = 9 THEN {j} % 4 ELSE {j} % 5 END",
        "arn": f"CASE WHEN k % 10 <> 9 THEN 'arn:' || ({j} % 3) END",
        "conf": f"""CASE WHEN {j} % 3 = 0 THEN '{{"a":"' || ({j} % 4) || '"}}' ELSE '' END""",
    }
    return ", ".join(f"{sql} AS {prefix}{name}" for name, sql in columns.items())


# Tasks of a job: own cluster at shift 10 * i, shared key, or neither (never here).
_JOBS = """
jobs AS (
  SELECT c_custkey AS k, c_custkey % 4 <> 0 AS multi,
    c_custkey % 4 <> 0 AND c_custkey % 7 <> 0 AS has_shared,
    c_custkey % 3 = 2 AS has_aux,
    CASE WHEN c_custkey % 6 <> 0 THEN 'p' || (c_custkey % 40) END AS project_id
  FROM customer),
job_tasks AS (
  SELECT k, i, CASE (k + i) % 5 WHEN 4 THEN NULL WHEN 3 THEN 'aux' ELSE 'main' END AS shared_key
  FROM jobs, range(1, 4) r(i) WHERE multi AND i <= 1 + k % 3),
first_cluster AS (
  SELECT jobs.*, t.shared_key,
    CASE WHEN NOT multi THEN CASE WHEN k % 12 <> 0 THEN 3 END
      WHEN t.shared_key IS NULL THEN 10
      WHEN has_shared AND t.shared_key = 'main' THEN 0
      WHEN has_shared AND has_aux AND t.shared_key = 'aux' THEN 1 END AS shift
  FROM jobs LEFT JOIN job_tasks t USING (k) WHERE t.i IS NULL OR t.i = 1)"""

_JOB_CLUSTER = f"""
WITH {_JOBS}
SELECT k AS job_id, CASE WHEN shift IS NOT NULL THEN {driver("k + shift")} END AS driver,
  CASE WHEN shift IS NOT NULL THEN {worker("k + shift")} END AS worker,
  CASE WHEN shift IS NULL THEN {quoted(NO_CLUSTER)} END AS cluster_error,
  CASE WHEN shift IS NOT NULL THEN project_id END AS tag
FROM first_cluster"""

_ELIGIBILITY = f"""
WITH {_JOBS},
clusters_of AS (
  SELECT k, count(DISTINCT shared_key) + count(*) FILTER (WHERE shared_key IS NULL) AS n
  FROM job_tasks GROUP BY k),
facts AS (
  SELECT f.k AS job_id, CASE WHEN shift IS NOT NULL THEN project_id END AS project_id,
    (NOT multi) OR n = 1 AS one_cluster, shift IS NOT NULL AS has_cluster,
    shift IS NOT NULL AND f.k % 8 <> 0 AS logs_on_dbfs
  FROM first_cluster f LEFT JOIN clusters_of USING (k)),
checked AS (
  SELECT facts.*, coalesce(s_suppkey % 3 <> 0, false) AS auto_apply
  FROM facts LEFT JOIN supplier ON 'p' || s_suppkey = project_id),
reasons AS (
  SELECT *, CASE WHEN NOT one_cluster THEN {quoted(NOT_ONE_CLUSTER)}
    WHEN NOT has_cluster THEN {quoted(NO_CLUSTER)}
    WHEN project_id IS NULL THEN {quoted(NO_PROJECT)}
    WHEN NOT auto_apply THEN {quoted(NO_AUTO_APPLY)}
    WHEN NOT logs_on_dbfs THEN {quoted(NO_DBFS_LOGS)} END AS reason
  FROM checked)
SELECT job_id, project_id, one_cluster, project_id IS NOT NULL AS has_project, auto_apply,
  logs_on_dbfs, reason IS NULL AS eligible, reason
FROM reasons"""

_PLANNED = f"""
planned AS (
  SELECT k, 'job_clusters' AS source, 'main' AS key, {_definition("0")}
  FROM jobs WHERE has_shared
  UNION ALL SELECT k, 'job_clusters', 'aux', {_definition("1")}
  FROM jobs WHERE has_shared AND has_aux
  UNION ALL SELECT k, 'tasks', 't' || i, {_definition("10 * i")}
  FROM jobs JOIN job_tasks USING (k) WHERE NOT has_shared AND shared_key IS NULL),
new_plan AS (
  SELECT *, 1 + coalesce(scale_max, workers, 0) AS nodes FROM planned)"""


def _plan(on_demand: str) -> str:
    return f"""
WITH {_JOBS}, {_PLANNED}
SELECT k AS job_id, source, key, attributes, {on_demand} AS first_on_demand,
  nodes AS new_first_on_demand
FROM new_plan"""


_NEWEST = f"""
newest AS (
  SELECT 'p' || (user_id % 60) AS project_id, event_id AS e,
    lpad(CAST(event_id AS VARCHAR), 18, '0') AS prediction_id
  FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id % 60 ORDER BY ts DESC, event_id DESC) = 1)"""

_APPLY = f"""
WITH {_JOBS}, {_NEWEST},
old AS (
  SELECT k, project_id, {_definition("0")} FROM jobs WHERE has_shared),
fresh AS (
  SELECT old.*, prediction_id, e, {driver("e")} AS new_driver, {worker("e")} AS new_worker,
    CASE WHEN workers IS NOT NULL THEN CAST(1 + e % 12 AS VARCHAR) ELSE '' END AS new_workers
  FROM old JOIN newest USING (project_id)),
applied AS (SELECT k AS job_id, project_id, prediction_id, 'main' AS cluster_name,
  driver AS driver_before, worker AS worker_before,
  CASE WHEN workers <> 0 THEN CAST(workers AS VARCHAR) ELSE '' END AS num_workers_before,
  CASE WHEN scale_max IS NULL THEN ''
    ELSE '{{"min_workers":1,"max_workers":' || scale_max || '}}' END AS autoscale_before,
  conf AS spark_conf_before,
  new_driver AS driver_after, new_worker AS worker_after, new_workers AS num_workers_after,
  CASE WHEN scale_max IS NULL THEN '' ELSE
    '{{"min_workers":' || (e % 3) || ',"max_workers":' || (3 + e % 7) || '}}' END
    AS autoscale_after,
  '{{"n":"' || (e % 16) || '"}}' AS spark_conf_after,
  new_driver AS written_driver
FROM fresh)
SELECT k AS job_id, CASE WHEN has_shared THEN j.project_id END AS project_id,
  a.job_id IS NOT NULL AS changed, a.* EXCLUDE (job_id, project_id, written_driver),
  CASE WHEN a.job_id IS NOT NULL THEN written_driver WHEN has_shared THEN {driver("k")} END
    AS written_driver
FROM jobs j LEFT JOIN applied a ON a.job_id = k"""

_WEBHOOKS = """
WITH blocks AS (
  SELECT c_custkey AS k, string_agg('t' || i || '{}', ',' ORDER BY i) AS task_blocks
  FROM customer, range(1, 4) r(i)
  WHERE c_custkey % 4 <> 0 AND i <= 1 + c_custkey % 3 AND (c_custkey + i) % 4 = 0
  GROUP BY c_custkey)
SELECT c_custkey AS job_id, CASE WHEN c_custkey % 9 = 0 THEN '{}' END AS job_block,
  coalesce(task_blocks, '') AS task_blocks
FROM customer LEFT JOIN blocks ON k = c_custkey"""

_ENGINE_CONF = '{"spark.master":"local[*, 4]","spark.databricks.cluster.profile":"singleNode"}'
_ONBOARD = f"""
WITH {_JOBS}
SELECT k AS job_id, true AS changed, CAST(CASE WHEN has_aux THEN 3 ELSE 2 END AS INTEGER)
    AS clusters,
  CAST(2 + k % 3 AS INTEGER) AS tasks,
  CASE WHEN k % 8 = 5 THEN '/other.sh,/agent.sh' ELSE '/agent.sh' END AS scripts,
  CAST(CASE WHEN k % 3 = 0 THEN 4 ELSE 3 END AS INTEGER) AS env_vars, 'new' AS host,
  CASE WHEN k % 3 = 0 THEN CAST(k % 4 AS VARCHAR) END AS kept,
  'get_recommendation_cluster' AS cluster_key,
  CASE WHEN k % 10 <> 9 THEN 'arn:' || ((k + CASE WHEN has_aux THEN 1 ELSE 0 END) % 3) END AS arn,
  'PHOTON' AS engine, 'i3.xlarge' AS node, '{_ENGINE_CONF}' AS conf,
  '{{"ResourceClass":"SingleNode"}}' AS tags, '{{}}' AS env,
  '{{"plan":"Standard"}}' AS parameters, 'recommend' AS task_key,
  't' || (1 + k % 3) AS depends_on,
  CASE WHEN (k + 1 + k % 3) % 2 = 0 THEN 'GIT' END AS source
FROM jobs WHERE has_shared
UNION ALL
SELECT k, false, CAST(0 AS INTEGER), CAST(CASE WHEN multi THEN 1 + k % 3 ELSE 0 END AS INTEGER),
  NULL, CAST(NULL AS INTEGER), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  CASE WHEN multi THEN 't' || (1 + k % 3) END, NULL,
  CASE WHEN multi AND (k + 1 + k % 3) % 2 = 0 THEN 'GIT' END
FROM jobs WHERE NOT has_shared"""

_PAIR = "FROM job_runs r JOIN shapes s USING (job_id, task_key)"
_RUN_PAIR = "FROM job_runs r JOIN shapes s USING (job_id, run_id, task_key)"
_COUNTS = """count(DISTINCT r.run_name || r.task_key) AS job_task_count,
  count(DISTINCT r.run_id) AS run_count"""

def _xor_series(value: str) -> str:
    return f"""
WITH bucketed AS (
  SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity / 5) AS INTEGER) AS bucket
  FROM lineitem),
steps AS (
  SELECT bucket, CAST(bucket * i + bucket * j AS BIGINT) AS v, i + 1 + j AS d
  FROM (SELECT DISTINCT bucket FROM bucketed), range(1, {XOR_I}) a(i), range(1, {XOR_J}) b(j)),
summed AS (
  SELECT bucket, round(fsum(xor(v, 2) / d + xor(v, 3) / d + xor(v, 4) / d), 6)
    AS factorial_value
  FROM steps GROUP BY bucket)
SELECT l_orderkey, l_linenumber, bucket, {value} AS factorial_value
FROM bucketed JOIN summed USING (bucket)"""


_DAY = "CAST(make_timestamp(r.run_starttime * 1000) AS DATE)"
_IN_WINDOW = f"r.run_starttime >= {epoch_ms(START)} AND r.run_starttime < {epoch_ms(END)}"


def _random_lines() -> str:
    """The hash rounds of the random columns, one step per CTE."""
    fold, last = "xor(x, x >> 16)", ""
    steps = ["h0 AS (SELECT l_orderkey, l_linenumber, c, key, l_orderkey & 4294967295 AS x,"
             " (l_orderkey >> 32) & 4294967295 AS high FROM lineitem, keys)"]

    def step(x: str) -> None:
        n = len(steps)
        steps.append(f"h{n} AS (SELECT l_orderkey, l_linenumber, c, key, high, {x} AS x FROM h{n - 1})")

    for then in (", high", ", key", None):
        for factor in (*HASH_FACTORS, HASH_FACTORS[0]):
            step(f"({fold} * {factor}) & 4294967295")
        step(f"xor({fold}{then})" if then else fold)
        last = f"h{len(steps) - 1}"
    keys = ", ".join(f"({i}, {column_key(i, RANDOM_SEED)})" for i in range(3))
    columns = ", ".join(
        f"max(x) FILTER (WHERE c = {i}) / 4294967296.0::DOUBLE AS rand_col_{i}" for i in range(3)
    )
    lines = "SELECT l_orderkey, l_linenumber, r, " + columns
    numbered = "lines AS (SELECT *, row_number() OVER () AS r FROM lineitem)"
    body = ", ".join(steps).replace("FROM lineitem, keys", "FROM lines, keys").replace(
        "l_linenumber, c", "l_linenumber, r, c")
    return (f"WITH keys(c, key) AS (VALUES {keys}), {numbered}, {body}"
            f" SELECT * EXCLUDE (r) FROM ({lines} FROM {last} GROUP BY ALL)")


ORACLE: dict[str, str] = {
    "usage_estimate": _estimate("task"),
    "usage_estimate_by_run": _estimate("run"),
    "run_usage": f"WITH {RUNS}, {_usage('task')} SELECT * FROM usage",
    "run_usage_by_run": f"WITH {RUNS}, {_usage('run')} SELECT * FROM usage",
    "all_job_clusters": _ALL_JOB_CLUSTERS,
    "join_clusters": f"""
WITH {RUNS}
SELECT DISTINCT job_id, r.run_id, task_key, compute_definition, driver_node {_PAIR}""",
    "coverage_audit": f"""
WITH {RUNS}
SELECT 'all runs tasks' AS label, (SELECT count(*) FROM
  (SELECT DISTINCT run_id, task_key FROM job_runs)) AS counts
UNION ALL SELECT 'tasks with cluster definition', (SELECT count(*) FROM
  (SELECT DISTINCT run_id, task_key FROM shapes))
UNION ALL SELECT 'tasks with no cluster definition', (SELECT count(*) FROM
  (SELECT DISTINCT run_id, task_key FROM no_shapes))
UNION ALL SELECT 'clusters we couldnt look up', (SELECT count(DISTINCT cluster_id)
  FROM no_shapes)""",
    "result_states": f"""
WITH {RUNS}
SELECT run_result_state, count(*) AS counts FROM job_runs GROUP BY run_result_state""",
    "pool_usage": f"""
WITH {RUNS}, {_POOLS}
SELECT instance_pool_id, instance_pool_name, node_type_id, {_COUNTS}
{_PAIR} JOIN pools USING (instance_pool_id)
GROUP BY instance_pool_id, instance_pool_name, node_type_id""",
    "daily_usage": f"""
WITH {RUNS}
SELECT CAST(make_timestamp(r.run_starttime * 1000) AS DATE) AS day, run_type,
  compute_definition, {_COUNTS}
{_PAIR} GROUP BY day, run_type, compute_definition""",
    "submit_groups": f"""
WITH {RUNS}
SELECT CAST(make_timestamp(r.run_starttime * 1000) AS DATE) AS day, {_TASK_KIND} AS task_type,
  count(DISTINCT r.run_id) AS distinct_run_ids, count(DISTINCT job_id) AS distinct_job_ids
{_PAIR} GROUP BY 1, 2""",
    "dbu_usage": _DBU,
    "coverage": f"""
WITH {RUNS}, roles AS (
  SELECT 'driver' AS role, driver_node AS node FROM shapes
  UNION ALL SELECT 'worker', worker_node FROM shapes)
SELECT role, node, split_part(node, '.', -1) AS instance_size, count(*) AS cluster_rows
FROM roles WHERE split_part(node, '.', -1) NOT IN (SELECT instance_size FROM sizes)
GROUP BY role, node""",
    "resolve_clusters": f"WITH {_RESOLVED} SELECT * FROM resolved",
    "estimate_from_exports": _from_exports("CAST(num_workers AS BIGINT)"),
    # An unset number of workers is 0 in these rows; their largest size is then charged, and
    # it is 0 wherever a number is set.
    "estimate_autoscale": _from_exports("greatest(CAST(num_workers AS BIGINT),"
                                        " CAST(autoscale_max AS BIGINT))"),
    "run_usage_normalized": _NORMALIZED,
    "pool_usage_by_run": f"""
WITH {RUNS}, {_POOLS}
SELECT instance_pool_id, instance_pool_name, node_type_id, {_COUNTS}
{_RUN_PAIR} JOIN pools USING (instance_pool_id)
GROUP BY instance_pool_id, instance_pool_name, node_type_id""",
    "daily_usage_by_run": f"""
WITH {RUNS}
SELECT CAST(make_timestamp(r.run_starttime * 1000) AS DATE) AS day, run_type,
  compute_definition, {_COUNTS}
{_RUN_PAIR} GROUP BY day, run_type, compute_definition""",
    "submit_groups_by_run": f"""
WITH {RUNS}
SELECT CAST(make_timestamp(r.run_starttime * 1000) AS DATE) AS day, {_TASK_KIND} AS task_type,
  count(DISTINCT run_id) AS distinct_run_ids, count(DISTINCT job_id) AS distinct_job_ids
{_RUN_PAIR} GROUP BY 1, 2""",
    "instance_coverage": f"""
WITH {RUNS}, {_usage("run")},
{rows("instances", "instance_type, vcpus, memory, dbus, cloud", INSTANCE_ROWS)},
roles AS (SELECT 'driver' AS role, driver_node AS instance_type FROM usage
  UNION ALL SELECT 'worker', worker_node FROM usage)
SELECT role, instance_type, count(*) AS usage_rows FROM roles
WHERE instance_type NOT IN (SELECT instance_type FROM instances)
GROUP BY role, instance_type""",
    "unresolved_tasks": _UNRESOLVED,
    "normalize_clusters": _CLUSTER_INFO,
    "normalize_pools": f"WITH {_POOLS} SELECT * EXCLUDE (k) FROM pools",
    "cluster_columns": _SINGLE_CLUSTER.replace(
        "CASE WHEN is_listed THEN 'None' END AS instance_pool_id", f"{_NULL} AS instance_pool_id"
    ),
    "normalize_jobs": _JOB_INFO,
    "normalize_runs": _RUN_INFO,
    "scan_runs": f"""
WITH {RUNS}
SELECT DISTINCT run_id, job_id, run_starttime AS start_time,
  run_life_cycle_state AS life_cycle_state
FROM job_runs
WHERE run_starttime >= {epoch_ms(SINCE)} AND run_life_cycle_state <> 'RUNNING'""",
    "terminal_runs": f"""
WITH {RUNS}
SELECT run_id, task_key, run_life_cycle_state FROM job_runs
WHERE run_life_cycle_state IN ('TERMINATED', 'INTERNAL_ERROR', 'SKIPPED')""",
    "task_prefix": f"""
WITH {RUNS}, each_run AS (
  SELECT DISTINCT job_id, run_id, run_starttime, run_result_state FROM job_runs),
numbered AS (
  SELECT *, row_number() OVER w AS run_number,
    count(*) FILTER (WHERE run_result_state <> 'SUCCESS') OVER w AS failures
  FROM each_run
  WINDOW w AS (PARTITION BY job_id ORDER BY run_starttime, run_id
    ROWS UNBOUNDED PRECEDING))
SELECT job_id, run_id, run_starttime, run_result_state, CAST(run_number AS INTEGER)
  AS run_number
FROM numbered WHERE failures = 0 AND run_number <= 10""",
    "exclude_tasks": f"""
WITH {RUNS}
SELECT job_id, run_id, task_key FROM job_runs WHERE task_key NOT IN ('t2', 't5')""",
    "filter_gt": "SELECT l_discount FROM lineitem WHERE l_discount > 0.05::DOUBLE",
    "filter_ne": """
SELECT l_orderkey, l_linenumber, l_partkey, l_discount, l_tax, l_returnflag
FROM lineitem WHERE l_discount <> l_tax""",
    "self_join_value": """
SELECT a.o_totalprice FROM orders a, orders b WHERE a.o_totalprice = b.o_totalprice""",
    "self_join_counts": """
SELECT a.l_extendedprice, count(*) AS pairs
FROM lineitem a JOIN lineitem b ON a.l_extendedprice = b.l_extendedprice
GROUP BY a.l_extendedprice""",
    "id_join": """
SELECT o_orderkey, o_totalprice, l_orderkey, l_quantity, l_extendedprice
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "xor_series_text": _xor_series("CAST(CAST(round(factorial_value, 3) AS DECIMAL(20,3))"
                                   " AS VARCHAR)"),
    "xor_series": _xor_series("factorial_value"),
    "sales_amount": """
SELECT l_orderkey AS InvoiceNo, l_quantity AS Quantity, l_extendedprice AS UnitPrice,
  l_quantity * l_extendedprice AS SalesAmount
FROM lineitem""",
    "wide_random": "SELECT count(*) AS n_rows, "
    + ", ".join(f"count(*) AS rand_col_{i}" for i in range(5))
    + " FROM lineitem",
    "latest_recommendation": f"""
WITH {_NEWEST} SELECT project_id, prediction_id, 1 + e % 12 AS num_workers FROM newest""",
    "job_cluster": _JOB_CLUSTER,
    "eligibility": _ELIGIBILITY,
    "on_demand_plan": _plan("coalesce(on_demand, 0)"),
    "set_on_demand": _plan("nodes"),
    "apply_recommendation": _APPLY,
    "strip_webhooks": _WEBHOOKS,
    "onboard_plan": _ONBOARD,
    "stored_run_usage": f"WITH {RUNS}, {_usage('task')} SELECT * FROM usage",
    "refreshed_states": f"""
WITH {RUNS}
SELECT {_DAY} AS run_day, run_result_state, count(*) AS counts FROM job_runs r
WHERE run_starttime >= {epoch_ms(FETCHED_FROM)} AND run_starttime < {epoch_ms(FETCHED_UNTIL)}
GROUP BY 1, 2""",
    "window_usage": f"""
WITH {RUNS}
SELECT run_type, compute_definition, {_COUNTS} {_PAIR} WHERE {_IN_WINDOW}
GROUP BY run_type, compute_definition""",
    "window_pool_usage": f"""
WITH {RUNS}
SELECT instance_pool_id, {_COUNTS} {_PAIR} WHERE {_IN_WINDOW} AND instance_pool_id <> 'None'
GROUP BY instance_pool_id""",
    "window_submits": f"""
WITH {RUNS}
SELECT {_TASK_KIND} AS task_type, count(DISTINCT r.run_id) AS distinct_run_ids,
  count(DISTINCT job_id) AS distinct_job_ids {_PAIR} WHERE {_IN_WINDOW} GROUP BY 1""",
    "estimate_by_days": _estimate("run"),
    "random_lines": _random_lines(),
    "wide_random_rows": f"""
SELECT rand_col_0, rand_col_1, rand_col_2 FROM ({_random_lines().replace(
        "FROM lineitem)", "FROM (SELECT range AS l_orderkey, 0 AS l_linenumber"
        " FROM range((SELECT count(*) FROM orders))))")})""",
    "xor_series_sql": _xor_series("factorial_value"),
    "unknown_fields": """
SELECT o_orderkey AS run_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 'None' ELSE 'u' || o_custkey END AS owner,
  CAST(CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE o_orderkey % 9 END AS BIGINT) AS level,
  CASE WHEN o_orderkey % 2 = 0 THEN 'a' END AS tag,
  '{"level":' || CASE WHEN o_orderkey % 4 = 0 THEN '"high"' ELSE CAST(o_orderkey % 9 AS VARCHAR) END
  || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ',"owner":"u' || o_custkey || '"' END || '}' AS extra
FROM orders""",
}
