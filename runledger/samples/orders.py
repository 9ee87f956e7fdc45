"""Usage tables derived from an order schema, so that every operator can be run at any
scale on the same data. An order is a run, its customer the job, its lines the tasks.

``lineitem`` is shuffled once, by order key, which serves the grouping by line, the list of an
order's lines and the join with ``orders``. Any line number counts, and a line without a part
key is a line. Columns are given as SQL text: there are many, and all are plain.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from runledger.operators.skew import dealt
from runledger.schemas import (
    AUTOSCALE,
    AWS_ATTRIBUTES,
    AZURE_ATTRIBUTES,
    CLUSTER_DEFINITION,
    EDITABLE_DEFINITION,
    EDITABLE_JOB_CLUSTER,
    FLEET_SIZE,
    INIT_SCRIPT,
    INSTANCES,
    JOB,
    JOB_CLUSTER,
    JOB_RUN_CLUSTER_INFO,
    JOB_RUN_INFO,
    JOB_RUN_NO_CLUSTER_INFO,
    JOB_TASK,
    LISTED_CLUSTER,
    LISTED_POOL,
    POOLS_INFO,
    PROJECT,
    RECOMMENDATION,
    RUN,
    RUN_TASK,
    WEBHOOKS,
)

# Node types and sizes of the derived clusters. 'metal' is not a listed size.
DRIVER_NODES = (
    "m5.large", "m5.xlarge", "r5.2xlarge", "r5.4xlarge", "m-fleet.xlarge", "m5.metal",
)
WORKER_NODES = ("m5.xlarge", "m5.2xlarge", "i3.4xlarge", "c5.9xlarge", "m5.large")
SIZES = (("large", 2), ("xlarge", 4), ("2xlarge", 8), ("4xlarge", 16), ("9xlarge", 36))
INSTANCE_ROWS = (
    ("m5.large", 2, 8, 0.34, "AWS"),
    ("m5.xlarge", 4, 16, 0.69, "AWS"),
    ("m5.2xlarge", 8, 32, 1.37, "AWS"),
    ("r5.2xlarge", 8, 64, 1.8, "AWS"),
    ("r5.4xlarge", 16, 128, 3.6, "AWS"),
    ("i3.4xlarge", 16, 122, 4.0, "AWS"),
)
TASK_COLUMNS = (
    "notebook_task_path", "run_job_task_job_id", "spark_jar_task_jar_uri",
    "spark_python_task_python_file", "sql_task_query", "dbt_task_as_dict",
)
PROJECT_TAG = "project-id"
# The window of the estimates.
WINDOW = (dt.date(1997, 3, 1), dt.date(1997, 3, 31))

LIFE_CYCLE = (
    "CASE WHEN o_orderkey % 5 = 0 THEN 'INTERNAL_ERROR' WHEN o_orderkey % 7 = 0 THEN 'RUNNING'"
    " ELSE 'TERMINATED' END"
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"get(array({listed}), CAST(({index}) % {len(values)} AS INT))"


def driver(index: str) -> str:
    return pick(DRIVER_NODES, index)


def worker(index: str) -> str:
    return pick(WORKER_NODES, index)


def when(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


def record(schema: StructType, **columns: str) -> str:
    """Struct of a schema with the given fields; the others are NULL."""
    fields = ", ".join(
        f"'{f.name}', CAST({columns.get(f.name, 'NULL')} AS {f.dataType.simpleString()})"
        for f in schema.fields
    )
    return f"named_struct({fields})"


def _table(df: DataFrame, schema: StructType, **columns: str) -> DataFrame:
    return df.selectExpr(
        *(
            f"CAST({columns.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema.fields
        )
    )


def _nested(df: DataFrame, schema: StructType, **columns: str) -> DataFrame:
    """Like :func:`_table`, with every record built once, as if it were read from a file:
    otherwise Spark would build it again in each expression that reads a field of it."""
    return df.selectExpr(f"inline(array({record(schema, **columns)}))")


RUN_SQL = (
    "o_custkey AS job_id",
    "o_orderkey AS run_id",
    "'job_' || (o_custkey % 97) AS run_name",
    "CAST(unix_date(CAST(o_orderdate AS DATE)) AS BIGINT) * 86400000"
    " + (o_orderkey % 96) * 900000 AS run_starttime",
    "(1 + o_orderkey % 16) * 900000 AS duration",
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'SUBMIT_RUN'"
    " WHEN '2-HIGH' THEN 'WORKFLOW_RUN' ELSE 'JOB_RUN' END AS run_type",
    f"{LIFE_CYCLE} AS run_life_cycle_state",
    "CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILED'"
    " ELSE 'CANCELED' END AS run_result_state",
)


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order key and line number: its smallest part key. Orders follow the
    partitions of the lines, of which the files say how many there are."""
    items = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    items = dealt(items, items.count(), "l_orderkey")
    return (
        items.groupBy("l_orderkey", "l_linenumber")
        .agg(F.min("l_partkey").alias("mp"))
        .withColumnRenamed("l_linenumber", "n")
    )


def _with_orders(spark: SparkSession, sf_dir: str, items: DataFrame, *columns: str) -> DataFrame:
    joined = read(spark, sf_dir, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.selectExpr(*RUN_SQL, *columns)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order that has lines: ``lines``, its line numbers in order with the smallest
    part key of each."""
    lines = F.array_sort(F.collect_list(F.struct("n", "mp"))).alias("lines")
    listed = _items(spark, sf_dir).groupBy("l_orderkey").agg(lines)
    return _with_orders(spark, sf_dir, listed, "lines")


def run_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (order, line number): ``n`` and ``mp``, its smallest part key."""
    return _with_orders(spark, sf_dir, _items(spark, sf_dir), "n", "mp")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {
        name: f"CASE WHEN n = {i} THEN 'x' ELSE 'N/A' END"
        for i, name in enumerate(TASK_COLUMNS, start=1)
    }
    return _table(
        run_lines(spark, sf_dir),
        JOB_RUN_INFO,
        run_id="run_id",
        job_id="job_id",
        task_key="'t' || n",
        run_name="run_name",
        task_starttime="run_starttime",
        task_endtime="run_starttime + duration",
        run_starttime="run_starttime",
        run_endtime="run_starttime + duration",
        run_type="run_type",
        run_life_cycle_state="run_life_cycle_state",
        run_result_state="run_result_state",
        **kinds,
    )


def with_cluster(spark: SparkSession, sf_dir: str, started: bool = False) -> DataFrame:
    """The cluster table; ``started`` adds when the run started, as resolved tasks have it."""
    schema = JOB_RUN_CLUSTER_INFO
    if started:
        schema = StructType([*schema.fields, StructField("run_starttime", LongType())])
    return _table(
        run_lines(spark, sf_dir).where("mp % 11 <> 0"),
        schema,
        run_starttime="run_starttime",
        job_id="job_id",
        run_id="run_id",
        task_key="'t' || n",
        cluster_identifier="'c' || mp",
        compute_definition="CASE WHEN mp % 3 = 0 THEN 'All Purpose Compute'"
        " ELSE 'Jobs Compute' END",
        enable_local_disk_encryption=when("mp % 2 = 0", "'true'"),
        aws_attributes_ebs_volume_count="mp % 4",
        driver_node=driver("mp"),
        worker_node=worker("mp"),
        num_workers="CASE WHEN mp % 7 = 0 THEN 'None' ELSE CAST(mp % 9 AS STRING) END",
        autoscale_min="'0'",
        autoscale_max="CASE WHEN mp % 7 = 0 THEN CAST(2 + mp % 8 AS STRING) ELSE '0' END",
        instance_pool_id="CASE WHEN mp % 4 = 0 THEN 'pool_' || (mp % 10) ELSE 'None' END",
    )


def without_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(
        run_lines(spark, sf_dir).where("mp % 11 = 0"),
        JOB_RUN_NO_CLUSTER_INFO,
        job_id="job_id",
        run_id="run_id",
        task_key="'t' || n",
        cluster_id="CASE WHEN mp % 2 = 0 THEN 'unknown' ELSE 'c' || mp END",
        status="'Not defined and no cluster instance'",
    )


def _values(spark: SparkSession, rows: tuple[tuple, ...], schema: StructType) -> DataFrame:
    listed = ", ".join(str(row) for row in rows)
    df = spark.sql(f"SELECT * FROM VALUES {listed} AS t({', '.join(schema.names)})")
    return _table(df, schema, **{name: name for name in schema.names})


def sizes(spark: SparkSession) -> DataFrame:
    return _values(spark, SIZES, FLEET_SIZE)


def standard_name(column: str) -> str:
    """Every third node type in the form ``Standard_<size>_v2``, by part of the name."""
    size = f"substring_index({column}, '.', -1)"
    return f"CASE WHEN run_id % 3 = 0 THEN 'Standard_' || {size} || '_v2' ELSE {column} END"


def standard_sizes(spark: SparkSession) -> DataFrame:
    """The sizes, once more by the catalogue's name for the other form."""
    own = sizes(spark)
    return own.union(own.selectExpr("instance_size || ' v2'", "vcpus"))


def instances(spark: SparkSession) -> DataFrame:
    return _values(spark, INSTANCE_ROWS, INSTANCES)


def pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(
        read(spark, sf_dir, "supplier"),
        POOLS_INFO,
        instance_pool_id="'pool_' || s_suppkey",
        instance_pool_name="s_name",
        node_type_id=worker("s_suppkey"),
    )


# --- nested exports --------------------------------------------------------------


def nested_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs whose tasks name their cluster in every possible way, by part key modulo 9."""
    shared_plain = record(
        JOB_CLUSTER,
        job_cluster_key="'shared_0'",
        new_cluster=record(
            CLUSTER_DEFINITION,
            node_type_id=worker("run_id"),
            num_workers="run_id % 9",
            enable_elastic_disk="run_id % 2 = 0",
            custom_tags="map('team', 't' || (run_id % 10))",
        ),
    )
    shared_pooled = record(
        JOB_CLUSTER,
        job_cluster_key="'shared_1'",
        new_cluster=record(
            CLUSTER_DEFINITION,
            instance_pool_id="'pool_' || (run_id % 120)",
            autoscale=record(AUTOSCALE, min_workers="1", max_workers="run_id % 8"),
        ),
    )
    plain = record(
        CLUSTER_DEFINITION,
        aws_attributes=record(
            AWS_ATTRIBUTES,
            availability="'SPOT'",
            first_on_demand="l.mp % 3",
            zone_id="'zone-' || (l.mp % 4)",
        ),
        driver_node_type_id=when("l.mp % 2 = 0", driver("l.mp")),
        node_type_id=worker("l.mp"),
        num_workers="l.mp % 9",
        autotermination_minutes=when("l.mp % 4 = 0", "l.mp % 60"),
    )
    pooled = record(
        CLUSTER_DEFINITION,
        instance_pool_id="'pool_' || (l.mp % 120)",
        driver_instance_pool_id=when("l.mp % 2 = 0", "'pool_' || ((l.mp + 1) % 120)"),
        num_workers=when("l.mp % 7 <> 0", "l.mp % 9"),
    )

    def kind(n: int, name: str, **columns: str) -> str:
        return when(f"l.n = {n}", record(RUN_TASK[name].dataType, **columns))

    task = record(
        RUN_TASK,
        task_key="'t' || l.n",
        existing_cluster_id=when("l.mp % 9 < 2", "'apc_' || (l.mp % 150)"),
        job_cluster_key=when("l.mp % 9 IN (2, 3)", "'shared_' || (l.mp div 9 % 3)"),
        new_cluster=f"CASE WHEN l.mp % 9 IN (4, 5) THEN {plain}"
        f" WHEN l.mp % 9 = 6 THEN {pooled} END",
        cluster_instance=when(
            "l.mp % 9 = 7", "named_struct('cluster_id', 'apc_' || (l.mp % 150))"
        ),
        start_time="run_starttime",
        execution_duration="duration",
        state="named_struct('result_state', run_result_state)",
        notebook_task=kind(
            1,
            "notebook_task",
            notebook_path="'/nb/' || l.mp",
            source="'WORKSPACE'",
            base_parameters="map('k', '' || (l.mp % 5))",
        ),
        run_job_task=kind(2, "run_job_task", job_id="l.mp"),
        spark_jar_task=kind(
            3, "spark_jar_task", jar_uri="'jar' || l.mp", parameters="array('a', 'b')"
        ),
        spark_python_task=kind(4, "spark_python_task", python_file="'p' || l.mp"),
        sql_task=kind(5, "sql_task", query="named_struct('query_id', 'q' || l.mp)"),
        dbt_task=kind(6, "dbt_task", project_directory="'d' || l.mp"),
    )
    return _nested(
        order_lines(spark, sf_dir),
        RUN,
        run_id="run_id",
        job_id="job_id",
        run_name="run_name",
        start_time="run_starttime",
        end_time="run_starttime + duration",
        run_type=when("run_id % 10 <> 0", "run_type"),
        execution_duration="duration",
        state="named_struct('life_cycle_state', run_life_cycle_state,"
        " 'result_state', run_result_state)",
        job_clusters=when("run_id % 13 <> 0", f"array({shared_plain}, {shared_pooled})"),
        tasks=f"transform(lines, l -> {task})",
    )


def _cluster_listing(ids: DataFrame) -> DataFrame:
    """Cluster definitions ``apc_<k>`` for the column ``k``."""
    attributes = record(
        AWS_ATTRIBUTES,
        availability="'ON_DEMAND'",
        ebs_volume_count="k % 3",
        first_on_demand="k % 2",
        spot_bid_price_percent=when("k % 2 = 0", "100"),
    )
    return _nested(
        ids,
        LISTED_CLUSTER,
        cluster_id="'apc_' || k",
        cluster_name="'cluster ' || k",
        creator_user_name=when("k % 3 = 0", "'user' || (k % 7)"),
        cluster_memory_mb=when("k % 2 = 0", "k * 1024"),
        cluster_cores=when("k % 4 <> 0", "k % 64"),
        cluster_source="'UI'",
        aws_attributes=when("k % 5 <> 0", attributes),
        enable_elastic_disk=when("k % 3 <> 0", "k % 2 = 0"),
        enable_local_disk_encryption=when("k % 3 <> 1", "k % 2 = 0"),
        workload_type="named_struct('clients', named_struct('jobs', k % 2 = 0,"
        " 'notebooks', true))",
        driver_node_type_id=when("k % 2 = 1", driver("k")),
        node_type_id=worker("k"),
        num_workers=when("k % 4 <> 0", "k % 9"),
        autoscale=when("k % 4 = 0", record(AUTOSCALE, min_workers="1", max_workers="2 + k % 8")),
        autotermination_minutes=when("k % 2 = 0", "k % 60"),
        custom_tags=when("k % 2 = 0", "map('team', 't' || (k % 10))"),
    )


def listed_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cluster_listing(read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS k"))


def fetched_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters that can be fetched singly: 25 of them, partly beyond the listing."""
    nations = read(spark, sf_dir, "nation")
    return _cluster_listing(nations.selectExpr("CAST(100 + n_nationkey AS BIGINT) AS k"))


def listed_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = record(
        LISTED_POOL["aws_attributes"].dataType,
        availability=when("s_suppkey % 3 <> 0", "'SPOT'"),
        spot_bid_price_percent=when("s_suppkey % 2 = 0", "100"),
        zone_id="'zone-' || (s_suppkey % 4)",
    )
    return _nested(
        read(spark, sf_dir, "supplier"),
        LISTED_POOL,
        instance_pool_id="'pool_' || s_suppkey",
        instance_pool_name="s_name",
        aws_attributes=attributes,
        node_type_id=worker("s_suppkey"),
        custom_tags=when("s_suppkey % 2 = 0", "map('team', 't' || (s_suppkey % 10))"),
    )


def job_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job per customer."""

    def cluster(shift: int) -> str:
        j = f"(k + {shift})"
        script = record(
            INIT_SCRIPT,
            workspace="named_struct('destination',"
            " CASE WHEN k % 8 = 1 THEN '/agent.sh' ELSE '/other.sh' END)",
        )
        aws = record(
            AWS_ATTRIBUTES,
            first_on_demand=when(f"{j} % 5 <> 0", f"{j} % 5"),
            instance_profile_arn=f"'arn:' || ({j} % 3)",
        )
        azure = record(AZURE_ATTRIBUTES, first_on_demand=f"{j} % 4")
        autoscale = record(AUTOSCALE, min_workers="1", max_workers=f"{j} % 8")
        logs = "named_struct('dbfs', named_struct('destination', 'dbfs:/logs/' || k))"
        return record(
            EDITABLE_DEFINITION,
            aws_attributes=when("k % 10 <> 9", aws),
            azure_attributes=when("k % 10 = 9", azure),
            driver_node_type_id=driver(j),
            node_type_id=worker(j),
            num_workers=when(f"{j} % 2 = 1 AND k % 11 <> 0", f"{j} % 9"),
            autoscale=when(f"{j} % 2 = 0", autoscale),
            runtime_engine="'PHOTON'",
            spark_conf=when(f"{j} % 3 = 0", f"map('a', '' || ({j} % 4))"),
            custom_tags=when("k % 6 <> 0", f"map('{PROJECT_TAG}', 'p' || (k % 40))"),
            cluster_log_conf=when("k % 8 <> 0", logs),
            init_scripts=when("k % 4 = 1", f"array({script})"),
            spark_env_vars=when("k % 3 = 0", "map('HOST', 'old', 'KEEP', '' || (k % 4))"),
        )

    def hooks(shift: int) -> str:
        return record(WEBHOOKS, on_success=f"array(named_struct('id', 'h' || (k + {shift})))")

    def task(i: int) -> str:
        notebook = record(
            JOB_TASK["notebook_task"].dataType, notebook_path="'/nb/' || k", source="'GIT'"
        )
        return record(
            JOB_TASK,
            task_key=f"'t{i}'",
            job_cluster_key=f"CASE (k + {i}) % 5 WHEN 4 THEN NULL WHEN 3 THEN 'aux'"
            " ELSE 'main' END",
            new_cluster=when(f"(k + {i}) % 5 = 4", cluster(10 * i)),
            notebook_task=when(f"(k + {i}) % 2 = 0", notebook),
            webhook_notifications=when(f"(k + {i}) % 4 = 0", hooks(i)),
        )

    def shared(key: str, shift: int) -> str:
        return record(EDITABLE_JOB_CLUSTER, job_cluster_key=f"'{key}'", new_cluster=cluster(shift))

    schedule = record(
        JOB["settings"].dataType["schedule"].dataType,
        pause_status=when("k % 4 = 0", "'PAUSED'"),
        quartz_cron_expression="'0 0 * * * ?'",
        timezone_id="'UTC'",
    )
    settings = record(
        JOB["settings"].dataType,
        name="c_name",
        format="CASE WHEN k % 4 <> 0 THEN 'MULTI_TASK' ELSE 'SINGLE_TASK' END",
        parameters=when(
            "k % 5 = 0", "array(named_struct('name', 'day', 'default', '' || (k % 31)))"
        ),
        schedule=when("k % 2 = 0", schedule),
        new_cluster=when("k % 4 = 0 AND k % 12 <> 0", cluster(3)),
        tasks=when(
            "k % 4 <> 0",
            f"slice(array({task(1)}, {task(2)}, {task(3)}), 1, CAST(1 + k % 3 AS INT))",
        ),
        job_clusters=when(
            "k % 4 <> 0 AND k % 7 <> 0",
            f"slice(array({shared('main', 0)}, {shared('aux', 1)}), 1, IF(k % 3 = 2, 2, 1))",
        ),
        webhook_notifications=when("k % 9 = 0", hooks(0)),
    )
    return _nested(
        read(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "k"),
        JOB,
        job_id="k",
        created_time="1700000000000 + k",
        creator_user_name=when("k % 3 = 0", "c_mktsegment"),
        settings=settings,
    )


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(
        read(spark, sf_dir, "supplier"),
        PROJECT,
        project_id="'p' || s_suppkey",
        auto_apply_recs="s_suppkey % 3 <> 0",
    )


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as recommendations for the project of their user."""
    configuration = record(
        RECOMMENDATION["configuration"].dataType,
        driver_node_type_id=driver("event_id"),
        node_type_id=worker("event_id"),
        num_workers="1 + event_id % 12",
        autoscale=record(AUTOSCALE, min_workers="event_id % 3", max_workers="3 + event_id % 7"),
        spark_conf="map('n', '' || (event_id % 16))",
    )
    return _nested(
        read(spark, sf_dir, "events"),
        RECOMMENDATION,
        prediction_id="lpad(CAST(event_id AS STRING), 18, '0')",
        project_id="'p' || (user_id % 60)",
        created_at="ts",
        configuration=configuration,
    )
