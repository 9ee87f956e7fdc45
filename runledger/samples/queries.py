"""Every operator as a query over the order tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.functions.expr import epoch_ms, is_terminal
from runledger.operators import jobdefs, normalize, reports, resolve, usage, workload
from runledger.plans.estimate import annual_estimate, usage_tables
from runledger.samples import orders
from runledger.samples.stored import STORED_QUERIES

START, END = orders.WINDOW
SINCE, EXPORT_END = dt.date(1998, 1, 1), dt.date(1998, 7, 1)
XOR_I, XOR_J = 1000, 500

ONBOARD = jobdefs.OnboardParams(
    init_script="/agent.sh",
    env_vars={"TOKEN": "secret", "PROJECT": "p", "HOST": "new"},
    notebook_path="/recommend",
    task_key="recommend",
    base_parameters={"plan": "Standard"},
)


def usage_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annual_estimate(
        orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir, started=True),
        orders.sizes(spark), START, END,
    )


def usage_estimate_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annual_estimate(
        orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir), orders.sizes(spark),
        START, END, match="run",
    )


def run_usage(spark: SparkSession, sf_dir: str, match: str = "task") -> DataFrame:
    return usage.run_usage(
        orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir), orders.sizes(spark), match
    )


def run_usage_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_usage(spark, sf_dir, "run")


def all_job_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.all_job_clusters(orders.with_cluster(spark, sf_dir))


def join_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = orders.runs(spark, sf_dir).select("job_id", "run_id", "task_key")
    return usage.join_clusters(
        runs, orders.with_cluster(spark, sf_dir), ["compute_definition", "driver_node"]
    )


def coverage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage_audit(
        orders.runs(spark, sf_dir),
        orders.with_cluster(spark, sf_dir),
        orders.without_cluster(spark, sf_dir),
    )


def result_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.result_states(orders.runs(spark, sf_dir))


def pool_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.pool_usage(
        orders.runs(spark, sf_dir),
        orders.with_cluster(spark, sf_dir),
        orders.pools(spark, sf_dir),
    )


def daily_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_usage(orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir))


def submit_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.submit_groups(orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir))


def pool_usage_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.pool_usage(
        orders.runs(spark, sf_dir),
        orders.with_cluster(spark, sf_dir),
        orders.pools(spark, sf_dir),
        match="run",
    )


def daily_usage_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_usage(
        orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir), "run"
    )


def submit_groups_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.submit_groups(
        orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir), "run"
    )


def run_usage_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of which every third has node types of another cloud's form."""
    named = orders.with_cluster(spark, sf_dir).withColumns({
        name: F.expr(orders.standard_name(name)) for name in ("driver_node", "worker_node")
    })
    return usage.run_usage(
        orders.runs(spark, sf_dir), named, orders.standard_sizes(spark), "run",
        normalize_size=True,
    )


def instance_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.instance_coverage(run_usage(spark, sf_dir, "run"), orders.instances(spark))


def dbu_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.dbu_usage(
        run_usage(spark, sf_dir, "run"), orders.instances(spark), rate=0.2
    )


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.size_coverage(orders.with_cluster(spark, sf_dir), orders.sizes(spark))


# --- from nested exports ---------------------------------------------------------


def _resolved(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return resolve.resolve_clusters(
        orders.nested_runs(spark, sf_dir),
        normalize.normalize_clusters(orders.listed_clusters(spark, sf_dir)),
        normalize.normalize_pools(orders.listed_pools(spark, sf_dir)),
        orders.fetched_clusters(spark, sf_dir),
    )


def resolve_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir)[0]


def unresolved_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir)[1]


def estimate_from_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the nested exports through every step to the estimate of half a year."""
    tables = usage_tables(
        orders.nested_runs(spark, sf_dir),
        orders.listed_clusters(spark, sf_dir),
        orders.listed_pools(spark, sf_dir),
        orders.job_definitions(spark, sf_dir),
        SINCE,
        orders.fetched_clusters(spark, sf_dir),
    )
    return annual_estimate(
        tables["job_run_info"], resolve.with_cluster(tables["resolved_tasks"]),
        orders.sizes(spark), SINCE, EXPORT_END, match="run",
    )


def estimate_autoscale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same estimate, with clusters without a worker count charged for their largest size."""
    tables = usage_tables(
        orders.nested_runs(spark, sf_dir),
        orders.listed_clusters(spark, sf_dir),
        orders.listed_pools(spark, sf_dir),
        orders.job_definitions(spark, sf_dir),
        SINCE,
        orders.fetched_clusters(spark, sf_dir),
        missing_workers="None",
    )
    return annual_estimate(
        tables["job_run_info"], resolve.with_cluster(tables["resolved_tasks"]),
        orders.sizes(spark), SINCE, EXPORT_END, match="run",
    )


def normalize_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize_clusters(orders.listed_clusters(spark, sf_dir))


def normalize_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize_pools(orders.listed_pools(spark, sf_dir))


def cluster_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = orders.listed_clusters(spark, sf_dir)
    columns = normalize.cluster_columns(clusters.schema)
    return clusters.select("cluster_id", *(c.alias(name) for name, c in columns.items()))


def normalize_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = normalize.normalize_jobs(orders.job_definitions(spark, sf_dir))
    return jobs.withColumn("parameters", F.array_join("parameters", ","))


def normalize_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize_runs(orders.nested_runs(spark, sf_dir))


def scan_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.scan_runs(orders.nested_runs(spark, sf_dir), epoch_ms(SINCE)).select(
        "run_id", "job_id", "start_time", "state.life_cycle_state"
    )


def terminal_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        orders.runs(spark, sf_dir)
        .where(is_terminal("run_life_cycle_state"))
        .select("run_id", "task_key", "run_life_cycle_state")
    )


def task_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = orders.order_lines(spark, sf_dir).select(
        "job_id", "run_id", "run_starttime", "run_result_state"
    )
    return jobdefs.success_prefix(runs, 10)


def exclude_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = orders.runs(spark, sf_dir).select("job_id", "run_id", "task_key")
    return jobdefs.exclude_tasks(tasks, ["t2", "t5"])


# --- synthetic load --------------------------------------------------------------


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.read(spark, sf_dir, "lineitem")


def filter_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workload.filter_gt(_items(spark, sf_dir), "l_discount", 0.05).select("l_discount")


def filter_ne(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workload.filter_ne(_items(spark, sf_dir), "l_discount", "l_tax").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax", "l_returnflag"
    )


def self_join_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workload.self_join_on(orders.read(spark, sf_dir, "orders"), "o_totalprice")


def self_join_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = workload.self_join_counts(_items(spark, sf_dir), "l_extendedprice")
    return counts.withColumn("pairs", F.col("pairs").cast("bigint"))


def id_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = orders.read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    right = _items(spark, sf_dir).select("l_orderkey", "l_quantity", "l_extendedprice")
    return workload.join_on_id(left, right, "o_orderkey", "l_orderkey")


def xor_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucketed = _items(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.floor(F.col("l_quantity") / 5).cast("int").alias("bucket")
    )
    return workload.xor_series(bucketed, "bucket", XOR_I, XOR_J).withColumn(
        "factorial_value", F.round("factorial_value", 6)
    )


def xor_series_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expensive function as text; whole numbers of it, so that texts can be compared."""
    bucketed = _items(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.floor(F.col("l_quantity") / 5).cast("int").alias("bucket")
    )
    text = workload.xor_series(bucketed, "bucket", XOR_I, XOR_J, as_text=True)
    whole = F.round(F.col("factorial_value").cast("double"), 3).cast("decimal(20,3)")
    return text.withColumn("factorial_value", whole.cast("string"))


def sales_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir).select(
        F.col("l_orderkey").alias("InvoiceNo"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_extendedprice").alias("UnitPrice"),
    )
    return workload.sales_amount(items)


def wide_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five random columns beside every line: all rows are there, all values in [0, 1)."""
    names = [f"rand_col_{i}" for i in range(5)]
    drawn = workload.random_columns(_items(spark, sf_dir).select("l_orderkey"), 5, seed=7, row_id="l_orderkey")
    return drawn.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.count_if((F.col(c) >= 0) & (F.col(c) < 1)).alias(c) for c in names),
    )


# --- job definitions -------------------------------------------------------------


def latest_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = jobdefs.latest_recommendation(orders.recommendations(spark, sf_dir))
    return newest.select("project_id", "prediction_id", "configuration.num_workers")


def job_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = jobdefs.job_cluster(orders.job_definitions(spark, sf_dir))
    return jobdefs.job_tag(jobs, orders.PROJECT_TAG).select(
        "job_id",
        F.col("cluster.driver_node_type_id").alias("driver"),
        F.col("cluster.node_type_id").alias("worker"),
        "cluster_error",
        "tag",
    )


def eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobdefs.eligibility(
        orders.job_definitions(spark, sf_dir), orders.projects(spark, sf_dir), orders.PROJECT_TAG
    )


def on_demand_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobdefs.on_demand_plan(orders.job_definitions(spark, sf_dir))


def set_on_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = jobdefs.set_on_demand(orders.job_definitions(spark, sf_dir))
    return jobdefs.on_demand_plan(changed)


def apply_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    applied = jobdefs.apply_recommendation(
        orders.job_definitions(spark, sf_dir),
        orders.recommendations(spark, sf_dir),
        orders.PROJECT_TAG,
    )
    cluster = F.get("settings.job_clusters", 0)["new_cluster"]
    return applied.withColumn("written_driver", cluster["driver_node_type_id"]).drop("settings")


def strip_webhooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    def blocks(tasks: str) -> Column:
        return F.filter(tasks, lambda t: t["webhook_notifications"].isNotNull())

    stripped = jobdefs.strip_webhooks(orders.job_definitions(spark, sf_dir))
    return stripped.select(
        "job_id",
        F.to_json("settings.webhook_notifications").alias("job_block"),
        F.coalesce(
            F.array_join(
                F.transform(
                    blocks("settings.tasks"),
                    lambda t: F.concat(t["task_key"], F.to_json(t["webhook_notifications"])),
                ),
                ",",
            ),
            F.lit(""),
        ).alias("task_blocks"),
    )


def onboard_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = jobdefs.onboard_plan(orders.job_definitions(spark, sf_dir), ONBOARD)
    first = F.get("settings.job_clusters", 0)["new_cluster"]
    last = F.element_at("settings.job_clusters", -1)
    task = F.element_at("settings.tasks", -1)
    return plan.select(
        "job_id",
        "changed",
        F.coalesce(F.size("settings.job_clusters"), F.lit(0)).alias("clusters"),
        F.coalesce(F.size("settings.tasks"), F.lit(0)).alias("tasks"),
        F.array_join(
            F.transform(first["init_scripts"], lambda s: s["workspace"]["destination"]), ","
        ).alias("scripts"),
        F.size(first["spark_env_vars"]).alias("env_vars"),
        first["spark_env_vars"]["HOST"].alias("host"),
        F.try_element_at(first["spark_env_vars"], F.lit("KEEP")).alias("kept"),
        last["job_cluster_key"].alias("cluster_key"),
        last["new_cluster"]["aws_attributes"]["instance_profile_arn"].alias("arn"),
        last["new_cluster"]["runtime_engine"].alias("engine"),
        last["new_cluster"]["node_type_id"].alias("node"),
        F.to_json(last["new_cluster"]["spark_conf"]).alias("conf"),
        F.to_json(last["new_cluster"]["custom_tags"]).alias("tags"),
        F.to_json(last["new_cluster"]["spark_env_vars"]).alias("env"),
        F.to_json(task["notebook_task"]["base_parameters"]).alias("parameters"),
        task["task_key"].alias("task_key"),
        F.get(task["depends_on"], 0)["task_key"].alias("depends_on"),
        task["notebook_task"]["source"].alias("source"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        usage_estimate, usage_estimate_by_run, run_usage, run_usage_by_run, all_job_clusters,
        join_clusters, coverage_audit, result_states, pool_usage, daily_usage, submit_groups,
        pool_usage_by_run, daily_usage_by_run, submit_groups_by_run, run_usage_normalized,
        dbu_usage, instance_coverage, coverage, estimate_autoscale, resolve_clusters, unresolved_tasks, estimate_from_exports,
        normalize_clusters,
        normalize_pools, cluster_columns, normalize_jobs, normalize_runs, scan_runs,
        terminal_runs, task_prefix, exclude_tasks, filter_gt, filter_ne, self_join_value,
        self_join_counts, id_join, xor_series, xor_series_text, sales_amount, wide_random, latest_recommendation,
        job_cluster, eligibility, on_demand_plan, set_on_demand, apply_recommendation,
        strip_webhooks, onboard_plan,
    )
} | STORED_QUERIES
