"""Checks and rewrites of whole tables of job definitions. Nothing here calls a service:
a rewrite returns the table with new definitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from runledger.operators.skew import (
    BROADCAST_ROWS,
    NUMBERED,
    SPLIT_ROWS,
    fits_broadcast,
    lookup,
    numbered,
    split_join,
)
from runledger.schemas import JOB_TASK, STRING_MAP, WEBHOOKS
from runledger.sources.scratch import scratch_path

SINGLE_TASK, MULTI_TASK = "SINGLE_TASK", "MULTI_TASK"
SUCCESS = "SUCCESS"

NO_CLUSTER = "No cluster found for the job"
NOT_ONE_CLUSTER = "Job does not have exactly one cluster"
NO_PROJECT = "Cluster tag of the project is missing"
NO_AUTO_APPLY = "Project does not apply recommendations"
NO_DBFS_LOGS = "Cluster logs must be sent to dbfs"


def record(schema: StructType, **values: Column) -> Column:
    """Struct of a schema with the given fields set and all others NULL."""
    return F.struct(
        *(
            values.get(f.name, F.lit(None)).cast(f.dataType.simpleString()).alias(f.name)
            for f in schema.fields
        )
    )


def string_map(values: Mapping[str, str]) -> Column:
    if not values:
        return F.create_map().cast(STRING_MAP)
    return F.create_map(*(F.lit(text) for pair in values.items() for text in pair))


def map_upsert(old: Column, new: Mapping[str, str]) -> Column:
    """``old`` (NULL counts as empty) with the keys of ``new`` set."""
    kept = F.map_filter(old, lambda key, _: ~key.isin(*new))
    return F.map_concat(F.coalesce(kept, string_map({})), string_map(new))


def _cluster() -> Column:
    settings = F.col("settings")
    first = F.get(settings["tasks"], 0)
    shared = F.filter(
        settings["job_clusters"], lambda c: c["job_cluster_key"] == first["job_cluster_key"]
    )
    of_first_task = F.coalesce(first["new_cluster"], F.get(shared, 0)["new_cluster"])
    return F.when(settings["format"] == SINGLE_TASK, settings["new_cluster"]).when(
        settings["format"] == MULTI_TASK, of_first_task
    )


def job_cluster(jobs: DataFrame) -> DataFrame:
    """Adds ``cluster``: the cluster of a single-task job, or that of the first task, its
    own before a shared one. ``cluster_error`` says so where there is none."""
    return jobs.withColumn("cluster", _cluster()).withColumn(
        "cluster_error", F.when(F.col("cluster").isNull(), NO_CLUSTER)
    )


def job_tag(jobs: DataFrame, key: str, name: str = "tag") -> DataFrame:
    """Adds the value of a custom tag of the job's cluster."""
    return jobs.withColumn(name, F.try_element_at(_cluster()["custom_tags"], F.lit(key)))


def _cluster_count() -> Column:
    tasks = F.coalesce("settings.tasks", F.array().cast(ArrayType(JOB_TASK)))
    keys = F.array_compact(F.transform(tasks, lambda t: F.nullif(t["job_cluster_key"], F.lit(""))))
    own = F.filter(
        tasks,
        lambda t: F.nullif(t["job_cluster_key"], F.lit("")).isNull()
        & t["new_cluster"].isNotNull(),
    )
    return F.size(F.array_distinct(keys)) + F.size(own)


def eligibility(
    jobs: DataFrame, projects: DataFrame, project_tag: str, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """One row per job: does it pass each rule for automatic recommendations, and the first
    rule it fails. ``project_tag`` is the cluster tag that holds the project id."""
    facts = job_cluster(jobs).select(
        "job_id",
        F.nullif(
            F.try_element_at(F.col("cluster")["custom_tags"], F.lit(project_tag)), F.lit("")
        ).alias("project_id"),
        ((F.col("settings.format") != MULTI_TASK) | (_cluster_count() == 1)).alias("one_cluster"),
        F.col("cluster").isNotNull().alias("has_cluster"),
        F.col("cluster.cluster_log_conf.dbfs.destination").isNotNull().alias("logs_on_dbfs"),
    )
    flags = projects.groupBy("project_id").agg(F.max("auto_apply_recs").alias("auto_apply"))
    checked = lookup(facts, flags, "project_id", by=["job_id"], split_rows=split_rows)
    one_cluster = F.coalesce("one_cluster", F.lit(True))
    auto_apply = F.coalesce("auto_apply", F.lit(False))
    reason = (
        F.when(~one_cluster, NOT_ONE_CLUSTER)
        .when(~F.col("has_cluster"), NO_CLUSTER)
        .when(F.col("project_id").isNull(), NO_PROJECT)
        .when(~auto_apply, NO_AUTO_APPLY)
        .when(~F.col("logs_on_dbfs"), NO_DBFS_LOGS)
    )
    return checked.select(
        "job_id",
        "project_id",
        one_cluster.alias("one_cluster"),
        F.col("project_id").isNotNull().alias("has_project"),
        auto_apply.alias("auto_apply"),
        "logs_on_dbfs",
        reason.isNull().alias("eligible"),
        reason.alias("reason"),
    )


def _all_on_demand(cluster: Column) -> Column:
    workers = F.when(
        cluster["autoscale"].isNotNull(), cluster["autoscale"]["max_workers"]
    ).otherwise(F.coalesce(cluster["num_workers"], F.lit(0)))
    return workers + 1


def on_demand_plan(jobs: DataFrame) -> DataFrame:
    """One row per cluster of a job: on-demand nodes now, and for running on demand only.
    The clusters are the job's shared ones if it has that list, else those of its tasks."""
    shared = F.transform(
        "settings.job_clusters",
        lambda c: F.struct(
            F.lit("job_clusters").alias("source"),
            c["job_cluster_key"].alias("key"),
            c["new_cluster"].alias("cluster"),
        ),
    )
    own = F.transform(
        "settings.tasks",
        lambda t: F.struct(
            F.lit("tasks").alias("source"),
            t["task_key"].alias("key"),
            t["new_cluster"].alias("cluster"),
        ),
    )
    cluster = F.col("c.cluster")
    is_aws = cluster["aws_attributes"].isNotNull()
    is_azure = cluster["azure_attributes"].isNotNull()
    now = F.when(is_aws, cluster["aws_attributes"]["first_on_demand"]).otherwise(
        cluster["azure_attributes"]["first_on_demand"]
    )
    return (
        jobs.select("job_id", F.explode(F.coalesce(shared, own)).alias("c"))
        .where(cluster.isNotNull())
        .select(
            "job_id",
            "c.source",
            "c.key",
            F.when(is_aws, "aws_attributes")
            .when(is_azure, "azure_attributes")
            .alias("attributes"),
            F.coalesce(now, F.lit(0)).alias("first_on_demand"),
            _all_on_demand(cluster).alias("new_first_on_demand"),
        )
    )


def set_on_demand(jobs: DataFrame) -> DataFrame:
    """The job definitions with :func:`on_demand_plan` carried out."""

    def rewritten(cluster: Column) -> Column:
        aws, azure = cluster["aws_attributes"], cluster["azure_attributes"]
        nodes = _all_on_demand(cluster)
        changed = (
            F.when(
                aws.isNotNull(),
                cluster.withField("aws_attributes", aws.withField("first_on_demand", nodes)),
            )
            .when(
                azure.isNotNull(),
                cluster.withField("azure_attributes", azure.withField("first_on_demand", nodes)),
            )
            .otherwise(cluster)
        )
        return changed

    def each(c: Column) -> Column:
        return c.withField("new_cluster", rewritten(c["new_cluster"]))

    settings = F.col("settings")
    has_shared = settings["job_clusters"].isNotNull()
    return jobs.withColumn(
        "settings",
        settings.withField(
            "job_clusters", F.transform(settings["job_clusters"], each)
        ).withField(
            "tasks",
            F.when(has_shared, settings["tasks"]).otherwise(
                F.transform(settings["tasks"], each)
            ),
        ),
    )


def latest_recommendation(recommendations: DataFrame) -> DataFrame:
    """The newest recommendation of each project, by time and then by id. A maximum is
    combined before the shuffle, so a project with very many rows costs no more."""
    others = [name for name in recommendations.columns if name != "project_id"]
    newest = F.max_by(F.struct(*others), F.struct("created_at", "prediction_id"))
    return (
        recommendations.groupBy("project_id")
        .agg(newest.alias("_newest"))
        .select("project_id", "_newest.*")
        .select(*recommendations.columns)
    )


# Columns that show a cluster before and after a recommendation: a missing value is ''.
def _shown(cluster: Column, stage: str) -> dict[str, Column]:
    texts = {
        "driver": cluster["driver_node_type_id"],
        "worker": cluster["node_type_id"],
        "num_workers": F.nullif(cluster["num_workers"], F.lit(0)).cast("string"),
        "autoscale": F.to_json(cluster["autoscale"]),
        "spark_conf": F.when(
            F.cardinality(cluster["spark_conf"]) > 0, F.to_json(cluster["spark_conf"])
        ),
    }
    return {f"{name}_{stage}": F.coalesce(text, F.lit("")) for name, text in texts.items()}


def apply_recommendation(
    jobs: DataFrame,
    recommendations: DataFrame,
    project_tag: str,
    split_rows: int = SPLIT_ROWS,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All jobs, with the newest recommendation of their project applied to their first shared
    cluster, and what it looked like before and after.

    Node types and Spark settings are always replaced; the number of workers and the
    autoscale range only where they are set. Jobs without a recommendation or without a
    shared cluster keep their settings: ``changed`` is false and the columns that describe a
    change are NULL. So the result can replace the table it was made of.
    """
    newest = latest_recommendation(recommendations).select(
        "project_id", "prediction_id", F.col("configuration").alias("_new")
    )
    first = F.get("settings.job_clusters", 0)
    tag = F.try_element_at(first["new_cluster"]["custom_tags"], F.lit(project_tag))
    matched = lookup(
        jobs.select("*", tag.alias("project_id")), newest, "project_id", ["job_id"],
        max_rows=max_rows, split_rows=split_rows,
    ).withColumn("changed", F.col("_new").isNotNull())

    old, new = F.get("settings.job_clusters", 0)["new_cluster"], F.col("_new")
    # Rebuilt field by field: a chain of withField on a wide struct grows the plan.
    replaced = {
        "driver_node_type_id": new["driver_node_type_id"],
        "node_type_id": new["node_type_id"],
        "num_workers": F.when(old["num_workers"].isNotNull(), new["num_workers"]),
        "autoscale": F.when(old["autoscale"].isNotNull(), new["autoscale"]),
        "spark_conf": new["spark_conf"],
    }
    cluster_type = jobs.schema["settings"].dataType["job_clusters"].dataType.elementType[
        "new_cluster"
    ].dataType
    changed = F.struct(
        *(replaced.get(name, old[name]).alias(name) for name in cluster_type.names)
    )
    clusters = F.transform(
        "settings.job_clusters",
        lambda c, i: F.when(i == 0, c.withField("new_cluster", F.col("_changed"))).otherwise(c),
    )
    shown = {
        "cluster_name": F.coalesce(first["job_cluster_key"], F.lit("")),
        **_shown(F.col("_old"), "before"),
        **_shown(F.col("_changed"), "after"),
    }
    settings = F.col("settings")
    return matched.select("*", changed.alias("_changed"), old.alias("_old")).select(
        "job_id",
        "project_id",
        "prediction_id",
        "changed",
        *(F.when(F.col("changed"), text).alias(name) for name, text in shown.items()),
        F.when(F.col("changed"), settings.withField("job_clusters", clusters))
        .otherwise(settings)
        .alias("settings"),
    )


GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def success_prefix(
    runs: DataFrame,
    n: int,
    group: Sequence[str] = ("job_id",),
    order: Sequence[str] = ("run_starttime", "run_id"),
    state: str = "run_result_state",
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """The runs before the first that did not succeed, at most ``n`` per group.

    They are all among the first ``n`` runs. Up to the session's group limit Spark keeps only
    those of each group before the shuffle. For a larger ``n`` the first failure of each group
    is found by an aggregate, runs from there on are left out, and the rest are numbered range
    by range: a group of any size, that without a key included, passes through many tasks.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    if n > int(runs.sparkSession.conf.get(GROUP_LIMIT, "1000")):
        return _long_prefix(runs, n, group, order, state, split_rows)
    window = Window.partitionBy(*group).orderBy(*order)
    failed = F.when(F.col(state) == SUCCESS, 0).otherwise(1)
    first_n = runs.withColumn("run_number", F.row_number().over(window)).where(
        F.col("run_number") <= n
    )
    up_to_here = Window.partitionBy(*group).orderBy("run_number").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        first_n.withColumn("_failures", F.sum(failed).over(up_to_here))
        .where(F.col("_failures") == 0)
        .drop("_failures")
    )


def _long_prefix(
    runs: DataFrame, n: int, group: Sequence[str], order: Sequence[str], state: str,
    split_rows: int,
) -> DataFrame:
    # The group as a text is never NULL, so rows without a key meet the failures of their group.
    keyed = runs.withColumn("_group", F.to_json(F.struct(*group)))
    place = F.struct(*order)
    failed = ~F.coalesce(F.col(state) == SUCCESS, F.lit(False))
    failures = keyed.where(failed).groupBy("_group").agg(F.min(place).alias("_failure"))
    if fits_broadcast(failures):
        met = keyed.join(F.broadcast(failures), "_group", "left")
    else:
        met = split_join(keyed, failures, ["_group"], by=order, how="left", split_rows=split_rows)
    prefix = met.where(F.col("_failure").isNull() | (place < F.col("_failure"))).select(runs.columns)
    path = scratch_path(runs.sparkSession, "prefix")
    return (
        numbered(prefix, group, order, path)
        .where(F.col(NUMBERED) <= n)
        .withColumn("run_number", F.col(NUMBERED).cast("int"))
        .drop(NUMBERED)
    )


def strip_webhooks(jobs: DataFrame) -> DataFrame:
    """Job definitions whose webhook blocks, where present, are empty."""

    def emptied(holder: Column) -> Column:
        return F.when(holder["webhook_notifications"].isNotNull(), record(WEBHOOKS))

    settings = F.col("settings")
    return jobs.withColumn(
        "settings",
        settings.withField("webhook_notifications", emptied(settings)).withField(
            "tasks",
            F.transform(
                settings["tasks"],
                lambda t: t.withField("webhook_notifications", emptied(t)),
            ),
        ),
    )


@dataclass(frozen=True)
class OnboardParams:
    """What to add to a job. Names, paths and secrets are the caller's."""

    init_script: str
    env_vars: Mapping[str, str]
    notebook_path: str
    task_key: str
    base_parameters: Mapping[str, str] = field(default_factory=dict)
    cluster_env_vars: Mapping[str, str] = field(default_factory=dict)
    # Fixed values of the single-node cluster that the added task runs on.
    cluster_key: str = "get_recommendation_cluster"
    node_type_id: str = "i3.xlarge"
    spark_version: str = "13.0.x-scala2.12"
    custom_tags: Mapping[str, str] = field(default_factory=lambda: {"ResourceClass": "SingleNode"})
    spark_conf: Mapping[str, str] = field(
        default_factory=lambda: {
            "spark.master": "local[*, 4]",
            "spark.databricks.cluster.profile": "singleNode",
        }
    )


def onboard_plan(jobs: DataFrame, params: OnboardParams) -> DataFrame:
    """Job definitions made ready for recommendations.

    The first shared cluster gets the init script, once, and the environment variables; a
    single-node cluster and a task that follows the last task are appended. Jobs without a
    shared cluster or without tasks keep their settings, and ``changed`` is false.
    """
    job = jobs.schema["settings"].dataType
    cluster_type = job["job_clusters"].dataType.elementType
    task_type = job["tasks"].dataType.elementType
    definition = cluster_type["new_cluster"].dataType
    script_type = definition["init_scripts"].dataType

    script = record(
        script_type.elementType,
        workspace=F.struct(F.lit(params.init_script).alias("destination")),
    )

    def prepared(cluster: Column) -> Column:
        scripts = F.coalesce(cluster["init_scripts"], F.array().cast(script_type))
        return cluster.withField(
            "init_scripts",
            F.when(F.array_contains(scripts, script), scripts).otherwise(
                F.array_append(scripts, script)
            ),
        ).withField("spark_env_vars", map_upsert(cluster["spark_env_vars"], params.env_vars))

    settings = F.col("settings")
    last_cluster = F.element_at(settings["job_clusters"], -1)["new_cluster"]
    last_task = F.element_at(settings["tasks"], -1)
    aws = definition["aws_attributes"].dataType
    added_cluster = record(
        cluster_type,
        job_cluster_key=F.lit(params.cluster_key),
        new_cluster=record(
            definition,
            aws_attributes=record(
                aws, instance_profile_arn=last_cluster["aws_attributes"]["instance_profile_arn"]
            ),
            node_type_id=F.lit(params.node_type_id),
            num_workers=F.lit(0),
            runtime_engine=last_cluster["runtime_engine"],
            spark_conf=string_map(params.spark_conf),
            custom_tags=string_map(params.custom_tags),
            spark_env_vars=string_map(params.cluster_env_vars),
            spark_version=F.lit(params.spark_version),
        ),
    )
    added_task = record(
        task_type,
        task_key=F.lit(params.task_key),
        depends_on=F.array(F.struct(last_task["task_key"].alias("task_key"))),
        job_cluster_key=F.lit(params.cluster_key),
        notebook_task=F.struct(
            F.lit(params.notebook_path).alias("notebook_path"),
            last_task["notebook_task"]["source"].alias("source"),
            string_map(params.base_parameters).alias("base_parameters"),
        ),
        timeout_seconds=F.lit(0),
    )
    clusters = F.transform(
        settings["job_clusters"],
        lambda c, i: F.when(
            i == 0, c.withField("new_cluster", prepared(c["new_cluster"]))
        ).otherwise(c),
    )
    ready = (F.size(settings["job_clusters"]) > 0) & (F.size(settings["tasks"]) > 0)
    changed = F.coalesce(ready, F.lit(False))
    prepared_settings = settings.withField(
        "job_clusters", F.array_append(clusters, added_cluster)
    ).withField("tasks", F.array_append(settings["tasks"], added_task))
    return jobs.withColumns({
        "changed": changed,
        "settings": F.when(changed, prepared_settings).otherwise(settings),
    })


def exclude_tasks(df: DataFrame, keys: Sequence[str] | None) -> DataFrame:
    """Task rows but for those with the given keys; empty keys exclude nothing."""
    keys = [key for key in keys or () if key]
    if not keys:
        return df
    return df.where(F.col("task_key").isNull() | ~F.col("task_key").isin(*keys))
