"""Names, views and stored tables."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.functions.expr import epoch_day
from runledger.operators.resolve import with_cluster, without_cluster
from runledger.sources.versions import new_folder, publish, published, read_version

RUN_DAY = "run_day"
RESOLVED = "resolved_tasks"
BY_DAY = ("job_run_info", "job_run_cluster_info")


def register(tables: Mapping[str, DataFrame]) -> None:
    """Temporary view per table, replacing one of the same name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def split_resolved(resolved: DataFrame, by_day: bool = False) -> dict[str, DataFrame]:
    """The two cluster tables; ``by_day`` adds the day of the run to the first."""
    found = with_cluster(resolved)
    if by_day:
        found = with_run_day(resolved.where(F.col("status").isNull())).select(
            *found.columns, RUN_DAY
        )
    return {"job_run_cluster_info": found, "job_run_no_cluster_info": without_cluster(resolved)}


def with_run_day(runs: DataFrame) -> DataFrame:
    return runs.withColumn(RUN_DAY, epoch_day("run_starttime"))


def write_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    schema: str | None = None,
    path: str | None = None,
    runs_by_day: bool = False,
) -> dict[str, DataFrame]:
    """Store tables, replacing old ones, and return them as read back.

    They become Parquet folders under ``path`` or tables of ``schema``, in a new version that is
    published once all are written: if a write fails, the former tables are still there. In a
    schema a version is a set of tables with its number in their names, and views have the plain
    names. A table of resolved tasks is stored first and then split, so its joins run once; it
    stays, since the cluster tables have to be there by name. ``runs_by_day`` partitions
    ``job_run_info`` and ``job_run_cluster_info`` by the day of the run, for estimates that read
    only their window and refreshes that rewrite only some days (:func:`merge_runs`).
    """
    if (schema is None) == (path is None):
        raise ValueError("give either schema or path")
    if schema is not None:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
        # In order of time, so that older versions can be told by name.
        version, mark = 0, f"v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    else:
        version, mark = new_folder(spark, path)

    def store(name: str, df: DataFrame) -> DataFrame:
        writer = df.write.mode("errorifexists").format("parquet")
        if runs_by_day and name in BY_DAY:
            # Rebalancing gathers the rows of a day, but splits a day too large for one task.
            dated = df if RUN_DAY in df.columns else with_run_day(df)
            by_day = dated.hint("rebalance", RUN_DAY)
            writer = by_day.write.mode("errorifexists").format("parquet").partitionBy(RUN_DAY)
        if schema is not None:
            writer.saveAsTable(f"`{schema}`.`{name}__{mark}`")
            return spark.table(f"`{schema}`.`{name}__{mark}`")
        writer.save(f"{path}/{mark}/{name}")
        return spark.read.parquet(f"{path}/{mark}/{name}")

    stored: dict[str, DataFrame] = {}
    for name, df in tables.items():
        stored[name] = store(name, df)
        if name == RESOLVED:
            for part, rows in split_resolved(stored[name], runs_by_day).items():
                stored[part] = store(part, rows)
    if path is not None:
        publish(spark, path, version, {name: f"{mark}/{name}" for name in stored})
        return stored
    return {name: _show_version(spark, schema, name, mark) for name in stored}


def _show_version(spark: SparkSession, schema: str, name: str, mark: str) -> DataFrame:
    """Point the view of a table at a version. The former version is kept, older ones go."""
    full = f"`{schema}`.`{name}`"
    if spark.catalog.tableExists(full) and spark.catalog.getTable(full).tableType != "VIEW":
        spark.sql(f"DROP TABLE {full}")
    spark.sql(f"CREATE OR REPLACE VIEW {full} AS SELECT * FROM `{schema}`.`{name}__{mark}`")
    versions = sorted(t for t in list_tables(spark, schema) if t.lower().startswith(f"{name.lower()}__v"))
    for old in versions[:-2]:
        spark.sql(f"DROP TABLE IF EXISTS `{schema}`.`{old}`")
    return spark.table(full)


def merge_runs(
    spark: SparkSession,
    path: str,
    name: str,
    rows: DataFrame,
    since: dt.date,
    key: Sequence[str] = ("run_id",),
) -> DataFrame:
    """Merge re-fetched rows of the days from ``since`` on into a table stored by day, and
    return it. A fetched run replaces all rows that the table has of it on that day; runs that
    were not fetched stay. Only partitions of days that ``rows`` has are read and rewritten, by
    dynamic partition overwrite: the other days keep their files."""
    target = f"{path}/{published(spark, path)[name]}"
    stored = spark.read.parquet(target)
    if RUN_DAY not in stored.columns:
        raise ValueError(f"{name} is not stored by day")
    fetched = with_run_day(rows) if RUN_DAY not in rows.columns else rows
    fetched = fetched.where(F.col(RUN_DAY) >= F.lit(since)).select(*stored.columns)
    keys = [*key, RUN_DAY]
    # A look-back has few days: one row each.
    days = F.broadcast(fetched.select(RUN_DAY).distinct())
    kept = (
        stored.where(F.col(RUN_DAY) >= F.lit(since))
        .join(days, RUN_DAY, "left_semi")
        .join(fetched.select(*keys).distinct(), keys, "left_anti")
    )
    merged = kept.select(*stored.columns).unionByName(fetched).hint("rebalance", RUN_DAY)
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        RUN_DAY
    ).parquet(target)
    return spark.read.parquet(target)


def read_tables(spark: SparkSession, path: str, *names: str) -> dict[str, DataFrame]:
    """The tables as last published."""
    return {name: read_version(spark, path, name) for name in names}


def list_tables(spark: SparkSession, schema: str | None = None) -> list[str]:
    return sorted(table.name for table in spark.catalog.listTables(schema))
