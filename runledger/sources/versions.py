"""Stored tables in versions: a failed write never harms what is published.

Tables are written to folders of their own; then one row appended to a log names the folder of
each table. Readers take the folders of the newest row, so all tables change together, and a
write that ends before its row leaves the former tables as they were. The log is a JSON table:
a row is one file, which Spark's writer makes visible as a whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "published.log"
LOG_SCHEMA = "version long, writer string, folders map<string,string>"


class Conflict(RuntimeError):
    """Another writer published the same version first."""


def history(spark: SparkSession, path: str) -> list[tuple[int, dict[str, str]]]:
    """Published versions, oldest first, each with the folder of every table."""
    try:
        log = spark.read.schema(LOG_SCHEMA).json(f"{path}/{LOG}")
        # Of two writers of one version the one with the smaller name counts.
        rows = log.groupBy("version").agg(F.min_by("folders", "writer").alias("folders"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [(r["version"], dict(r["folders"])) for r in rows.orderBy("version").collect()]


def published(spark: SparkSession, path: str) -> dict[str, str]:
    """Folder of each table, relative to ``path``; empty if nothing was published."""
    versions = history(spark, path)
    return versions[-1][1] if versions else {}


def new_folder(spark: SparkSession, path: str) -> tuple[int, str]:
    """The next version and a folder for its tables that no other attempt uses."""
    versions = history(spark, path)
    version = versions[-1][0] + 1 if versions else 1
    return version, f"v{version:06d}-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, path: str, version: int, folders: Mapping[str, str]) -> None:
    """Make ``folders`` current; tables that are not among them stay as they were. Raises
    :class:`Conflict` if another writer published this version, whose tables then stand."""
    versions = history(spark, path)
    if versions and versions[-1][0] >= version:
        raise Conflict(f"version {version} of {path} was published by another writer")
    whole = {**(versions[-1][1] if versions else {}), **folders}
    writer = uuid.uuid4().hex
    row = spark.createDataFrame([(version, writer, whole)], LOG_SCHEMA)
    row.coalesce(1).write.mode("append").json(f"{path}/{LOG}")
    log = spark.read.schema(LOG_SCHEMA).json(f"{path}/{LOG}").where(F.col("version") == version)
    if log.agg(F.min("writer")).first()[0] != writer:
        raise Conflict(f"version {version} of {path} was published by another writer")


def read_version(spark: SparkSession, path: str, name: str, version: int | None = None) -> DataFrame:
    """A table as last published, or as of ``version``."""
    versions = dict(history(spark, path))
    if version is not None and version not in versions:
        raise ValueError(f"no version {version} of {path}; there are {sorted(versions)}")
    folders = versions[version if version is not None else max(versions)] if versions else {}
    if name not in folders:
        raise ValueError(f"no table {name!r} in {path}; there are {sorted(folders)}")
    return spark.read.parquet(f"{path}/{folders[name]}")


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the table folders that none of the last ``keep`` versions names, and return them.
    Folders of writes that failed or are not published yet are not known here and stay."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    versions = history(spark, path)
    in_use = {f for _, folders in versions[-keep:] for f in folders.values()}
    old = sorted({f for _, folders in versions[:-keep] for f in folders.values()} - in_use)
    for folder in old:
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return old
