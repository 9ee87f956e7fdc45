"""Readers. Every schema is given, so no reader passes over its files twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from runledger.schemas import (
    FLEET_SIZE,
    INSTANCES,
    JOB,
    LISTED_CLUSTER,
    LISTED_POOL,
    ONLINE_RETAIL,
    PROJECT,
    RECOMMENDATION,
    RUN,
)

# Nested exports that read_export knows.
EXPORTS: dict[str, StructType] = {
    "runs": RUN,
    "clusters": LISTED_CLUSTER,
    "pools": LISTED_POOL,
    "jobs": JOB,
    "projects": PROJECT,
    "recommendations": RECOMMENDATION,
}


def read_instances(spark: SparkSession, path: str) -> DataFrame:
    """Instance catalogue: CSV with header; columns are taken by position."""
    return _csv(spark, path, INSTANCES)


def read_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Size catalogue: CSV with header, size and vcpus."""
    return _csv(spark, path, FLEET_SIZE)


def _csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


def read_retail(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Retail sheet saved as CSV (header, quoted text) or Parquet."""
    reader = spark.read.schema(ONLINE_RETAIL)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", False).option("escape", '"')
    return reader.format(fmt).load(path)


def read_export(spark: SparkSession, kind: str, path: str, fmt: str = "json") -> DataFrame:
    """Nested export of ``kind``, as JSON lines or Parquet. Fields it lacks are NULL.
    A damaged record, or one with a field that does not fit its type, fails the read: as a row
    of NULLs it would be left out of every estimate unseen."""
    if kind not in EXPORTS:
        raise ValueError(f"unknown export {kind!r}; one of {sorted(EXPORTS)}")
    return spark.read.schema(EXPORTS[kind]).option("mode", "FAILFAST").format(fmt).load(path)


def read_records(spark: SparkSession, path: str, column: str = "record") -> DataFrame:
    """JSON lines of any shape, each as a VARIANT: no field is lost for lack of a schema. Fields
    are read with :func:`runledger.functions.fields.variant_field`. A line that is no JSON fails
    the read."""
    return (
        spark.read.format("json").option("singleVariantColumn", column)
        .option("mode", "FAILFAST").load(path)
    )


DAMAGED = "_damaged"
# Reasons for which a row is rejected.
WRONG_COLUMNS = "wrong number of columns"
NOT_A = "{name} is not a {kind}: {value}"


def read_checked(
    spark: SparkSession, path: str, schema: StructType, timestamp_format: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Good rows of a CSV file with header, and the rejected ones as ``reason`` and ``row``.

    Columns are read as text and cast one by one, so a value that does not fit its type is told
    from one that is missing. A row is rejected for its first such value or for a wrong number
    of columns. Every row of the file is in one of the two tables; both read the file when they
    are used."""
    texts = StructType([StructField(f.name, StringType()) for f in schema.fields])
    raw = (
        spark.read.schema(StructType([*texts.fields, StructField(DAMAGED, StringType())]))
        .option("header", True).option("enforceSchema", True).option("escape", '"')
        .option("columnNameOfCorruptRecord", DAMAGED).csv(path)
    )

    def value(field: StructField) -> Column:
        text = F.col(field.name)
        kind = field.dataType.simpleString()
        if kind == "timestamp" and timestamp_format:
            return F.try_to_timestamp(text, F.lit(timestamp_format))
        return text.try_cast(kind)

    misfits = [
        F.when(
            F.col(f.name).isNotNull() & value(f).isNull(),
            F.concat(F.lit(NOT_A.split("{value}")[0].format(name=f.name, kind=f.dataType.simpleString())), F.col(f.name)),
        )
        for f in schema.fields
    ]
    reason = F.coalesce(F.when(F.col(DAMAGED).isNotNull(), WRONG_COLUMNS), *misfits)
    judged = raw.withColumn("_reason", reason)
    good = judged.where(F.col("_reason").isNull()).select(*(value(f).alias(f.name) for f in schema.fields))
    row = F.coalesce(F.col(DAMAGED), F.to_json(F.struct(*schema.names)))
    rejects = judged.where(F.col("_reason").isNotNull()).select(
        F.col("_reason").alias("reason"), row.alias("row")
    )
    return good, rejects
