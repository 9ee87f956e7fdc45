"""Joins that hold when one key has a large share of all rows.

Two rules are used throughout the library:

* a side is broadcast only after its size has been measured (``fits_broadcast``);
* a join of two large sides is cut into bounded parts for keys with many rows
  (``split_join``), so no task ever receives a whole hot key.

Where the rows of a table are known, shuffles get as many partitions as keep their tasks at
``TASK_ROWS`` (``dealt``), so that a task's memory does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
)

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20

SPLIT_ROWS = 4_000_000
TASK_ROWS = 500_000
MIN_SPLIT_ROWS = 1_000_000  # below it, hot keys may be too many to broadcast unmeasured
PART, COLUMN = "_part", "_column"


def _width(df: DataFrame) -> Column:
    """About the bytes of a row: texts and binaries by length, nested values as JSON."""
    width = F.lit(8 * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            text = F.to_json(F.struct(F.col(f.name)))
            width = width + F.coalesce(F.octet_length(text), F.lit(0))
    return width


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a lookup table: True if it is small enough for every executor to hold.

    Each task counts its rows and bytes; one row per task is all that is moved.
    """
    rows, size = df.select(_width(df).alias("width")).agg(
        F.count(F.lit(1)), F.sum("width")
    ).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of about so many ``rows``, dealt by ``keys`` to partitions of ``TASK_ROWS``. Where
    the cores alone make parts as small, Spark chooses."""
    parts = -(-rows // TASK_ROWS)
    if parts <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(parts, *keys)


def hot_keys(
    df: DataFrame, keys: Sequence[str], split_rows: int = SPLIT_ROWS, parts: str = "_parts"
) -> DataFrame:
    """Keys with more than ``split_rows`` rows and the number of parts to cut them into.

    Each such key has that many rows, so there are fewer than ``rows / split_rows`` of them:
    250,000 at most in a table of a trillion rows, which every executor can hold.
    """
    counts = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") > split_rows).select(
        *keys, F.ceil(F.col("_rows") / split_rows).cast("int").alias(parts)
    )


def measured_keys(
    df: DataFrame, keys: Sequence[str], split_rows: int = SPLIT_ROWS
) -> tuple[DataFrame, int]:
    """The rows of :func:`hot_keys`, fetched, and the number of rows of all keys. The count is
    made once, when the query is built; at least ``MIN_SPLIT_ROWS`` keep the list short."""
    counts = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    parts = F.ceil(F.col("_rows") / split_rows).cast("int").alias("_parts")
    hot = F.when(F.col("_rows") > split_rows, F.struct(*keys, parts))
    total, found = counts.agg(F.sum("_rows"), F.collect_list(hot)).first()
    schema = StructType([*df.select(*keys).schema.fields, StructField("_parts", IntegerType())])
    return df.sparkSession.createDataFrame([tuple(row) for row in found], schema), total or 0


def split_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    by: Sequence[str],
    how: str = "inner",
    split_rows: int = SPLIT_ROWS,
    key: Sequence[str] | None = None,
    counted: DataFrame | None = None,
    right_by: Sequence[str] | None = None,
    hot: DataFrame | None = None,
    rows: int = 0,
    split: bool = True,
) -> DataFrame:
    """Equi-join of ``left`` with ``right`` in which hot keys are split.

    Rows of a hot key of ``left`` are dealt to parts by the hash of the ``by`` columns and the
    rows of ``right`` are repeated once per part, for hot keys only. In an inner join the same
    is done the other way round for keys with many rows in ``right``, dealt by ``right_by``:
    a key then is a grid of parts, none with more than about ``split_rows`` rows of either
    side. Without ``right_by`` the right side is taken to have few rows per key. Rows whose
    key is NULL match nothing; an inner or semi join drops them and a left join spreads them.

    ``key`` names the columns of ``on`` whose rows are counted (default: all); fewer columns
    make the count cheaper and split a little more. ``counted`` is the table in which they
    are counted (default: ``left``); give it where a cheaper one has the same keys. ``hot`` has
    the keys and their ``_parts`` where they were counted before, and ``rows`` how many ``left`` has.
    Without ``split`` no key is hot and no row is NULL: nothing is dealt or repeated.
    """
    on = list(on)
    if not split:
        return left.join(right, on, how)
    key = list(key or on)
    if hot is None:
        hot = hot_keys(left if counted is None else counted, key, split_rows)
    # Few keys have so many rows, unless the caller lowers the bound: then they are measured.
    bounded = split_rows >= MIN_SPLIT_ROWS
    hot = F.broadcast(hot) if bounded or fits_broadcast(hot) else hot
    parts = F.coalesce("_parts", F.lit(1))
    row = F.hash(*by)
    part = F.pmod(row, parts)

    if how == "left":
        # No row of the other side has to be repeated for these, so every hash is a part.
        no_key = F.lit(False)
        for name in on:
            no_key = no_key | F.col(name).isNull()
        part = F.when(no_key, row).otherwise(part)
    else:
        left = left.dropna(subset=on)

    left = left.join(hot, key, "left").withColumn(PART, part).drop("_parts")
    right = (
        right.dropna(subset=on)
        .join(hot, key, "left")
        .withColumn(PART, F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("_parts")
    )
    if how != "inner" or not right_by:
        return dealt(left, rows, *on, PART).join(right, [*on, PART], how).drop(PART)

    # Counted before the rows were repeated, which would count them once per part.
    wide = hot_keys(right.where(F.col(PART) == 0), on, split_rows, "_wide")
    wide = F.broadcast(wide) if bounded or fits_broadcast(wide) else wide
    columns = F.coalesce("_wide", F.lit(1))
    left = left.join(wide, on, "left").withColumn(
        COLUMN, F.explode(F.sequence(F.lit(0), columns - 1))
    ).drop("_wide")
    right = right.join(wide, on, "left").withColumn(
        COLUMN, F.pmod(F.hash(*right_by), columns)
    ).drop("_wide")
    left = dealt(left, rows, *on, PART, COLUMN)
    return left.join(right, [*on, PART, COLUMN]).drop(PART, COLUMN)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    by: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    split_rows: int = SPLIT_ROWS,
    counted: DataFrame | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Attach the row of ``dim`` with the same ``on``; ``dim`` has one row per key.
    Broadcast when ``dim`` is measured small, otherwise a split shuffle join. ``small`` gives
    the outcome of a measurement that was already made."""
    if fits_broadcast(dim, max_rows) if small is None else small:
        return df.join(F.broadcast(dim), on, how)
    return split_join(df, dim, [on], by, how, split_rows, counted=counted)


NUMBERED = "_number_in_group"


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], path: str) -> DataFrame:
    """``df`` with the number of each row in its group (``NUMBERED``, from 1) by ``order``, NULLs
    first; NULL groups are groups. No task sees a whole group: rows are dealt to ranges of
    (group, order) and stored under ``path``; a range numbers its own rows and adds those that
    the group has in earlier ranges. A group has at most one count per range."""
    ranged = df.repartitionByRange(*group, *order).withColumn(PART, F.spark_partition_id())
    ranged.write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.schema(ranged.schema).parquet(path)
    counts = stored.groupBy(PART, *group).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("_before", F.sum("_rows").over(earlier))
    # Only groups that go on in a later range need to be told of earlier rows.
    before = before.where(F.col("_before").isNotNull()).select(
        F.col(PART).alias("_range"), "_before",
        *(F.col(name).alias(f"_of_{i}") for i, name in enumerate(group)),
    )
    # Ranges are in order, so a range begins in at most one such group: a row for each range.
    same = F.col(PART) == F.col("_range")
    for i, name in enumerate(group):
        same &= F.col(name).eqNullSafe(F.col(f"_of_{i}"))
    own = F.row_number().over(Window.partitionBy(PART, *group).orderBy(*order))
    return (
        stored.withColumn("_own", own)
        .join(F.broadcast(before), same, "left")
        .withColumn(NUMBERED, F.col("_own") + F.coalesce("_before", F.lit(0).cast("long")))
        .select(*df.columns, NUMBERED)
    )
