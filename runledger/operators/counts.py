"""Exact distinct counts over any window of days, from daily partials.

Distinct counts of days do not add up, so a report over another window would read all its runs
again. Here every counted value has a number, given once, and a day keeps the set of its
numbers as a bitmap, in words of 64 bits of which the empty ones are left out; sets of days are
or-ed and their bits counted. Numbers are dense and follow the day on which a value is first
seen, so those of a day lie close together and its words are few. Or-ing whole numbers stays in
generated code and combines before the shuffle, which moves words, not rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runledger.operators.skew import SPLIT_ROWS, lookup

DAY = "day"
WORD_BITS = 6  # a word of a bitmap has 2 ** 6 bits


def first_days(rows: DataFrame, value: str, day: str = DAY) -> DataFrame:
    """(``value``, ``first``): each value, an expression in SQL, and the day on which it is first
    seen. NULLs are not counted, so they have no number."""
    return (
        rows.select(F.expr(value).alias("value"), F.col(day).alias("first"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.min("first").alias("first"))
    )


def number_values(firsts: DataFrame, path: str, start: int = 0) -> DataFrame:
    """(``value``, ``number``): numbers from ``start`` in the order of (first day, value).

    Values are range-partitioned and stored under ``path``; ranges are numbered each by itself
    and shifted by the sizes of those before. One row per range is all the driver sees."""
    spark = firsts.sparkSession
    firsts.repartitionByRange("first", "value").withColumn(
        "part", F.spark_partition_id()
    ).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    offsets, total = [], start
    for row in stored.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        offsets.append((row["part"], total))
        total += row["n"]
    shift = spark.createDataFrame(offsets, "part int, shift long")
    own = F.row_number().over(Window.partitionBy("part").orderBy("first", "value"))
    return stored.join(F.broadcast(shift), "part").select(
        "value", (F.col("shift") + own - 1).alias("number")
    )


def extend_numbers(known: DataFrame, firsts: DataFrame, path: str) -> DataFrame:
    """``known`` numbers and those of values that are new, which follow the largest one. Numbers
    once given never change, so partials of earlier days stay right."""
    largest = known.agg(F.max("number")).first()[0]
    new = firsts.join(known.select("value"), "value", "left_anti")
    return known.unionByName(number_values(new, path, 0 if largest is None else largest + 1))


def daily_partials(
    rows: DataFrame,
    dims: Sequence[str],
    measures: Mapping[str, str],
    numbers: Mapping[str, DataFrame],
    day: str = DAY,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """The sets of ``measures`` (expressions in SQL) for each day and ``dims``, one row per word. ``numbers`` has the
    numbered values of each measure. A combination whose values are all NULL has one empty word,
    so that it is still reported."""
    parts = None
    for name, value in measures.items():
        seen = rows.select(day, *dims, F.expr(value).alias("value")).distinct()
        found = lookup(
            seen, numbers[name], "value", [day, *dims], "left", split_rows=split_rows
        )
        number = F.col("number")
        place = number.bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
        part = found.groupBy(
            day, *dims, F.lit(name).alias("measure"),
            F.coalesce(F.shiftright(number, WORD_BITS), F.lit(0).cast("long")).alias("word"),
        ).agg(F.bit_or(F.coalesce(bit, F.lit(0).cast("long"))).alias("bits"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


def store_partials(partials: DataFrame, path: str, day: str = DAY) -> DataFrame:
    """Partials in the order of their days, so that a window reads the files of its days only
    and days with few words share files. Append those of new days to the same path."""
    partials.repartitionByRange(day).sortWithinPartitions(day).write.mode("append").parquet(path)
    return partials.sparkSession.read.schema(partials.schema).parquet(path)


def window_counts(
    partials: DataFrame,
    dims: Sequence[str],
    measures: Sequence[str],
    start: dt.date | None = None,
    end: dt.date | None = None,
    day: str = DAY,
) -> DataFrame:
    """Distinct counts of the days of ``[start, end)`` (all days if not given) by ``dims``, of
    which there may be fewer than the partials have, or none: sets merge over those left out
    just as over days."""
    if start is not None:
        partials = partials.where(F.col(day) >= F.lit(start))
    if end is not None:
        partials = partials.where(F.col(day) < F.lit(end))
    merged = partials.where(F.col("measure").isin(list(measures))).groupBy(
        *dims, "measure", "word"
    ).agg(F.bit_or("bits").alias("bits"))
    counts = (
        F.coalesce(F.sum(F.when(F.col("measure") == m, F.bit_count("bits"))), F.lit(0)).alias(m)
        for m in measures
    )
    return merged.groupBy(*dims).agg(*counts)
