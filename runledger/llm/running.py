"""Running totals over a whole table, without passing it through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.common import written

PART = "_range"


def running_totals(df: DataFrame, order: list[str | Column], values: dict[str, str]) -> DataFrame:
    """``df`` with, for each ``new: column`` of ``values``, the sum of the column up to and
    including a row in the given order, over all rows.

    Rows are range-partitioned by the order and written; each range is summed, the sums of
    earlier ranges are added to the running totals within a range. The order should be total,
    else ties fall as they come. The sums of ranges, one row per partition, are all that the
    driver sees. ``order`` names columns of ``df``; NULLs come first."""
    spark = df.sparkSession
    ranges = written(
        df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()), "ranges"
    )
    sums = ranges.groupBy(PART).agg(*(F.sum(v).alias(k) for k, v in values.items()))
    before, offsets = dict.fromkeys(values, 0), []
    for row in sums.orderBy(PART).collect():
        offsets.append((row[PART], *(before[k] for k in values)))
        before = {k: before[k] + (row[k] or 0) for k in values}
    schema = f"{PART} int, " + ", ".join(f"_before_{k} long" for k in values)
    offset = spark.createDataFrame(offsets, schema)
    upto = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranges.withColumns({f"_sum_{k}": F.sum(v).over(upto) for k, v in values.items()})
    out = out.join(F.broadcast(offset), PART, "left")
    return out.withColumns({k: F.col(f"_before_{k}") + F.col(f"_sum_{k}") for k in values}).drop(
        PART, *(f"_sum_{k}" for k in values), *(f"_before_{k}" for k in values)
    )
