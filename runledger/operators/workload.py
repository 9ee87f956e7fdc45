"""Synthetic load: wide random tables, filters, joins on values and an expensive function."""

from __future__ import annotations

from decimal import Decimal
from math import fsum

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EXPAND_BATCH = 4096
# A count of rows has at most 63 bits, its square 126: that is 4096 to the power 10.5. The first
# cut leaves at most 4096 pieces, and so does each one after it.
LARGEST_CUT = 10


# Multipliers of the hash below: odd, and so small that products of 32-bit numbers with them
# stay below 2 ** 63, in every engine and with or without checks for overflow.
HASH_FACTORS = (0x45D9F3B, 0x119DE1F3)
LOW_32 = 0xFFFFFFFF


def _mixed(x: Column, factor: int) -> Column:
    """One round on a 32-bit number held as a long: fold the upper half in, multiply."""
    x = x.bitwiseXOR(F.shiftright(x, 16))
    return (x * F.lit(factor)).bitwiseAND(F.lit(LOW_32))


def _hashed(x: Column) -> Column:
    for factor in (*HASH_FACTORS, HASH_FACTORS[0]):
        x = _mixed(x, factor)
    return x.bitwiseXOR(F.shiftright(x, 16))


def column_key(column: int, seed: int) -> int:
    """32-bit number of a column: the same rounds over the seed, then over the column."""
    x = seed & LOW_32
    for part in (seed >> 32 & LOW_32, column & LOW_32):
        for factor in (*HASH_FACTORS, HASH_FACTORS[0]):
            x = (x ^ x >> 16) * factor & LOW_32
        x = (x ^ x >> 16) ^ part
    for factor in (*HASH_FACTORS, HASH_FACTORS[0]):
        x = (x ^ x >> 16) * factor & LOW_32
    return x ^ x >> 16


def row_key(row_id: Column | str) -> Column:
    """32-bit number of a row id, from both halves of it."""
    row_id = F.col(row_id) if isinstance(row_id, str) else row_id
    low = row_id.bitwiseAND(F.lit(LOW_32))
    high = F.shiftright(row_id, 32).bitwiseAND(F.lit(LOW_32))
    return _hashed(_hashed(low).bitwiseXOR(high))


def random_value(key: Column | str, column: int, seed: int) -> Column:
    """Uniform number in [0, 1) of a row (by :func:`row_key`) and a column: nothing else, so it
    is the same wherever and however often it is computed."""
    key = F.col(key) if isinstance(key, str) else key
    return _hashed(key.bitwiseXOR(F.lit(column_key(column, seed)))) / F.lit(float(1 << 32))


def random_columns(
    df: DataFrame, cols: int, seed: int, prefix: str = "rand_col_", row_id: str = "id"
) -> DataFrame:
    """``df`` with ``cols`` columns of uniform random numbers, made of the row id, the column's
    number and the seed only: the same under any partitioning and on every retry. Numbers have
    32 bits. A NULL id gives NULLs. The rows' keys are computed once, not for each column."""
    keyed = df.withColumn("_row_key", row_key(row_id))
    numbers = (random_value("_row_key", i, seed).alias(f"{prefix}{i}") for i in range(cols))
    return keyed.select(*df.columns, *numbers)


def wide_random(spark: SparkSession, n: int, cols: int, seed: int = 0) -> DataFrame:
    return random_columns(spark.range(n), cols, seed).drop("id")


def filter_gt(df: DataFrame, column: str, value: float) -> DataFrame:
    return df.where(F.col(column) > value)


def filter_ne(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.col(a) != F.col(b))


def self_join_counts(df: DataFrame, column: str) -> DataFrame:
    """Each value of a column and how many rows a join of the table with itself on that
    column has for it: the square of its count. No pair is formed. Counts of pairs are
    decimals of 38 digits, which hold the square of any count."""
    counts = df.dropna(subset=[column]).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    rows = F.col("_rows").cast("decimal(19,0)")
    return counts.select(column, (rows * rows).cast(PAIRS).alias("pairs"))


PAIRS = "decimal(38,0)"


def _pieces(size: int) -> Column:
    """How many pieces of ``size`` pairs a row is cut into."""
    size = F.lit(Decimal(size)).cast(PAIRS)
    return F.call_function("div", F.col("pairs") - 1, size) + 1


def _cut(pairs: DataFrame, size: int) -> DataFrame:
    """Rows cut into pieces that stand for at most ``size`` pairs each."""
    whole = F.lit(Decimal(size)).cast(PAIRS)
    cut = pairs.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), _pieces(size) - 1)))
    rest = F.col("pairs") - F.col("piece").cast("decimal(19,0)") * whole
    return cut.withColumn("pairs", F.least(whole, rest.cast(PAIRS)))


def self_join_on(df: DataFrame, column: str) -> DataFrame:
    """The rows of a join of the table with itself on a column, showing that column.

    Values are counted first and written out as often as the join would give them. Repeated
    values are cut step by step, each step into at most a few thousand pieces, and the pieces
    are dealt to all tasks; so a frequent value is written by many, and no row ever holds more
    than a few thousand copies, whatever the count.
    """
    counts = self_join_counts(df, column)
    pieces = counts.where(F.col("pairs") > 1)
    for power in range(LARGEST_CUT, 1, -1):
        pieces = _cut(pieces, EXPAND_BATCH**power).drop("piece")
        if power == LARGEST_CUT // 2:
            pieces = pieces.withColumn("_spread", F.monotonically_increasing_id())
            pieces = pieces.repartition("_spread").drop("_spread")
    pieces = pieces.withColumn("_spread", F.monotonically_increasing_id())
    pieces = _cut(pieces.repartition("_spread").drop("_spread"), EXPAND_BATCH)
    repeated = pieces.select(
        F.explode(F.array_repeat(F.col(column), F.col("pairs").cast("int"))).alias(column)
    )
    return counts.where(F.col("pairs") == 1).select(column).union(repeated)


def join_on_id(a: DataFrame, b: DataFrame, a_id: str, b_id: str) -> DataFrame:
    """Inner join on ids, keeping the columns of both sides. Left to Spark: it broadcasts a
    side it knows to be small and splits skewed partitions at run time."""
    return a.join(b, F.col(a_id) == F.col(b_id))


def xor_series_terms(i_max: int, j_max: int) -> tuple[float, list[float]]:
    """Slope and the eight offsets of :func:`xor_series`.

    The sum runs over i in 1..i_max-1, j in 1..j_max-1 and each term depends on s = i + j
    only: with v = x*s it is ((v^2) + (v^3) + (v^4)) / (s + 1), ``^`` being exclusive or.
    ``v ^ k`` differs from v by an amount set by the last three bits of v, and those are set
    by x mod 8 and s. So the sum is ``slope * x + offset[x mod 8]``.
    """
    weight = {
        s: min(s - 1, i_max - 1, j_max - 1, i_max + j_max - 1 - s)
        for s in range(2, i_max + j_max - 1)
    }
    slope = fsum(3 * m * s / (s + 1) for s, m in weight.items())

    def shift(low: int) -> int:
        return sum((low ^ k) - low for k in (2, 3, 4))

    offsets = [
        fsum(m * shift(x * s % 8) / (s + 1) for s, m in weight.items()) for x in range(8)
    ]
    return slope, offsets


def xor_series(
    df: DataFrame,
    column: str,
    i_max: int,
    j_max: int = 500,
    name: str = "factorial_value",
    as_text: bool = False,
) -> DataFrame:
    """The expensive function of an integer column, as a built-in expression. NULL stays
    NULL; ``as_text`` gives text, the type of a function registered without one."""
    slope, offsets = xor_series_terms(i_max, j_max)
    low = F.pmod(F.col(column).cast("bigint"), F.lit(8)).cast("int")
    table = F.array(*(F.lit(value) for value in offsets))
    value = F.col(column) * F.lit(slope) + F.get(table, low)
    return df.withColumn(name, value.cast("string") if as_text else value)


def register_xor_series(
    spark: SparkSession, name: str, i_max: int, j_max: int = 500, as_text: bool = False
) -> None:
    """The expensive function of a whole number by ``name`` in the session's SQL text. Its body
    is the closed form, which Spark puts in place of each call: no Python runs."""
    slope, offsets = xor_series_terms(i_max, j_max)
    table = ", ".join(f"{value!r}D" for value in offsets)
    value = f"x * {slope!r}D + get(array({table}), CAST(pmod(x, 8) AS INT))"
    kind = "STRING" if as_text else "DOUBLE"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x BIGINT) RETURNS {kind}"
        f" RETURN CAST({value} AS {kind})"
    )


def sales_amount(df: DataFrame, quantity: str = "Quantity", price: str = "UnitPrice") -> DataFrame:
    return df.withColumn("SalesAmount", F.col(quantity) * F.col(price))
