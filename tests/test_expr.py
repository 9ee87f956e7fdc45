import datetime as dt

import pytest
from pyspark.sql import functions as F

from runledger.functions import expr
from runledger.functions.fields import as_text, field, field_type
from runledger.schemas import JOB_RUN_INFO, LISTED_CLUSTER, LONG, STRING, struct


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_missing_field_becomes_default_and_default_sets_the_type(spark):
    schema = struct(a=struct(n=STRING, flag=STRING))
    df = spark.createDataFrame([(("12", "x"),), (("abc", None),), (None,)], schema)
    row = df.select(
        field(df.schema, "a.n", 0).alias("n"),
        field(df.schema, "a.flag", "None").alias("flag"),
        field(df.schema, "a.absent", "N/A").alias("absent"),
        field(df.schema, "a.absent", 0).alias("zero"),
        field(df.schema, "a.flag").alias("raw"),
    ).collect()
    assert [tuple(r) for r in row] == [
        (12, "x", "N/A", 0, "x"),
        (0, "None", "N/A", 0, None),
        (0, "None", "N/A", 0, None),
    ]


def test_field_type_of_unknown_path():
    assert field_type(LISTED_CLUSTER, "aws_attributes.zone_id") == STRING
    assert field_type(LISTED_CLUSTER, "cluster_id.x") is None


def test_booleans_become_text_in_two_ways(spark):
    df = spark.createDataFrame([(True, {"a": "b"})], "b boolean, m map<string,string>")
    b, m = df.schema["b"].dataType, df.schema["m"].dataType
    row = df.select(as_text(F.col("b"), b), F.col("b").cast("string"), as_text(F.col("m"), m))
    assert tuple(row.first()) == ("True", "true", '{"a":"b"}')


def test_provision_method_and_sentinel(spark):
    rows = [("None",), ("0",), ("7",), (None,), ("x",)]
    assert values(spark, rows, "n string", expr.provision_method("n")) == [
        "Autoscale", "Fixed", "Fixed", "Fixed", "Fixed",
    ]
    assert values(spark, rows, "n string", expr.sentinel_long("n")) == [0, 0, 7, None, None]


def test_task_type_takes_the_first_filled_kind(spark):
    names = [name for name, _ in expr.TASK_KINDS]
    rows = [tuple("x" if i >= k else "N/A" for i in range(6)) for k in range(7)]
    found = values(spark, rows, ", ".join(f"{n} string" for n in names), expr.task_type())
    assert found == [label for _, label in expr.TASK_KINDS] + [None]
    assert set(names) <= set(JOB_RUN_INFO.names)


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_day_does_not_depend_on_the_session_zone(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    day = expr.DAY_MS
    rows = [(0,), (day - 1,), (day,), (20_000 * day - 1,), (-1,)]
    epoch = dt.date(1970, 1, 1)
    assert values(spark, rows, "ms bigint", expr.epoch_day("ms")) == [
        epoch + dt.timedelta(n) for n in (0, 0, 1, 19_999, -1)
    ]


def test_window_is_half_open(spark):
    start, end = dt.date(2024, 3, 1), dt.date(2024, 3, 2)
    first = expr.epoch_ms(start)
    rows = [(first - 1,), (first,), (first + expr.DAY_MS - 1,), (first + expr.DAY_MS,)]
    assert values(spark, rows, "ms bigint", expr.in_window("ms", start, end)) == [
        False, True, True, False,
    ]


def test_size_key(spark):
    rows = [("m5.2xlarge",), ("m5.metal",), ("Standard_D3_v2",), (None,), ("a.b.large",)]
    assert values(spark, rows, "n string", expr.size_key("n")) == [
        "2xlarge", "metal", "Standard_D3_v2", None, "large",
    ]
    assert values(spark, rows, "n string", expr.size_key("n", normalize=True)) == [
        "2xlarge", "metal", "D3 v2", None, "large",
    ]


def test_terminal_states(spark):
    rows = [("TERMINATED",), ("INTERNAL_ERROR",), ("SKIPPED",), ("RUNNING",), (None,)]
    assert values(spark, rows, "s string", expr.is_terminal("s")) == [
        True, True, True, False, None,
    ]


def test_blank_counts_as_missing(spark):
    rows = [("a", "b"), ("", "b"), (None, "b")]
    assert values(spark, rows, "x string, y string", expr.blank_as("x", F.col("y"))) == [
        "a", "b", "b",
    ]


def test_sizes_of_ids_are_long():
    assert JOB_RUN_INFO["run_starttime"].dataType == LONG
