"""Fields of records of any shape, rejected rows, the SQL function and random columns."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from runledger.functions.fields import variant_field
from runledger.operators import workload
from runledger.schemas import FLEET_SIZE, INSTANCES, ONLINE_RETAIL
from runledger.sources import readers


def test_fields_outside_the_schema_are_readable(spark, tmp_path):
    path = tmp_path / "runs.json"
    lines = [
        {"run_id": 1, "new": {"deep": [{"x": 5}, {"x": "six"}]}, "flag": True},
        {"run_id": "two", "new": {"deep": []}, "flag": None, "text": ""},
        {"other": 1},
    ]
    path.write_text("\n".join(map(json.dumps, lines)) + "\n")
    records = readers.read_records(spark, str(path))
    found = records.select(
        variant_field("record", "run_id", 0).alias("run_id"),
        variant_field("record", "new.deep[0].x", 7).alias("x"),
        variant_field("record", "new.deep[1].x", to="bigint").alias("y"),
        variant_field("record", "new.deep[1].x", "None").alias("z"),
        variant_field("record", "flag", False).alias("flag"),
        variant_field("record", "new").alias("new"),
        variant_field("record", "text", "None").alias("text"),
    ).collect()
    assert [tuple(r) for r in found] == [
        (1, 5, None, "six", True, '{"deep":[{"x":5},{"x":"six"}]}', "None"),
        (0, 7, None, "None", False, '{"deep":[]}', ""),
        (0, 7, None, "None", False, None, "None"),
    ]


def test_damaged_record_fails(spark, tmp_path):
    path = tmp_path / "runs.json"
    path.write_text('{"run_id": 1}\n{"run_id": 2, "tas\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.read_records(spark, str(path)).collect()


def test_misfits_are_reported(spark, tmp_path):
    path = tmp_path / "instances.csv"
    path.write_text(
        "instance_type,vcpus,memory,dbus,cloud\nm5.large,2,8,0.34,AWS\nx1,four,30,2,Azure\n"
        "x2,4,30.5,2,Azure\nx3,4,,2,\nx4,4,16\nx5,4,16,1,AWS,more\n"
    )
    good, rejects = readers.read_checked(spark, str(path), INSTANCES)
    assert good.schema == INSTANCES
    assert [tuple(r) for r in good.collect()] == [("m5.large", 2, 8, 0.34, "AWS"), ("x3", 4, None, 2.0, None)]
    found = {r["reason"]: r["row"] for r in rejects.where("reason NOT LIKE 'wrong%'").collect()}
    assert set(found) == {"vcpus is not a bigint: four", "memory is not a bigint: 30.5"}
    assert json.loads(found["vcpus is not a bigint: four"])["instance_type"] == "x1"
    wrong = [r["row"] for r in rejects.where(F.col("reason") == readers.WRONG_COLUMNS).collect()]
    assert sorted(wrong) == ["x4,4,16", "x5,4,16,1,AWS,more"]


def test_sizes_and_retail_rejects(spark, tmp_path):
    sizes = tmp_path / "sizes.csv"
    sizes.write_text("instance_size,vcpus\nlarge,2\nD3 v2,\nmetal,many\n")
    good, rejects = readers.read_checked(spark, str(sizes), FLEET_SIZE)
    assert good.count() == 2 and [r["reason"] for r in rejects.collect()] == ["vcpus is not a bigint: many"]
    sheet = tmp_path / "retail.csv"
    sheet.write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        '536365,85123A,"HEART, ""WHITE""",6,2010-12-01 08:26:00,2.55,17850,United Kingdom\n'
        "C536379,D,,-1,yesterday,27.5,,France\n"
    )
    good, rejects = readers.read_checked(spark, str(sheet), ONLINE_RETAIL)
    assert good.first()["Description"] == 'HEART, "WHITE"' and good.count() == 1
    assert rejects.first()["reason"] == "InvoiceDate is not a timestamp: yesterday"


def test_function_by_name_equals_the_expression(spark):
    workload.register_xor_series(spark, "complex_number", 30, 40)
    workload.register_xor_series(spark, "complex_text", 30, 40, as_text=True)
    ids = spark.range(0, 40).select(F.when(F.col("id") != 3, F.col("id")).alias("x"))
    ids.createOrReplaceTempView("ids_of_function")
    found = spark.sql("SELECT x, complex_number(x) AS v, complex_text(x) AS t FROM ids_of_function")
    want = workload.xor_series(ids, "x", 30, 40, "v").join(
        workload.xor_series(ids, "x", 30, 40, "t", as_text=True), "x", "left"
    )
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and found.where("x IS NULL").first()["v"] is None
    # The loop that the closed form stands for.
    x = 9
    total = sum(((x * (i + j) ^ 2) + (x * (i + j) ^ 3) + (x * (i + j) ^ 4)) / (i + 1 + j)
                for i in range(1, 30) for j in range(1, 40))
    assert found.where("x = 9").first()["v"] == pytest.approx(total, rel=1e-12)


def test_random_columns_follow_the_row_only(spark):
    def values(df):
        return sorted(map(tuple, workload.random_columns(df, 4, seed=-3).collect()), key=str)

    ids = spark.range(-500, 3000)
    one = values(ids.repartition(1))
    assert one == values(ids.repartition(13)) == values(ids.orderBy(F.desc("id")).coalesce(3))
    assert workload.random_columns(ids, 4, 5).first() != workload.random_columns(ids, 4, 6).first()
    columns = np.array([r[1:] for r in one])
    assert ((columns >= 0) & (columns < 1)).all() and len(np.unique(columns)) > 0.999 * columns.size
    # Uniform, and columns and neighbouring rows have nothing to do with each other.
    assert np.abs(columns.mean(0) - 0.5).max() < 0.02 and np.abs(columns.var(0) - 1 / 12).max() < 0.01
    assert np.abs(np.corrcoef(columns.T) - np.eye(4)).max() < 0.06
    ordered = np.array([r[1] for r in sorted(one)])
    assert abs(np.corrcoef(ordered[1:], ordered[:-1])[0, 1]) < 0.06
    null = spark.createDataFrame([(None,), (2**62,)], "id bigint")
    first, second = sorted(workload.random_columns(null, 2, 1).collect(), key=lambda r: r["id"] is not None)
    assert tuple(first) == (None, None, None) and 0 <= second[1] < 1


def test_wide_random(spark):
    wide = workload.wide_random(spark, 50, 300, seed=2)
    assert len(wide.columns) == 300 and wide.count() == 50
    assert wide.select("rand_col_299").distinct().count() == 50
