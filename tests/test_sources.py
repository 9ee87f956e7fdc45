import datetime as dt
import json

import pytest

from runledger.plans.estimate import annual_estimate, usage_tables
from runledger.samples import orders
from runledger.schemas import RUN
from runledger.sources import readers, tables


def test_catalogues(spark, tmp_path):
    instances = tmp_path / "instances.csv"
    instances.write_text(
        "instance_type,vcpus,memory,dbus,cloud\nm5.large,2,8,0.34,AWS\nx1,4,30.5,2,Azure\n"
    )
    rows = readers.read_instances(spark, str(instances)).collect()
    assert tuple(rows[0]) == ("m5.large", 2, 8, 0.34, "AWS")
    # A number that is not whole does not fit a whole column; the row is kept.
    assert tuple(rows[1]) == ("x1", 4, None, 2.0, "Azure")
    sizes = tmp_path / "sizes.csv"
    sizes.write_text("instance_size,vcpus\nlarge,2\nD3 v2,4\n")
    assert [tuple(r) for r in readers.read_sizes(spark, str(sizes)).collect()] == [
        ("large", 2), ("D3 v2", 4),
    ]


def test_retail(spark, tmp_path):
    sheet = tmp_path / "retail.csv"
    sheet.write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        '536365,85123A,"HEART, ""WHITE""",6,2010-12-01 08:26:00,2.55,17850,United Kingdom\n'
        "C536379,D,,-1,2010-12-01 09:41:00,27.5,,France\n"
    )
    first, second = readers.read_retail(spark, str(sheet)).collect()
    assert (first.Description, first.Quantity, first.UnitPrice) == ('HEART, "WHITE"', 6, 2.55)
    assert first.InvoiceDate == dt.datetime(2010, 12, 1, 8, 26)
    assert (second.InvoiceNo, second.CustomerID, second.Quantity) == ("C536379", None, -1)


def test_export_is_read_with_its_schema(spark, tmp_path):
    path = tmp_path / "runs.json"
    path.write_text(json.dumps({"run_id": 1, "tasks": [{"task_key": "a"}], "extra": 1}) + "\n")
    df = readers.read_export(spark, "runs", str(path))
    assert df.schema == RUN
    assert df.first().tasks[0].task_key == "a"
    with pytest.raises(ValueError, match="unknown export"):
        readers.read_export(spark, "nothing", str(path))


def test_damaged_export_fails(spark, tmp_path):
    path = tmp_path / "runs.json"
    path.write_text('{"run_id": 1}\n{"run_id": 2, "tas\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.read_export(spark, "runs", str(path)).collect()


def test_views(spark):
    tables.register({"sizes_view": orders.sizes(spark)})
    assert spark.sql("SELECT sum(vcpus) FROM sizes_view").first()[0] == 66
    assert "sizes_view" in tables.list_tables(spark)


def test_managed_tables_are_replaced(spark):
    for n in (5, 3):
        stored = tables.write_tables(spark, {"numbers": spark.range(n)}, schema="usage_test")
        assert stored["numbers"].count() == n
    assert "numbers" in tables.list_tables(spark, "usage_test")


def test_one_target(spark, tmp_path):
    with pytest.raises(ValueError, match="either"):
        tables.write_tables(spark, {})
    with pytest.raises(ValueError, match="either"):
        tables.write_tables(spark, {}, schema="a", path=str(tmp_path))


def test_exports_to_estimate(spark, sf_dir, tmp_path):
    """From nested exports through stored tables to the estimate."""
    since = dt.date(1990, 1, 1)
    made = usage_tables(
        orders.nested_runs(spark, sf_dir), orders.listed_clusters(spark, sf_dir),
        orders.listed_pools(spark, sf_dir), orders.job_definitions(spark, sf_dir),
        since, orders.fetched_clusters(spark, sf_dir),
    )
    stored = tables.write_tables(spark, made, path=str(tmp_path), runs_by_day=True)
    runs, with_c = stored["job_run_info"], stored["job_run_cluster_info"]
    without_c = stored["job_run_no_cluster_info"]
    assert with_c.count() + without_c.count() == runs.count() > 0
    again = tables.read_tables(spark, str(tmp_path), "job_run_info", "cluster_info")
    assert again["job_run_info"].count() == runs.count()
    start, end = dt.date(1996, 1, 1), dt.date(1997, 1, 1)
    sizes = orders.sizes(spark)
    stored_estimate = annual_estimate(runs, with_c, sizes, start, end, match="run").first()
    direct = annual_estimate(
        made["job_run_info"],
        tables.split_resolved(made["resolved_tasks"])["job_run_cluster_info"],
        sizes, start, end, match="run",
    ).first()
    assert stored_estimate == direct
    assert stored_estimate.runs > 0
