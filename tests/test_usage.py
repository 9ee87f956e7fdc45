import datetime as dt

import pytest
from pyspark.sql import functions as F

from runledger.functions.expr import epoch_day, epoch_ms
from runledger.operators import reports, usage
from runledger.operators.skew import lookup
from runledger.plans.estimate import annual_estimate, window_runs
from runledger.samples import orders
from runledger.schemas import JOB_RUN_CLUSTER_INFO, JOB_RUN_INFO, POOLS_INFO
from runledger.sources.tables import with_run_day

DAY = epoch_ms(dt.date(2024, 3, 1))
HOUR = 3_600_000


def rows_of(spark, schema, rows):
    names = schema.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def run(job=1, run_id=1, task="t", hours=1.0, name="a", start=DAY, **more):
    return {
        "job_id": job, "run_id": run_id, "task_key": task, "run_name": name,
        "run_type": "JOB_RUN", "run_starttime": start,
        "run_endtime": start + int(hours * HOUR), "run_result_state": "SUCCESS",
    } | more


def cluster(job=1, run_id=1, task="t", driver="m5.large", worker="m5.xlarge", workers="2",
            low="0", high="0", **more):
    return {
        "job_id": job, "run_id": run_id, "task_key": task, "driver_node": driver,
        "worker_node": worker, "num_workers": workers, "autoscale_min": low,
        "autoscale_max": high, "instance_pool_id": "None", "compute_definition": "Jobs Compute",
    } | more


@pytest.fixture
def use(spark):
    def make(runs, clusters, **options):
        df = usage.run_usage(
            rows_of(spark, JOB_RUN_INFO, runs),
            rows_of(spark, JOB_RUN_CLUSTER_INFO, clusters),
            orders.sizes(spark).union(spark.createDataFrame([("D3 v2", 4)])),
            **options,
        )
        return sorted(df.collect())

    return make


def test_core_hours_of_a_fixed_cluster(use):
    (row,) = use([run(hours=1.5)], [cluster()])
    assert (row.driver_vcps, row.worker_vcps, row.worker_nodes) == (2, 4, 2)
    assert (row.duration_min, row.core_hrs) == (90.0, 1.5 * 2 + 1.5 * 4 * 2)
    assert row.node_provision_method == "Fixed"


def test_autoscaling_cluster_counts_its_maximum(use):
    (row,) = use([run()], [cluster(workers="None", low="1", high="5")])
    assert (row.worker_nodes, row.autoscale_max, row.core_hrs) == (0, 5, 2 + 4 * 5)
    assert row.node_provision_method == "Autoscale"


def test_unset_worker_count_gives_null_core_hours(use):
    (row,) = use([run()], [cluster(workers=None)])
    assert (row.node_provision_method, row.worker_nodes, row.core_hrs) == ("Fixed", None, None)


def test_a_run_is_charged_for_the_shapes_of_other_runs_of_its_task(use):
    runs = [run(run_id=1), run(run_id=2)]
    clusters = [cluster(run_id=1, workers="1"), cluster(run_id=2, workers="3")]
    assert len(use(runs, clusters)) == 4
    by_run = use(runs, clusters, match="run")
    assert [(r.run_id, r.worker_nodes) for r in by_run] == [(1, 1), (2, 3)]


def test_equal_shapes_of_a_run_are_one_row(use):
    runs = [run(task="a"), run(task="b"), run(task="c")]
    clusters = [cluster(task="a"), cluster(task="b"), cluster(task="c", workers="5")]
    assert [r.core_hrs for r in use(runs, clusters)] == [10.0, 22.0]


def test_unknown_sizes_are_dropped(use):
    runs = [run(run_id=1), run(run_id=2, job=2), run(run_id=3, job=3), run(run_id=4, job=4)]
    clusters = [
        cluster(job=1, driver="m5.metal"), cluster(job=2, worker=None), cluster(job=3),
        cluster(job=4, driver="Standard_D3_v2", worker="Standard_D3_v2"),
    ]
    assert [r.run_id for r in use(runs, clusters)] == [3]
    assert [r.run_id for r in use(runs, clusters, normalize_size=True)] == [3, 4]


def test_null_keys_match_nothing(use):
    assert use([run(task=None)], [cluster(task=None)]) == []
    assert use([run(task=None)], [cluster(task=None)], match="run") == []


def test_rounding_is_per_row(use):
    rows = use([run(hours=1 / 3), run(run_id=2, hours=1 / 3)], [cluster(workers="0")])
    assert [r.core_hrs for r in rows] == [0.67, 0.67]
    assert [r.duration_min for r in rows] == [20.0, 20.0]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ansi_setting_does_not_matter(use, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    (row,) = use([run()], [cluster(workers="None", low="None", high="3")])
    assert (row.autoscale_min, row.core_hrs) == (0, 14.0)
    assert type(row.worker_nodes) is int


def test_unknown_match_is_refused(spark):
    with pytest.raises(ValueError, match="match"):
        usage.match_keys("cluster")


@pytest.mark.parametrize("split_rows", [1, 7, 50])
@pytest.mark.parametrize("match", ["task", "run"])
def test_splitting_hot_jobs_changes_nothing(spark, use, match, split_rows):
    # One job has a third of all rows.
    runs = [
        run(job=1 if i % 3 == 0 else i, run_id=i, task=f"t{i % 2}", hours=1 + i % 4)
        for i in range(120)
    ]
    clusters = [
        cluster(job=r["job_id"], run_id=r["run_id"], task=r["task_key"], workers=str(i % 5))
        for i, r in enumerate(runs)
    ]
    whole = use(runs, clusters, match=match)
    assert use(runs, clusters, match=match, split_rows=split_rows) == whole
    plain = {
        (r["run_id"], c["num_workers"])
        for r in runs for c in clusters
        if (r["job_id"], r["task_key"]) == (c["job_id"], c["task_key"])
        and (match == "task" or r["run_id"] == c["run_id"])
    }
    assert {(r.run_id, str(r.worker_nodes)) for r in whole} == plain


def test_all_job_clusters_has_thirty_columns(spark):
    df = usage.all_job_clusters(rows_of(spark, JOB_RUN_CLUSTER_INFO, [cluster(workers="None")]))
    assert len(df.columns) == 30 and "run_id" not in df.columns
    assert df.first().node_provision_method == "Autoscale"
    assert "run_id" in usage.all_job_clusters(
        rows_of(spark, JOB_RUN_CLUSTER_INFO, []), keep_run_id=True
    ).columns


def test_size_coverage_counts_what_run_usage_drops(spark):
    clusters = rows_of(
        spark, JOB_RUN_CLUSTER_INFO,
        [cluster(driver="m5.metal"), cluster(driver="m5.metal"), cluster(worker=None)],
    )
    rows = usage.size_coverage(clusters, orders.sizes(spark)).collect()
    assert sorted((r.role, r.node or "", r.cluster_rows) for r in rows) == [
        ("driver", "m5.metal", 2), ("worker", "", 1),
    ]


# --- reports ---------------------------------------------------------------------


def test_audit_skips_pairs_with_a_null(spark):
    runs = rows_of(spark, JOB_RUN_INFO, [run(task="a"), run(task="a"), run(task=None)])
    none = spark.createDataFrame(
        [("1", "1", "x", "c1", "s"), ("1", "1", None, "c1", "s")],
        "job_id string, run_id string, task_key string, cluster_id string, status string",
    )
    audit = reports.coverage_audit(runs, rows_of(spark, JOB_RUN_CLUSTER_INFO, []), none)
    assert {r.label: r.counts for r in audit.collect()} == {
        "all runs tasks": 1,
        "tasks with cluster definition": 0,
        "tasks with no cluster definition": 1,
        "clusters we couldnt look up": 1,
    }


def test_job_task_key_has_no_separator_and_skips_null(spark):
    runs = [
        run(run_id=1, name="a", task="bc"), run(run_id=2, name="ab", task="c"),
        run(run_id=3, name=None, task="c"),
    ]
    clusters = [cluster(task="bc"), cluster(task="c")]
    (row,) = reports.daily_usage(
        rows_of(spark, JOB_RUN_INFO, runs), rows_of(spark, JOB_RUN_CLUSTER_INFO, clusters)
    ).collect()
    assert (row.job_task_count, row.run_count, row.day) == (1, 3, dt.date(2024, 3, 1))


def test_pool_usage_ignores_tasks_without_a_listed_pool(spark):
    runs = [run(task="a"), run(task="b"), run(task="c")]
    clusters = [
        cluster(task="a", instance_pool_id="p1"), cluster(task="b"),
        cluster(task="c", instance_pool_id="gone"),
    ]
    pools = rows_of(
        spark, POOLS_INFO,
        [{"instance_pool_id": "p1", "instance_pool_name": "one", "node_type_id": "m5.large"}],
    )
    (row,) = reports.pool_usage(
        rows_of(spark, JOB_RUN_INFO, runs), rows_of(spark, JOB_RUN_CLUSTER_INFO, clusters), pools
    ).collect()
    assert tuple(row) == ("p1", "one", "m5.large", 1, 1)


@pytest.mark.parametrize("split_rows", [3, 10**9])
def test_reports_do_not_depend_on_splitting(spark, sf_dir, split_rows):
    runs, clusters = orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir)
    for report, args in (
        (reports.pool_usage, [orders.pools(spark, sf_dir)]),
        (reports.daily_usage, []),
        (reports.submit_groups, []),
    ):
        default = report(runs, clusters, *args)
        split = report(runs, clusters, *args, split_rows=split_rows)
        assert sorted(map(str, split.collect())) == sorted(map(str, default.collect()))


def test_estimate_equals_plain_python(spark, sf_dir):
    start, end = dt.date(1996, 1, 1), dt.date(1996, 3, 1)
    runs, clusters = orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir)
    sizes = orders.sizes(spark)
    inside = [r.run_id for r in window_runs(runs, start, end).select("run_id").collect()]
    own = clusters.where(F.col("run_id").isin(inside))
    rows = [
        r for r in usage.run_usage(runs, own, sizes).collect()
        if epoch_ms(start) <= r.run_starttime < epoch_ms(end)
    ]
    (row,) = annual_estimate(runs, clusters, sizes, start, end, rate=0.01).collect()
    total = sum(r.core_hrs for r in rows)
    assert row.period == "1996-01-01 - 1996-03-01"
    assert row.jobs == len({r.run_name for r in rows})
    assert row.runs == len({r.run_id for r in rows})
    assert row.core_hrs == total
    assert row.est_annual_core_hrs == total * 6
    assert row.est_annual_core_hr_cost == pytest.approx(total * 6 * 0.01, abs=0.01)


@pytest.mark.parametrize("by_day", [False, True])
def test_shapes_from_before_the_window_are_not_charged(spark, tmp_path, by_day):
    day = 86_400_000
    names = ["job_id", "run_id", "task_key", "run_name", "run_type", "run_starttime",
             "run_endtime", "run_result_state"]
    runs = spark.createDataFrame(
        [(1, 10, "t", "a", "JOB_RUN", 1 * day, 1 * day + 3_600_000, "SUCCESS"),
         (1, 11, "t", "a", "JOB_RUN", 5 * day, 5 * day + 3_600_000, "SUCCESS"),
         (1, 12, "t", "a", "JOB_RUN", 6 * day, 6 * day + 3_600_000, "SUCCESS")], names,
    )
    shape = ["job_id", "run_id", "task_key", *usage.SHAPE_COLUMNS]
    clusters = spark.createDataFrame(
        [(1, 10, "t", "m.big", "m.big", "50", "0", "0"),
         (1, 11, "t", "m.small", "m.small", "1", "0", "0"),
         (1, 12, "t", "m.small", "m.small", "2", "0", "0")], shape,
    )
    if by_day:
        days = runs.select("run_id", F.expr("date_add(DATE'1970-01-01', CAST(run_starttime"
                                            " / 86400000 AS INT))").alias("run_day"))
        clusters.join(days, "run_id").write.partitionBy("run_day").parquet(str(tmp_path / "c"))
        clusters = spark.read.parquet(str(tmp_path / "c"))
    sizes = spark.createDataFrame([("big", 64), ("small", 2)], "instance_size string, vcpus int")
    start = dt.date(1970, 1, 5)
    row = annual_estimate(runs, clusters, sizes, start, start + dt.timedelta(7)).first()
    # Two runs of an hour, each charged for both small shapes of the window.
    assert (row.runs, row.core_hrs) == (2, 2 * ((2 + 2) + (2 + 4)))
    by_run = annual_estimate(
        runs, clusters, sizes, start, start + dt.timedelta(7), match="run"
    ).first()
    assert (by_run.runs, by_run.core_hrs) == (2, (2 + 2) + (2 + 4))


def test_stored_days_prune_both_tables(spark, sf_dir, tmp_path, capsys):
    runs = orders.runs(spark, sf_dir)
    days = runs.select("run_id", epoch_day("run_starttime").alias("run_day")).distinct()
    with_run_day(runs).repartition(1).write.partitionBy("run_day").parquet(str(tmp_path / "runs"))
    orders.with_cluster(spark, sf_dir).join(days, "run_id").repartition(1).write.partitionBy(
        "run_day"
    ).parquet(str(tmp_path / "clusters"))
    stored = [spark.read.parquet(str(tmp_path / name)) for name in ("runs", "clusters")]
    for match in ("task", "run"):
        annual_estimate(
            *stored, orders.sizes(spark), dt.date(1996, 1, 1), dt.date(1996, 1, 8), match=match
        ).explain("formatted")
        plan = capsys.readouterr().out
        for name in ("runs", "clusters"):
            scan = plan[plan.index(str(tmp_path / name)):]
            filters = scan[scan.index("PartitionFilters"):].splitlines()[0]
            assert "run_day" in filters


@pytest.mark.parametrize("what", ["pool", "size"])
def test_a_popular_pool_or_size_is_split(spark, conf, what):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    ids = spark.range(2000).selectExpr("id % 50 AS job_id", "id AS run_id", "'t' AS task_key")
    if what == "pool":
        side = ids.withColumn("instance_pool_id", F.lit("p"))
        dim = spark.createDataFrame([("p", 1)], "instance_pool_id string, x int")
        joined = lookup(side, dim, "instance_pool_id", usage.match_keys("run"), "inner",
                        max_rows=0, split_rows=20)
    else:
        shapes = ids.withColumns({c: F.lit("m.large") for c in usage.SHAPE_COLUMNS})
        dim = spark.createDataFrame([("large", 2)], "instance_size string, vcpus int")
        joined = usage.sized_shapes(shapes, dim, "run", split_rows=20, max_rows=0)
    sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 800


def test_instance_coverage(spark):
    rows = spark.createDataFrame([("a", "b"), ("a", None)], "driver_node string, worker_node string")
    listed = spark.createDataFrame([("b",)], "instance_type string")
    found = reports.instance_coverage(rows, listed).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(
        map(str, [("driver", "a", 2), ("worker", None, 1)])
    )


def test_empty_window(spark, sf_dir):
    day = dt.date(1900, 1, 1)
    (row,) = annual_estimate(
        orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir), orders.sizes(spark),
        day, day + dt.timedelta(1),
    ).collect()
    assert tuple(row)[1:] == (0, 0, None, None, None)


def test_factor():
    assert [reports.annual_factor(n) for n in (1, 7, 30, 366)] == [365, 52, 12, 0]
    with pytest.raises(ValueError, match="days_back"):
        reports.annual_factor(0)


def test_window_bounds_reach_the_scan(spark, sf_dir, tmp_path, capsys):
    path = str(tmp_path / "runs")
    with_run_day(orders.runs(spark, sf_dir)).write.partitionBy("run_day").parquet(path)
    runs = window_runs(spark.read.parquet(path), dt.date(1996, 1, 1), dt.date(1996, 2, 1))
    usage.run_usage(runs, orders.with_cluster(spark, sf_dir), orders.sizes(spark)).explain(
        "formatted"
    )
    plan = capsys.readouterr().out
    scan = plan[plan.index(path):]
    assert "PartitionFilters: [isnotnull(run_day" in scan
    assert f"GreaterThanOrEqual(run_starttime,{epoch_ms(dt.date(1996, 1, 1))})" in scan
    assert "notebook_task_path" not in scan.split("ReadSchema")[1].splitlines()[0]


def test_dbu_usage(spark):
    rows = spark.createDataFrame(
        [("m5.large", "m5.xlarge", "Fixed", 2, 0, 60.0),
         ("m5.large", "m5.xlarge", "Autoscale", 0, 3, 30.0),
         ("unknown", "m5.xlarge", "Fixed", 2, 0, 60.0)],
        "driver_node string, worker_node string, node_provision_method string,"
        " worker_nodes bigint, autoscale_max bigint, duration_min double",
    )
    (row,) = reports.dbu_usage(rows, orders.instances(spark), rate=2.0).collect()
    dbus = 1.5 * 0.34 + (2 + 1.5) * 0.69
    assert row.dbus == pytest.approx(round(dbus, 2), abs=0.011)
    assert row.dbu_cost == pytest.approx(2 * dbus, abs=0.011)


def test_join_clusters_forms_no_repeated_pairs(spark):
    runs = rows_of(spark, JOB_RUN_INFO, [run(run_id=i) for i in range(10)])
    clusters = rows_of(spark, JOB_RUN_CLUSTER_INFO, [cluster(run_id=i) for i in range(10)])
    joined = usage.join_clusters(runs.select("job_id", "run_id", "task_key"), clusters,
                                 ["driver_node"])
    assert joined.count() == 10
    assert joined.agg(F.countDistinct("run_id")).first()[0] == 10


def test_reports_by_run_see_only_the_cluster_of_the_run(spark):
    runs = rows_of(spark, JOB_RUN_INFO, [run(run_id=1), run(run_id=2), run(run_id=3)])
    clusters = rows_of(
        spark, JOB_RUN_CLUSTER_INFO,
        [cluster(run_id=1), cluster(run_id=2, compute_definition="All Purpose Compute")],
    )

    def counts(df):
        return {r.compute_definition: r.run_count for r in df.collect()}

    assert counts(reports.daily_usage(runs, clusters)) == {
        "Jobs Compute": 3, "All Purpose Compute": 3,
    }
    assert counts(reports.daily_usage(runs, clusters, match="run")) == {
        "Jobs Compute": 1, "All Purpose Compute": 1,
    }
    groups = {
        match: reports.submit_groups(runs, clusters, match=match).first().distinct_run_ids
        for match in ("task", "run")
    }
    assert groups == {"task": 3, "run": 2}


def test_pairing_by_run_never_gives_more_pairs(spark, sf_dir):
    runs = orders.runs(spark, sf_dir).select("job_id", "run_id", "task_key")
    clusters = orders.with_cluster(spark, sf_dir)
    pairs = {
        match: usage.join_clusters(runs, clusters, ["driver_node"], match).count()
        for match in ("task", "run")
    }
    assert 0 < pairs["run"] <= pairs["task"]


def test_pairs_of_run_and_shape_are_not_shuffled(spark, sf_dir, conf):
    """Rows of the result are made once, behind the last shuffle."""
    conf("spark.sql.adaptive.enabled", "false")
    found = usage.run_usage(
        orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir), orders.sizes(spark)
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Join")]
    assert found.count() == found.distinct().count()


def test_every_duration_and_worker_count_of_a_task_is_charged(use):
    """Rows of a run that differ too little to be told apart by their minutes."""
    runs = [run(hours=1.0), run(hours=1.0 + 0.2 / 3600, task="u"), run(hours=4.0, task="u")]
    clusters = [cluster(workers="2"), cluster(workers="02"), cluster(task="u", workers="300"),
                cluster(task="u", workers="300")]
    found = use(runs, clusters)
    assert len(found) == len(set(found))
    assert len({r.duration_min for r in found}) < len({r.core_hrs for r in found})
