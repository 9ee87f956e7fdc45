"""One task per way of naming a cluster, and the normalized tables."""

import pytest
from pyspark.sql import functions as F

from runledger.operators import normalize, resolve
from runledger.schemas import (
    CLUSTER_INFO,
    DEFINITION_COLUMNS,
    JOB,
    JOB_INFO,
    JOB_RUN_CLUSTER_INFO,
    JOB_RUN_INFO,
    JOB_RUN_NO_CLUSTER_INFO,
    LISTED_CLUSTER,
    LISTED_POOL,
    POOLS_INFO,
    RUN,
    struct,
)


def frame(spark, schema, *records):
    """Rows from nested dicts; what is left out is missing."""
    import json

    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "line string")
    return lines.select(F.from_json("line", schema).alias("r")).select("r.*")


def run(*tasks, run_id=1, job_clusters=None, **more):
    record = {
        "run_id": run_id, "job_id": 10, "start_time": 1000, "end_time": 2000,
        "state": {"life_cycle_state": "TERMINATED", "result_state": "SUCCESS"},
        "tasks": list(tasks),
    }
    if job_clusters is not None:
        record["job_clusters"] = job_clusters
    return record | more


@pytest.fixture(scope="module")
def tables(spark):
    clusters = frame(
        spark, LISTED_CLUSTER,
        {"cluster_id": "listed", "node_type_id": "m5.large", "num_workers": 3},
        {"cluster_id": "both", "node_type_id": "m5.large"},
    )
    fetched = frame(
        spark, LISTED_CLUSTER,
        {"cluster_id": "fetched", "node_type_id": "m5.xlarge", "custom_tags": {"a": "b"}},
        {"cluster_id": "both", "node_type_id": "other"},
    )
    pools = frame(
        spark, LISTED_POOL,
        {"instance_pool_id": "p1", "node_type_id": "m5.large",
         "aws_attributes": {"availability": "SPOT", "spot_bid_price_percent": 90,
                            "zone_id": "z1"}},
        {"instance_pool_id": "p2", "node_type_id": "r5.large"},
    )
    return normalize.normalize_clusters(clusters), normalize.normalize_pools(pools), fetched


@pytest.fixture(params=["broadcast", "shuffled"])
def solve(spark, tables, request):
    clusters, pools, fetched = tables
    options = {} if request.param == "broadcast" else {"broadcast_rows": 0, "split_rows": 1}

    def call(*runs, **more):
        with_c, without_c = resolve.resolve_clusters(
            frame(spark, RUN, *runs), clusters, pools, fetched, **options, **more
        )
        assert with_c.columns == JOB_RUN_CLUSTER_INFO.names
        assert [f.dataType for f in with_c.schema] == [f.dataType for f in JOB_RUN_CLUSTER_INFO]
        assert without_c.columns == JOB_RUN_NO_CLUSTER_INFO.names
        return (
            {r.task_key: r for r in with_c.collect()},
            {r.task_key: (r.cluster_id, r.status, r.job_id, r.run_id)
             for r in without_c.collect()},
        )

    return call


def test_existing_cluster(solve):
    found, lost = solve(
        run(
            {"task_key": "a", "existing_cluster_id": "listed"},
            {"task_key": "b", "existing_cluster_id": "fetched"},
            {"task_key": "c", "existing_cluster_id": "gone"},
            {"task_key": "d", "existing_cluster_id": "both",
             "new_cluster": {"node_type_id": "ignored"}},
        )
    )
    a, b, d = found["a"], found["b"], found["d"]
    assert (a.cluster_identifier, a.compute_definition) == ("listed", "All Purpose Compute")
    # The listing does not default the driver node; a single fetch does.
    assert (a.driver_node, a.worker_node, a.num_workers) == (None, "m5.large", "3")
    assert (b.driver_node, b.instance_pool_id, b.custom_tags) == (
        "m5.xlarge", None, '{"a":"b"}',
    )
    assert (d.worker_node, d.cluster_identifier) == ("m5.large", "both")
    assert lost == {"c": ("gone", resolve.NOT_RETRIEVED, "10", "1")}


def test_shared_cluster(solve):
    shared = [
        {"job_cluster_key": "k", "new_cluster": {"node_type_id": "m5.large", "num_workers": 2}},
        {"job_cluster_key": "pool", "new_cluster": {"instance_pool_id": "none"}},
    ]
    found, lost = solve(
        run(
            {"task_key": "a", "job_cluster_key": "k"},
            {"task_key": "b", "job_cluster_key": "absent",
             "cluster_instance": {"cluster_id": "ci"}},
            {"task_key": "c", "job_cluster_key": "pool"},
            job_clusters=shared,
        ),
        run({"task_key": "d", "job_cluster_key": "k"}, run_id=2),
    )
    assert set(found) == {"a"}
    a = found["a"]
    assert (a.cluster_identifier, a.compute_definition) == ("Task Defined", "Jobs Compute")
    assert (a.driver_node, a.worker_node, a.instance_pool_id) == ("m5.large", "m5.large", "None")
    assert lost == {
        "b": ("ci", resolve.NO_SHARED_KEY, "10", "1"),
        "c": ("unknown", resolve.NOT_SERIALIZED, "10", "1"),
        "d": ("unknown", resolve.NO_SHARED_KEY, "10", "2"),
    }


def test_every_shared_entry_with_the_key_gives_a_row(spark, tables):
    shared = [
        {"job_cluster_key": "k", "new_cluster": {"node_type_id": n}} for n in ("one", "two")
    ]
    with_c, _ = resolve.resolve_clusters(
        frame(spark, RUN, run({"task_key": "a", "job_cluster_key": "k"}, job_clusters=shared)),
        tables[0], tables[1],
    )
    assert sorted(r.worker_node for r in with_c.collect()) == ["one", "two"]


def test_pool_gives_nodes_availability_price_and_zone(solve):
    found, lost = solve(
        run(
            {"task_key": "a", "new_cluster": {"instance_pool_id": "p1", "node_type_id": "x",
                                              "aws_attributes": {"zone_id": "zx"}}},
            {"task_key": "b", "new_cluster": {"instance_pool_id": "p1",
                                              "driver_instance_pool_id": "p2"}},
            {"task_key": "c", "new_cluster": {"instance_pool_id": "p1",
                                              "driver_instance_pool_id": "gone"}},
            {"task_key": "d", "new_cluster": {"instance_pool_id": "gone"}},
        )
    )
    a = found["a"]
    assert (a.cluster_identifier, a.driver_node, a.worker_node) == (
        "Pool Defined", "m5.large", "m5.large",
    )
    assert (a.aws_attributes_availability, a.aws_attributes_spot_bid_price_percent,
            a.aws_attributes_zone_id, a.instance_pool_id) == ("SPOT", "90", "z1", "p1")
    assert found["b"].driver_node == "r5.large"
    assert found["c"].driver_node is None
    assert lost["d"][1] == resolve.NOT_SERIALIZED


def test_cluster_instance_and_nothing(solve):
    found, lost = solve(
        run(
            {"task_key": "a", "cluster_instance": {"cluster_id": "fetched"}},
            {"task_key": "b", "cluster_instance": {"cluster_id": "listed"}},
            {"task_key": "c"},
        )
    )
    a = found["a"]
    assert (a.cluster_identifier, a.compute_definition) == ("fetched", "Jobs Compute")
    assert lost == {
        "b": ("listed", resolve.NOT_LOOKED_UP, "10", "1"),
        "c": ("unknown", resolve.NOT_DEFINED, "10", "1"),
    }


def test_audit_adds_up(spark, sf_dir):
    from runledger.samples import queries

    with_c = queries.resolve_clusters(spark, sf_dir)
    without_c = queries.unresolved_tasks(spark, sf_dir)
    tasks = queries.normalize_runs(spark, sf_dir)
    assert with_c.count() + without_c.count() == tasks.count()


def test_definition_defaults(solve):
    definition = {"node_type_id": "n", "enable_elastic_disk": True,
                  "enable_local_disk_encryption": False}
    found, _ = solve(run({"task_key": "a", "new_cluster": definition}))
    row = found["a"].asDict()
    assert row["enable_elastic_disk"] == "True"
    assert row["enable_local_disk_encryption"] == "false"
    assert row["aws_attributes_ebs_volume_count"] == 0
    for name in ("aws_attributes_availability", "workload_type_jobs", "autotermination_minutes",
                 "aws_attributes_ebs_volume_type", "runtime_engine", "spark_conf", "custom_tags"):
        assert row[name] == "None", name
    for name in ("aws_attributes_zone_id", "spark_version", "policy_id",
                 "aws_attributes_first_on_demand", "aws_attributes_spot_bid_price_percent"):
        assert row[name] is None, name
    assert (row["num_workers"], row["autoscale_min"], row["autoscale_max"]) == ("0", "0", "0")


def test_missing_workers_can_mean_autoscale(solve):
    task = {"task_key": "a", "new_cluster": {"node_type_id": "n",
                                             "autoscale": {"min_workers": 1, "max_workers": 4}}}
    assert solve(run(task))[0]["a"].num_workers == "0"
    row = solve(run(task), missing_workers="None")[0]["a"]
    assert (row.num_workers, row.autoscale_max) == ("None", "4")


# --- normalized tables -----------------------------------------------------------


def test_cluster_listing(spark):
    df = normalize.normalize_clusters(frame(spark, LISTED_CLUSTER, {"cluster_id": "c"}))
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in CLUSTER_INFO
    ]
    row = df.first()
    assert (row.aws_attributes_zone_id, row.cluster_memory_mb, row.num_workers) == (
        "None", "None", "0",
    )
    assert (row.cluster_cores, row.driver_node, row.autotermination_minutes) == (None,) * 3


def test_pool_columns_are_the_pools_own(spark):
    pool = {"instance_pool_id": "p", "node_type_id": "n", "custom_tags": {"k": "v"}}
    df = normalize.normalize_pools(frame(spark, LISTED_POOL, pool))
    assert df.columns == POOLS_INFO.names
    assert tuple(df.first()) == ("p", None, "None", "None", "None", "n", '{"k":"v"}')


def test_job_listing(spark):
    jobs = frame(
        spark, JOB,
        {"job_id": 1, "settings": {"name": "j", "tasks": [{}, {}], "parameters": [
            {"name": "a", "default": "1"}]}},
        {"job_id": 2, "settings": {}},
    )
    df = normalize.normalize_jobs(jobs)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in JOB_INFO]
    one, two = df.orderBy("job_id").collect()
    assert one.parameters == ['{"name":"a","default":"1"}']
    assert (one.task_count, one.job_clusters, two.task_count) == (2, 0, 0)
    assert (two.schedule_timezone_id, two.creator_user_name) == ("None", "None")


def test_run_listing(spark):
    runs = frame(
        spark, RUN,
        run(
            {"task_key": "a", "dbt_task": {"project_directory": "d"}, "execution_duration": 5},
            {"task_key": "b", "notebook_task": {"notebook_path": "/n",
                                                "base_parameters": {"x": "y"}}},
            state={},
        ),
        run(run_id=2),
    )
    df = normalize.normalize_runs(runs)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in JOB_RUN_INFO
    ]
    a, b = df.orderBy("task_key").collect()
    assert (a.run_type, a.run_life_cycle_state, a.run_result_state) == (
        "Unknown", "UNKNOWN", "UNKNOWN",
    )
    assert (a.dbt_task_as_dict, a.notebook_task_path) == ('{"project_directory":"d"}', "N/A")
    assert (a.task_duration, a.task_execution_duration) == (5, 5)
    assert (b.notebook_task_base_params, b.notebook_task_path) == ('{"x":"y"}', "/n")


def test_scan_keeps_finished_runs_from_a_time_on(spark):
    def one(run_id, start, state):
        return run(run_id=run_id, start_time=start, state={"life_cycle_state": state})

    runs = frame(
        spark, RUN, one(1, 99, "TERMINATED"), one(2, 100, "TERMINATED"), one(3, 100, "RUNNING"),
        one(4, 101, "SKIPPED"),
    )
    assert [r.run_id for r in normalize.scan_runs(runs, 100).orderBy("run_id").collect()] == [2, 4]


def test_narrow_export(spark):
    """An export may lack fields altogether."""
    schema = struct(cluster_id=CLUSTER_INFO["cluster_id"].dataType)
    clusters = spark.createDataFrame([("c",)], schema)
    row = normalize.normalize_clusters(clusters).first()
    assert (row.cluster_id, row.num_workers, row.custom_tags) == ("c", "0", "None")
    assert set(normalize.cluster_columns(schema)) == set(DEFINITION_COLUMNS)
