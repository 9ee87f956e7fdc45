import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_resolve import frame

from runledger.operators import jobdefs
from runledger.schemas import JOB, PROJECT, RECOMMENDATION

TAG = "project-id"


def job(job_id=1, fmt="MULTI_TASK", **settings):
    return {"job_id": job_id, "settings": {"format": fmt} | settings}


def shared(key, **cluster):
    return {"job_cluster_key": key, "new_cluster": cluster}


GOOD = {"custom_tags": {TAG: "p"}, "cluster_log_conf": {"dbfs": {"destination": "d"}}}


def test_cluster_of_a_job(spark):
    jobs = frame(
        spark, JOB,
        job(1, "SINGLE_TASK", new_cluster={"node_type_id": "single"}),
        job(2, tasks=[{"new_cluster": {"node_type_id": "own"}, "job_cluster_key": "k"}],
            job_clusters=[shared("k", node_type_id="shared")]),
        job(3, tasks=[{"job_cluster_key": "k"}, {"new_cluster": {"node_type_id": "second"}}],
            job_clusters=[shared("x", node_type_id="x"), shared("k", node_type_id="shared")]),
        job(4, tasks=[{"job_cluster_key": "absent"}], job_clusters=[shared("k")]),
        job(5, "OTHER", new_cluster={"node_type_id": "n"}),
        job(6, tasks=[]),
    )
    rows = jobdefs.job_cluster(jobs).orderBy("job_id").collect()
    assert [r.cluster and r.cluster.node_type_id for r in rows] == [
        "single", "own", "shared", None, None, None,
    ]
    assert [r.cluster_error for r in rows] == [None] * 3 + [jobdefs.NO_CLUSTER] * 3


def test_tag_of_a_job(spark):
    jobs = frame(
        spark, JOB,
        job(1, "SINGLE_TASK", new_cluster=GOOD),
        job(2, "SINGLE_TASK", new_cluster={"custom_tags": {"other": "x"}}),
        job(3, "SINGLE_TASK", new_cluster={}),
    )
    rows = jobdefs.job_tag(jobs, TAG).orderBy("job_id").collect()
    assert [r.tag for r in rows] == ["p", None, None]


def test_eligibility_names_the_first_rule_that_fails(spark):
    one = [{"job_cluster_key": "k"}, {"job_cluster_key": "k"}]
    jobs = frame(
        spark, JOB,
        job(1, tasks=one, job_clusters=[shared("k", **GOOD)]),
        job(2, tasks=[*one, {"new_cluster": {"node_type_id": "n"}}],
            job_clusters=[shared("k", **GOOD)]),
        job(3, tasks=[{"existing_cluster_id": "c"}]),
        job(4, "SINGLE_TASK"),
        job(5, tasks=one, job_clusters=[shared("k", cluster_log_conf={"dbfs": {}})]),
        job(6, tasks=one, job_clusters=[shared("k", **(GOOD | {"custom_tags": {TAG: "off"}}))]),
        job(7, tasks=one,
            job_clusters=[shared("k", **(GOOD | {"cluster_log_conf": {"dbfs": {}}}))]),
        job(8, tasks=one, job_clusters=[shared("k", **(GOOD | {"custom_tags": {TAG: "gone"}}))]),
        # A task with a key counts by its key, whatever else it has.
        job(9, tasks=[{"job_cluster_key": "k", "new_cluster": GOOD}], job_clusters=[]),
    )
    projects = frame(
        spark, PROJECT, {"project_id": "p", "auto_apply_recs": True},
        {"project_id": "off", "auto_apply_recs": False},
    )
    rows = jobdefs.eligibility(jobs, projects, TAG).orderBy("job_id").collect()
    assert [r.reason for r in rows] == [
        None, jobdefs.NOT_ONE_CLUSTER, jobdefs.NOT_ONE_CLUSTER, jobdefs.NO_CLUSTER,
        jobdefs.NO_PROJECT, jobdefs.NO_AUTO_APPLY, jobdefs.NO_DBFS_LOGS, jobdefs.NO_AUTO_APPLY,
        None,
    ]
    assert [r.eligible for r in rows] == [r.reason is None for r in rows]


def test_on_demand(spark):
    jobs = frame(
        spark, JOB,
        job(1, tasks=[{"new_cluster": {"num_workers": 9, "aws_attributes": {}}}],
            job_clusters=[
                shared("a", num_workers=3, aws_attributes={"first_on_demand": 1}),
                shared("b", num_workers=3, autoscale={"max_workers": 8},
                       azure_attributes={"first_on_demand": 2}),
                shared("c", aws_attributes={"zone_id": "z"}),
            ]),
        job(2, tasks=[
            {"task_key": "t", "new_cluster": {"num_workers": 4, "aws_attributes": {}}},
            {"task_key": "u", "existing_cluster_id": "x"},
        ]),
    )
    plan = {(r.job_id, r.key): tuple(r)[3:] for r in jobdefs.on_demand_plan(jobs).collect()}
    assert plan == {
        (1, "a"): ("aws_attributes", 1, 4),
        (1, "b"): ("azure_attributes", 2, 9),
        (1, "c"): ("aws_attributes", 0, 1),
        (2, "t"): ("aws_attributes", 0, 5),
    }
    one, two = jobdefs.set_on_demand(jobs).orderBy("job_id").collect()
    a, b, c = (j.new_cluster for j in one.settings.job_clusters)
    assert a.aws_attributes.first_on_demand == 4 and a.azure_attributes is None
    assert b.azure_attributes.first_on_demand == 9 and b.aws_attributes is None
    assert (c.aws_attributes.first_on_demand, c.aws_attributes.zone_id) == (1, "z")
    assert one.settings.tasks[0].new_cluster.aws_attributes.first_on_demand is None
    assert two.settings.tasks[0].new_cluster.aws_attributes.first_on_demand == 5
    assert two.settings.tasks[1].new_cluster is None
    assert jobdefs.set_on_demand(jobs).schema["settings"].dataType.names == (
        jobs.schema["settings"].dataType.names
    )


def recommendation(project, prediction, minute, **configuration):
    return {
        "project_id": project, "prediction_id": prediction,
        "created_at": f"2024-01-01T00:{minute:02d}:00Z", "configuration": configuration,
    }


def test_latest_recommendation(spark):
    recs = frame(
        spark, RECOMMENDATION, recommendation("p", "1", 5), recommendation("p", "3", 7),
        recommendation("p", "2", 7), recommendation("q", "9", 1),
    )
    newest = jobdefs.latest_recommendation(recs)
    assert newest.columns == recs.columns
    assert sorted((r.project_id, r.prediction_id) for r in newest.collect()) == [
        ("p", "3"), ("q", "9"),
    ]
    assert newest.first().created_at.date() == dt.date(2024, 1, 1)


def test_apply_recommendation(spark):
    recs = frame(
        spark, RECOMMENDATION,
        recommendation("p", "1", 1, node_type_id="old"),
        recommendation("p", "2", 2, driver_node_type_id="d", node_type_id="w", num_workers=7,
                       autoscale={"min_workers": 2, "max_workers": 3}),
    )
    tags = {TAG: "p"}
    jobs = frame(
        spark, JOB,
        job(1, job_clusters=[
            shared("k", node_type_id="a", num_workers=2, custom_tags=tags, spark_version="v",
                   spark_conf={"x": "y"}),
            shared("second", node_type_id="untouched"),
        ]),
        job(2, job_clusters=[shared("k", autoscale={"min_workers": 1, "max_workers": 9},
                                    custom_tags=tags)]),
        job(3, job_clusters=[shared("k", custom_tags={TAG: "none"})]),
        job(4, tasks=[]),
    )
    applied = jobdefs.apply_recommendation(jobs, recs, TAG)
    one, two, three, four = applied.orderBy("job_id").collect()
    # The others come back as they were, so that the result can replace the table.
    assert [r.changed for r in (one, two, three, four)] == [True, True, False, False]
    before = {r.job_id: r.settings for r in jobs.collect()}
    assert (three.settings, four.settings) == (before[3], before[4])
    assert (three.project_id, three.prediction_id, three.cluster_name) == ("none", None, None)
    for limits in ({"max_rows": 0}, {"max_rows": 0, "split_rows": 1}):
        again = jobdefs.apply_recommendation(jobs, recs, TAG, **limits)
        assert sorted(map(str, again.collect())) == sorted(map(str, applied.collect()))
    assert (one.prediction_id, one.cluster_name) == ("2", "k")
    assert (one.driver_before, one.driver_after) == ("", "d")
    assert (one.worker_before, one.worker_after) == ("a", "w")
    assert (one.num_workers_before, one.num_workers_after) == ("2", "7")
    assert (one.autoscale_before, one.autoscale_after) == ("", "")
    # Spark settings are replaced even by nothing.
    assert (one.spark_conf_before, one.spark_conf_after) == ('{"x":"y"}', "")
    first, second = one.settings.job_clusters
    assert (first.new_cluster.num_workers, first.new_cluster.autoscale) == (7, None)
    assert (first.new_cluster.spark_version, first.new_cluster.spark_conf) == ("v", None)
    assert second.new_cluster.node_type_id == "untouched"
    assert (two.num_workers_before, two.num_workers_after) == ("", "")
    assert two.autoscale_after == '{"min_workers":2,"max_workers":3}'


def test_success_prefix(spark):
    states = {
        1: ["SUCCESS", "SUCCESS", "FAILED", "SUCCESS"],
        2: ["FAILED", "SUCCESS"],
        3: ["SUCCESS"] * 5,
        4: ["SUCCESS", None, "SUCCESS"],
    }
    rows = [(j, i, 100 + i, s) for j, all_ in states.items() for i, s in enumerate(all_)]
    runs = spark.createDataFrame(
        rows, "job_id bigint, run_id bigint, run_starttime bigint, run_result_state string"
    )
    found = jobdefs.success_prefix(runs, 3).collect()
    assert sorted((r.job_id, r.run_id, r.run_number) for r in found) == [
        (1, 0, 1), (1, 1, 2), (3, 0, 1), (3, 1, 2), (3, 2, 3), (4, 0, 1),
    ]
    with pytest.raises(ValueError, match="at least 1"):
        jobdefs.success_prefix(runs, 0)


def test_success_prefix_limits_groups_before_the_shuffle(spark, capsys):
    runs = spark.range(100).selectExpr(
        "id % 3 AS job_id", "id AS run_id", "id AS run_starttime", "'SUCCESS' AS run_result_state"
    )
    jobdefs.success_prefix(runs, 5).explain()
    plan = capsys.readouterr().out
    assert plan.rindex("WindowGroupLimit") > plan.rindex("Exchange")


@pytest.mark.parametrize("split_rows", [3, 1_000_000])
def test_success_prefix_of_any_length(spark, conf, split_rows):
    conf("spark.sql.optimizer.windowGroupLimitThreshold", "4")
    runs = spark.range(60).selectExpr(
        "IF(id % 10 = 9, NULL, id % 3) AS job_id", "id AS run_id", "1000 - id AS run_starttime",
        "IF(id = 7, 'FAILED', 'SUCCESS') AS run_result_state",
    )
    window = {}
    for r in sorted(runs.collect(), key=lambda r: (r.run_starttime, r.run_id)):
        window.setdefault(r.job_id, []).append(r)
    expected = []
    for rows in window.values():
        for number, r in enumerate(rows[:12], start=1):
            if r.run_result_state != "SUCCESS":
                break
            expected.append((r.job_id, r.run_id, number))
    found = jobdefs.success_prefix(runs, 12, split_rows=split_rows).collect()
    assert sorted(((r.job_id, r.run_id, r.run_number) for r in found), key=str) == sorted(
        expected, key=str
    )


def test_success_prefix_of_many_runs_sorts_parts(spark, capsys):
    runs = spark.range(100).selectExpr(
        "id % 3 AS job_id", "id AS run_id", "id AS run_starttime", "'SUCCESS' AS run_result_state"
    )
    jobdefs.success_prefix(runs, 5000).explain()
    plan = capsys.readouterr().out
    # The first sort by the shuffle nearest to the source is of parts.
    assert "_part" in plan[plan.rindex("Window [row_number()"):]


def test_strip_webhooks(spark):
    hooks = {"on_success": [{"id": "h"}]}
    jobs = frame(
        spark, JOB,
        job(1, webhook_notifications=hooks, tasks=[{"webhook_notifications": hooks}, {}]),
        job(2, name="n"),
    )
    one, two = jobdefs.strip_webhooks(jobs).orderBy("job_id").collect()
    assert one.settings.webhook_notifications.asDict() == dict.fromkeys(
        ("on_start", "on_success", "on_failure")
    )
    assert one.settings.tasks[0].webhook_notifications.on_success is None
    assert one.settings.tasks[1].webhook_notifications is None
    assert (two.settings.webhook_notifications, two.settings.tasks, two.settings.name) == (
        None, None, "n",
    )


PARAMS = jobdefs.OnboardParams(
    init_script="/agent.sh", env_vars={"A": "1", "B": "2"}, notebook_path="/nb", task_key="rec",
    base_parameters={"x": "y"}, cluster_env_vars={"C": "3"},
)


def onboarded(spark, *jobs):
    plan = jobdefs.onboard_plan(frame(spark, JOB, *jobs), PARAMS)
    return {r.job_id: r.settings for r in plan.collect()}


def test_onboarding(spark):
    script = {"workspace": {"destination": "/agent.sh"}}
    other = {"dbfs": {"destination": "/other.sh"}}
    found = onboarded(
        spark,
        job(1, tasks=[{"task_key": "a"}, {"task_key": "b", "notebook_task": {"source": "GIT"}}],
            job_clusters=[
                shared("k", spark_env_vars={"A": "old", "KEEP": "k"}),
                shared("last", runtime_engine="PHOTON",
                       aws_attributes={"instance_profile_arn": "arn", "zone_id": "z"}),
            ]),
        job(2, tasks=[{"task_key": "a"}], job_clusters=[shared("k", init_scripts=[other])]),
        job(3, tasks=[{"task_key": "a"}],
            job_clusters=[shared("k", init_scripts=[other, script])]),
        job(4, tasks=[{"task_key": "a"}]),
        job(5, job_clusters=[shared("k")]),
    )
    assert set(found) == {1, 2, 3, 4, 5}
    assert [len(found[k].job_clusters or []) for k in (4, 5)] == [0, 1]
    assert [len(found[k].tasks or []) for k in (4, 5)] == [1, 0]
    del found[4], found[5]
    one = found[1]
    assert one.job_clusters[0].new_cluster.spark_env_vars == {"A": "1", "B": "2", "KEEP": "k"}
    assert one.job_clusters[1].new_cluster.spark_env_vars is None
    added, task = one.job_clusters[-1], one.tasks[-1]
    assert (len(one.job_clusters), len(one.tasks)) == (3, 3)
    assert added.job_cluster_key == task.job_cluster_key == "get_recommendation_cluster"
    cluster = added.new_cluster
    assert cluster.aws_attributes.instance_profile_arn == "arn"
    assert cluster.aws_attributes.zone_id is None
    assert (cluster.runtime_engine, cluster.num_workers) == ("PHOTON", 0)
    assert (cluster.custom_tags, cluster.spark_env_vars) == (
        {"ResourceClass": "SingleNode"}, {"C": "3"},
    )
    assert [d.task_key for d in task.depends_on] == ["b"]
    assert (task.notebook_task.source, task.notebook_task.base_parameters) == (
        "GIT", {"x": "y"},
    )
    scripts = {
        k: [(s.workspace or s.dbfs).destination
            for s in v.job_clusters[0].new_cluster.init_scripts]
        for k, v in found.items()
    }
    assert scripts == {1: ["/agent.sh"], 2: ["/other.sh", "/agent.sh"],
                       3: ["/other.sh", "/agent.sh"]}


def test_onboarding_keeps_the_schema(spark):
    jobs = frame(spark, JOB, job(1))
    plan = jobdefs.onboard_plan(jobs, PARAMS)
    assert plan.drop("changed").schema.simpleString() == jobs.schema.simpleString()
    assert [r.changed for r in plan.collect()] == [False]


def test_exclude_tasks(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "task_key string")
    assert [r[0] for r in jobdefs.exclude_tasks(df, ["a"]).collect()] == ["b", None]
    assert jobdefs.exclude_tasks(df, None) is df
    assert jobdefs.exclude_tasks(df, [""]) is df


def test_map_upsert(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"},), (None,)], "m map<string,string>")
    rows = df.select(jobdefs.map_upsert(F.col("m"), {"b": "x", "c": "y"}).alias("m")).collect()
    assert [r.m for r in rows] == [{"a": "1", "b": "x", "c": "y"}, {"b": "x", "c": "y"}]
