import random

import brute
import pytest

from runledger.llm import components as module
from runledger.llm.components import components


@pytest.mark.parametrize("kind", ["path", "star", "random", "cycle"])
def test_equals_union_find(spark, monkeypatch, kind):
    rng = random.Random(kind)
    names = list(range(60))
    rng.shuffle(names)
    edges = {
        "path": list(zip(names, names[1:], strict=False)),
        "star": [(names[0], x) for x in names[1:]],
        "random": [(rng.choice(names), rng.choice(names)) for _ in range(35)],
        "cycle": list(zip(names, names[1:] + names[:1], strict=True)),
    }[kind]
    groups = brute.Groups(x for edge in edges for x in edge)
    for a, b in edges:
        groups.join(a, b)
    df = spark.createDataFrame(edges + edges[:3] + [(None, 1)], "a bigint, b bigint")
    expected = sorted((x, groups.find(x)) for x in groups.parent)
    assert sorted(map(tuple, components(df).collect())) == expected
    # The same where nothing may be broadcast.
    monkeypatch.setattr(module, "fits_broadcast", lambda df: False)
    assert sorted(map(tuple, components(df).collect())) == expected


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_few_edges_are_contracted_without_shuffles(spark):
    """On many partitions the rounds of a small table would otherwise run thousands of tasks."""
    settings = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    context = spark.sparkContext
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        context.setJobGroup("few-edges", "")
        found = {r.node: r.root for r in components(edges).collect()}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == dict.fromkeys(range(61), 0)
    status = context.statusTracker()
    jobs = [status.getJobInfo(j) for j in status.getJobIdsForGroup("few-edges")]
    stages = {s for job in jobs for s in job.stageIds}
    assert sum(info.numTasks for s in stages if (info := status.getStageInfo(s))) < 250
