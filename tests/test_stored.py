"""Versions, refreshed days, buckets and daily sets."""

import datetime as dt
import os
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from runledger.operators import counts, reports, skew, usage
from runledger.operators.usage import all_job_clusters, run_usage
from runledger.samples import orders, queries
from runledger.samples import stored as stored_queries
from runledger.sources import buckets, tables, versions
from runledger.sources.scratch import scratch_path
from runledger.sources.views import create_views

# --- versions --------------------------------------------------------------------


def failing(spark):
    """A table whose write fails in the middle."""
    return spark.range(1000).select(
        F.when(F.col("id") == 700, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id")
    )


NAMES = [f"t{i}" for i in range(8)]


def test_failed_write_leaves_the_old_tables(spark, tmp_path):
    path = str(tmp_path)
    tables.write_tables(spark, {n: spark.range(i) for i, n in enumerate(NAMES)}, path=path)
    new = {n: spark.range(100) for n in NAMES[:5]} | {NAMES[5]: failing(spark), NAMES[6]: spark.range(9)}
    with pytest.raises(Exception, match="lost"):
        tables.write_tables(spark, new, path=path)
    read = tables.read_tables(spark, path, *NAMES)
    assert [read[n].count() for n in NAMES] == list(range(8))
    tables.write_tables(spark, {NAMES[5]: spark.range(50)}, path=path)
    read = tables.read_tables(spark, path, *NAMES)
    assert [read[n].count() for n in NAMES] == [0, 1, 2, 3, 4, 50, 6, 7]


def test_failed_write_leaves_the_old_schema(spark):
    tables.write_tables(spark, {n: spark.range(3) for n in NAMES}, schema="kept")
    with pytest.raises(Exception, match="lost"):
        tables.write_tables(spark, {"t0": spark.range(8), "t1": failing(spark)}, schema="kept")
    assert [spark.table(f"kept.{n}").count() for n in NAMES] == [3] * 8


def test_plain_managed_table_becomes_a_view(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS older")
    spark.range(4).write.saveAsTable("older.t")
    for n in (5, 6, 7):
        tables.write_tables(spark, {"t": spark.range(n)}, schema="older")
    assert spark.table("older.t").count() == 7
    assert len([t for t in tables.list_tables(spark, "older") if t.startswith("t__v")]) == 2


def test_history_and_expiry(spark, tmp_path):
    path = str(tmp_path)
    assert versions.history(spark, path) == []
    for n in (1, 2, 3):
        tables.write_tables(spark, {"a": spark.range(n)} | ({"b": spark.range(9)} if n == 1 else {}), path=path)
    assert [v for v, _ in versions.history(spark, path)] == [1, 2, 3]
    assert versions.read_version(spark, path, "a", 1).count() == 1
    assert versions.expire(spark, path, keep=2) == [versions.history(spark, path)[0][1]["a"]]
    # The table that was written once only is still in use.
    assert versions.read_version(spark, path, "b").count() == 9
    assert versions.read_version(spark, path, "a", 2).count() == 2
    with pytest.raises(ValueError, match="no version 7"):
        versions.read_version(spark, path, "a", 7)
    with pytest.raises(ValueError, match="no table"):
        versions.read_version(spark, path, "c")
    with pytest.raises(ValueError, match="at least 1"):
        versions.expire(spark, path, keep=0)


def test_two_writers_of_a_version(spark, tmp_path):
    path = str(tmp_path)
    first, _ = versions.new_folder(spark, path)
    second, _ = versions.new_folder(spark, path)
    versions.publish(spark, path, first, {"a": "one"})
    with pytest.raises(versions.Conflict):
        versions.publish(spark, path, second, {"a": "two"})
    assert versions.published(spark, path) == {"a": "one"}


def test_scratch_needs_a_shared_folder():
    def session(master, folder):
        context = SimpleNamespace(master=master, applicationId="app")
        return SimpleNamespace(sparkContext=context, conf={"spark.checkpoint.dir": folder})

    assert scratch_path(session("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/runledger-app/x-")
    assert "/runledger-app/x-" in scratch_path(session("local[4]", None), "x")
    with pytest.raises(ValueError, match="checkpoint.dir"):
        scratch_path(session("yarn", None), "x")


# --- refreshed days --------------------------------------------------------------

DAY_MS = 86_400_000


def run_rows(spark, rows):
    return spark.createDataFrame(
        [(r, t, d * DAY_MS + 5, s) for r, t, d, s in rows],
        "run_id long, task_key string, run_starttime long, run_result_state string",
    )


def files(path):
    return {
        os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


def test_look_back_rewrites_its_days_only(spark, tmp_path):
    path = str(tmp_path)
    old = [(d * 10 + k, t, d, "SUCCESS" if d < 7 else "PENDING")
           for d in range(10) for k in range(4) for t in "ab"]
    tables.write_tables(spark, {"job_run_info": run_rows(spark, old)}, path=path, runs_by_day=True)
    stored = f"{path}/{versions.published(spark, path)['job_run_info']}"
    before = files(stored)
    # Three days again: run 71 finished, with one task; run 95 is new; run 72 is not listed.
    fetched = [(71, "a", 7, "FAILED"), (80, "a", 8, "SUCCESS"), (95, "a", 9, "SUCCESS"),
               (5, "a", 0, "TOO OLD")]
    merged = tables.merge_runs(
        spark, path, "job_run_info", run_rows(spark, fetched), dt.date(1970, 1, 8)
    )
    want = [r for r in old if r[0] not in (71, 80)] + fetched[:3]
    got = [(r.run_id, r.task_key, r.run_starttime // DAY_MS, r.run_result_state) for r in merged.collect()]
    assert sorted(got) == sorted(want)
    after = files(stored)
    changed = {re.search(r"run_day=([\d-]+)", f)[1] for f, _ in set(before.items()) ^ set(after.items())}
    assert changed == {"1970-01-08", "1970-01-09", "1970-01-10"}
    again = tables.merge_runs(
        spark, path, "job_run_info", run_rows(spark, fetched), dt.date(1970, 1, 8)
    )
    assert again.count() == len(want)


def test_merge_reads_its_days_only(spark, tmp_path):
    path = str(tmp_path)
    rows = run_rows(spark, [(d, "a", d, "SUCCESS") for d in range(30)])
    tables.write_tables(spark, {"job_run_info": rows, "other": spark.range(1)}, path=path, runs_by_day=True)
    stored = tables.read_tables(spark, path, "job_run_info")["job_run_info"]
    plan = stored.where(F.col("run_day") >= F.lit(dt.date(1970, 1, 28)))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(run_day" in plan
    with pytest.raises(ValueError, match="not stored by day"):
        tables.merge_runs(spark, path, "other", rows, dt.date(1970, 1, 1))


# --- views -----------------------------------------------------------------------


def test_views_by_name_in_another_session(spark, sf_dir):
    stored = {
        "job_run_info": orders.runs(spark, sf_dir), "fleet_size": orders.sizes(spark),
        "job_run_cluster_info": orders.with_cluster(spark, sf_dir),
    }
    tables.write_tables(spark, stored, schema="viewed")
    create_views(spark, "viewed")
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    runs, clusters = orders.runs(other, sf_dir), orders.with_cluster(other, sf_dir)
    for name, want in (
        ("run_usage", run_usage(runs, clusters, orders.sizes(other))),
        ("all_job_clusters", all_job_clusters(clusters)),
    ):
        found = other.table(f"viewed.{name}")
        assert found.columns == want.columns
        assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()
    # New versions of the tables are seen through the views.
    tables.write_tables(spark, {"job_run_info": runs.limit(0)}, schema="viewed")
    assert other.table("viewed.run_usage").isEmpty()


def test_days_are_in_order(spark, sf_dir):
    days = [r["day"] for r in queries.daily_usage(spark, sf_dir).select("day").collect()]
    assert days == sorted(days) and len(set(days)) > 100


# --- buckets ---------------------------------------------------------------------


def exchanges_under_joins(plan):
    """Shuffles below the first join of a formatted plan."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    depth = len(re.match(r"[ :|+-]*", lines[at])[0])
    below = []
    for line in lines[at + 1 :]:
        if not line.strip() or len(re.match(r"[ :|+-]*", line)[0]) <= depth:
            break
        below.append(line)
    return [line for line in below if re.search(r"\bExchange\b", line)]


def test_bucketed_usage_has_no_shuffle_under_the_join(spark, sf_dir, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    runs, clusters = orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir)
    sizes = orders.sizes(spark)
    buckets.write_bucketed(spark, runs, clusters, "bucketed", 4)
    for match in ("task", "run"):
        found = buckets.bucketed_usage(spark, "bucketed", sizes, match)
        plain = run_usage(runs, clusters, sizes, match)
        assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    stored = run_usage(
        spark.table("bucketed.job_run_info"), spark.table("bucketed.job_run_cluster_info"), sizes,
        split_rows=None,
    )
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 4 out of 4" in plan
    assert exchanges_under_joins(plan) == []
    unstored = run_usage(runs, clusters, sizes)._jdf.queryExecution().executedPlan().toString()
    assert exchanges_under_joins(unstored) != []


def test_large_jobs_and_rows_without_key_are_apart(spark, sf_dir):
    runs = orders.runs(spark, sf_dir)
    clusters, sizes = orders.with_cluster(spark, sf_dir), orders.sizes(spark)
    hot = F.when(F.col("run_id") % 3 == 0, 7).when(F.col("run_id") % 3 == 1, None).otherwise(F.col("job_id"))
    runs, clusters = (df.withColumn("job_id", hot.cast("long")) for df in (runs, clusters))
    buckets.write_bucketed(spark, runs, clusters, "apart", 4, split_rows=500)
    read = buckets.read_bucketed(spark, "apart")
    for name, df in (("job_run_info", runs), ("job_run_cluster_info", clusters)):
        assert read[name].count() == df.count()
        apart = {r[0] for r in read[name + "_apart"].select("job_id").distinct().collect()}
        assert apart == {7, None}
    found = buckets.bucketed_usage(spark, "apart", sizes, split_rows=500)
    plain = run_usage(runs, clusters, sizes)
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    with pytest.raises(ValueError, match="at least 1"):
        buckets.write_bucketed(spark, runs, clusters, "apart", 0)


# --- daily sets ------------------------------------------------------------------


def daily_rows(spark):
    rows = [
        (dt.date(2024, 1, 1 + i % 20), "xyz"[i % 3] if i % 11 else None, f"v{i * i % 97}" if i % 7 else None, str(i % 300))
        for i in range(3000)
    ]
    rows += [(dt.date(2024, 1, 5), "only nulls", None, "1")] + [(dt.date(2024, 1, 6), "x", "hot", "2")] * 500
    return spark.createDataFrame(rows, "day date, dim string, a string, b string")


MEASURES = {"n_a": "a", "n_b": "b"}


def numbers(spark, rows, path, known=None):
    out = {}
    for name, value in MEASURES.items():
        firsts = counts.first_days(rows, value)
        if known is None:
            out[name] = counts.number_values(firsts, f"{path}/{name}")
        else:
            out[name] = counts.extend_numbers(known[name], firsts, f"{path}/{name}-more")
    return out


WINDOWS = [(None, None), (dt.date(2024, 1, 3), dt.date(2024, 1, 4)), (dt.date(2024, 1, 4), dt.date(2024, 1, 17)),
           (dt.date(2025, 1, 1), None)]


def same_counts(rows, partials, dims):
    for start, end in WINDOWS:
        inside = rows
        if start:
            inside = inside.where(F.col("day") >= F.lit(start))
        if end:
            inside = inside.where(F.col("day") < F.lit(end))
        want = inside.groupBy(*dims).agg(*(F.countDistinct(v).alias(m) for m, v in MEASURES.items()))
        found = counts.window_counts(partials, dims, list(MEASURES), start, end)
        assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())), (start, dims)


def test_windows_of_daily_sets_equal_distinct_counts(spark, tmp_path):
    rows = daily_rows(spark)
    partials = counts.store_partials(
        counts.daily_partials(rows, ["dim"], MEASURES, numbers(spark, rows, tmp_path)), f"{tmp_path}/p"
    )
    for dims in (["dim"], []):
        same_counts(rows, partials, dims)
    plan = counts.window_counts(partials, ["dim"], list(MEASURES))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "HashAggregate" in plan and "bit_or" in plan


def test_numbers_are_dense_and_follow_the_days(spark, tmp_path):
    rows = daily_rows(spark)
    found = numbers(spark, rows, tmp_path)["n_a"].join(counts.first_days(rows, "a"), "value")
    ordered = found.orderBy("number").collect()
    assert [r["number"] for r in ordered] == list(range(len(ordered)))
    assert [(r["first"], r["value"]) for r in ordered] == sorted((r["first"], r["value"]) for r in ordered)


def test_new_days_are_appended(spark, tmp_path):
    rows = daily_rows(spark)
    early, late = (rows.where(F.col("day") < F.lit(dt.date(2024, 1, 9))), rows.where(F.col("day") >= F.lit(dt.date(2024, 1, 9))))
    known = numbers(spark, early, tmp_path)
    path = f"{tmp_path}/p"
    counts.store_partials(counts.daily_partials(early, ["dim"], MEASURES, known), path)
    more = numbers(spark, late, tmp_path, known)
    partials = counts.store_partials(counts.daily_partials(late, ["dim"], MEASURES, more), path)
    same_counts(rows, partials, ["dim"])
    assert more["n_a"].select("number").distinct().count() == more["n_a"].count()


def test_estimate_from_days_equals_the_estimate(spark, sf_dir, tmp_path):
    usage = run_usage(
        orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir), orders.sizes(spark), "run"
    ).withColumn("day", F.date_from_unix_date((F.col("run_starttime") / DAY_MS).cast("int")))
    found = {
        name: counts.number_values(counts.first_days(usage, value), f"{tmp_path}/{name}")
        for name, value in reports.JOBS_AND_RUNS.items()
    }
    partials = counts.store_partials(
        counts.daily_partials(usage, [], reports.JOBS_AND_RUNS, found), f"{tmp_path}/p"
    )
    sums = reports.daily_core_hours(usage)
    for start, end in ((dt.date(1996, 1, 1), dt.date(1996, 3, 1)), (dt.date(2040, 1, 1), dt.date(2040, 2, 1))):
        days = (end - start).days
        want = reports.usage_estimate(usage, start, end, days).first()
        assert reports.estimate_from_days(partials, sums, start, end, days).first() == want


@pytest.mark.parametrize("name", ["window_usage", "window_pool_usage", "window_submits"])
def test_windows_pair_runs_and_clusters_once(spark, sf_dir, monkeypatch, name):
    """Each measure reads stored pairs; the orders are not joined again for it."""
    read, partials = [], stored_queries._partials

    def watched(spark, rows, *rest):
        read.extend(rows.inputFiles())
        return partials(spark, rows, *rest)

    monkeypatch.setattr(stored_queries, "_partials", watched)
    stored_queries.STORED_QUERIES[name](spark, sf_dir)
    assert read and not any(sf_dir in path for path in read)


def test_buckets_follow_the_rows(spark, sf_dir, monkeypatch):
    asked, write = [], stored_queries.write_bucketed

    def watched(*args):
        asked.append(args[4])
        return write(*args)

    monkeypatch.setattr(stored_queries, "write_bucketed", watched)
    monkeypatch.setattr(stored_queries, "TASK_ROWS", 500, raising=False)
    found = stored_queries.stored_run_usage(spark, sf_dir)
    lines = orders.read(spark, sf_dir, "lineitem").count()
    assert asked == [-(-lines // 500)] and asked[0] > stored_queries.BUCKETS
    assert found.count() > 0


def test_partitions_follow_the_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 200, raising=False)
    lines = orders.read(spark, sf_dir, "lineitem").count()
    parts = -(-lines // 200)
    runs, clusters = orders.runs(spark, sf_dir), orders.with_cluster(spark, sf_dir)
    assert runs.rdd.getNumPartitions() == parts
    # Spark puts empty partitions of the join together, but not below its own number of eight.
    assert usage.join_clusters(runs, clusters, ["driver_node"]).rdd.getNumPartitions() > 8
