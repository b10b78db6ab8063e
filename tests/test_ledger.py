from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from granary.operators import ledger

DAY = "20240105"


@pytest.fixture(scope="module")
def jobs(spark):
    return spark.createDataFrame(
        [(n, "1", "full", None, 1) for n in ("none", "running", "done", "fixed", "failed", "failed2", "batch", "yesterday")]
        + [("off", "0", "full", None, 1), ("bad", "1", "upsert", None, 2), ("nokey", "1", "merge", "", 1),
           ("keyed", "1", "merge", "id", 1)],
        "job_id string, enabled string, load_type string, load_condition string, load_priority int",
    )


@pytest.fixture(scope="module")
def log(spark):
    def at(h):
        return datetime(2024, 1, 5, h)

    rows = [
        ("1", "b1", "running", "running", DAY, None), ("2", "b1", "done", "success", DAY, at(3)),
        ("3", "b1", "fixed", "error", DAY, at(3)), ("4", "b1", "fixed", "success", DAY, at(4)),
        ("5", "b1", "failed", "success", DAY, at(1)), ("6", "b1", "failed", "error", DAY, at(2)),
        ("7", "b1", "failed2", "error1", DAY, at(2)), ("8", "b0", "batch", "success", DAY, at(2)),
        ("9", "b1", "yesterday", "success", "20240104", at(2)), ("10", "b1", "none", None, DAY, at(2)),
    ]
    return spark.createDataFrame(
        rows, "id string, batch_id string, job_id string, task_status string, etl_date string, end_time timestamp_ntz")


def ids(df):
    return sorted(r.job_id for r in df.collect())


NOT_RUN = ["bad", "keyed", "nokey", "none", "yesterday"]


def test_unprocessed_modes(jobs, log):
    assert ids(ledger.unprocessed(jobs, log, ["job_id"], DAY)) == NOT_RUN
    scoped = ledger.unprocessed(jobs, log, ["job_id"], DAY, scope="b0")
    assert ids(scoped) == sorted(NOT_RUN + ["done", "fixed", "failed", "failed2"])
    some = ledger.unprocessed(jobs, log, ["job_id"], DAY, scope="b0", ids=["done", "off", "running", "keyed"])
    assert ids(some) == ["done", "keyed"]


def latest(log):
    now = F.lit("2024-01-06 00:00:00").cast("timestamp_ntz")
    return ledger.latest_per_key(log.where(F.col("etl_date") == DAY), ["job_id"], "end_time", ["id"], now)


def test_latest_counts_open_runs_as_now(spark, log):
    more = log.union(log.where("id = '2'").withColumn("id", F.lit("99")).withColumn("end_time", F.lit(None).cast("timestamp_ntz")))
    assert latest(more).where("job_id = 'done'").first().id == "99"
    assert latest(log).count() == 7


def test_retryable_and_failed(jobs, log):
    assert ids(ledger.retryable(jobs, latest(log), ["job_id"])) == sorted(NOT_RUN + ["failed"])
    assert ids(ledger.failed_items(jobs, latest(log), ["job_id"])) == ["failed2"]


def test_in_state(log):
    assert ids(ledger.in_state(log, "running", DAY)) == ["running"]
    assert ids(ledger.in_state(log, "success", DAY, ids=["done", "fixed"])) == ["done", "fixed"]


def test_gate(spark, jobs, log):
    upstream = spark.createDataFrame([("done",), ("failed2",), ("keyed",), ("fixed",)], "job_id string")
    assert ids(ledger.gated(jobs, upstream, log, ["job_id"])) == ["done", "failed2", "fixed"]
    assert ledger.gated(jobs, upstream, log, ["job_id"], strict=False).count() == 11
    assert ledger.gated(jobs, upstream.where("false"), log, ["job_id"], strict=False).count() == 0


def test_job_rules(jobs):
    rules = {
        "load_type": ledger.allowed("load_type", ["full", "add", "merge", "update"]),
        "load_condition": ledger.required_if("load_type in ('merge', 'update')", "load_condition"),
    }
    bad = ledger.validate_rows(jobs, rules).where("size(reasons) > 0")
    assert {r.job_id: r.reasons for r in bad.collect()} == {"bad": ["load_type"], "nokey": ["load_condition"]}


def test_priority_ties_go_by_key(jobs):
    assert [r.job_id for r in ledger.top_by_priority(jobs, ["load_priority", "job_id"], 3).collect()] == [
        "batch", "done", "failed"]


def test_run_durations_and_long_text(spark):
    events = spark.createDataFrame(
        [("t", 1, "running", datetime(2024, 1, 1, 0, 0, 0), "x" * 6000), ("t", 2, "success", datetime(2024, 1, 1, 0, 0, 9), ""),
         ("t", 3, "running", datetime(2024, 1, 2), None)],
        "job string, id int, status string, at timestamp_ntz, info string")
    got = ledger.run_durations(events, ["job"], "at", "id", ["status"], "status = 'running'")
    assert [(r.id, r.next_status, r.used_seconds, len(r.info or "")) for r in got.orderBy("id").collect()] == [
        (1, "success", 9, 6000), (3, None, None, 0)]


def test_completion(spark):
    parts = spark.createDataFrame([("a", "ok"), ("a", "ok"), ("b", "ok"), ("b", "bad"), ("c", None)], "t string, s string")
    assert rows_of(ledger.completion_check(parts, ["t"], "s = 'ok'")) == [
        ("a", 2, 2, True), ("b", 2, 1, False), ("c", 1, 0, False)]


def test_issues_of_all_checks(spark):
    one = spark.range(1).select(*ledger.issue("key", "3", F.lit("t"), F.col("id")), F.lit(1).alias("more"))
    two = spark.range(1).select(*ledger.issue("count", "2", F.lit("u"), F.lit("-1")))
    assert rows_of(ledger.issues(one, two)) == [("count", "2", "u", "-1"), ("key", "3", "t", "0")]
