import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from granary.functions import replaced_day, resolve_type
from granary.operators import loads, schema

COLUMNS = "k long, v string, bucket_id string, system_id string, etl_date string"


def frames(spark):
    tgt = spark.createDataFrame(
        [(1, "old", "b1", "s", "20240101"), (2, "newer", "b2", "s", "20240301"),
         (3, "only target", "b3", "s", "20240101"), (None, "no key", "b4", "s", "20240101"),
         (4, "same day", "b5", "s", "20240201"), (5, "no day", "b6", "s", None)],
        COLUMNS,
    )
    src = spark.createDataFrame(
        [(1, "a", "n1", "t", "20240201"), (2, "b", "n2", "t", "20240201"),
         (4, "c", "n3", "t", "20240201"), (9, "new", "n4", "t", "20240201"),
         (None, "null key", "n5", "t", "20240201"), (5, "d", "n6", "t", "20240201")],
        COLUMNS,
    )
    return src, tgt


MERGED = [
    (1, "a", "b1", "s", "20240201"), (2, "newer", "b2", "s", "20240301"),
    (3, "only target", "b3", "s", "20240101"), (4, "c", "b5", "s", "20240201"),
    (5, "no day", "b6", "s", None), (9, "new", "n4", "t", "20240201"),
    (None, "no key", "b4", "s", "20240101"), (None, "null key", "n5", "t", "20240201"),
]


def test_merge(spark):
    assert rows_of(loads.load_merge(*frames(spark), ["k"], "20240201")) == MERGED


def test_merge_shuffled(spark, no_broadcast):
    assert rows_of(loads.load_merge(*frames(spark), ["k"], "20240201")) == MERGED


def test_merge_without_null_keys_is_idempotent(spark):
    src, tgt = frames(spark)
    src = src.where("k is not null")
    once = loads.load_merge(src, tgt, ["k"], "20240201")
    assert rows_of(loads.load_merge(src, once, ["k"], "20240201")) == rows_of(once)


def test_key_name_inside_another_name_is_still_updated(spark):
    tgt = spark.createDataFrame([(1, "x", "20240101")], "cust_id long, id string, etl_date string")
    src = spark.createDataFrame([(1, "y", "20240201")], "cust_id long, id string, etl_date string")
    assert rows_of(loads.load_merge(src, tgt, ["cust_id"], "20240201")) == [(1, "y", "20240201")]


def test_update_is_idempotent_and_takes_duplicates(spark):
    src, tgt = frames(spark)
    src = src.union(src.where("k = 9")).where("k is not null")
    once = loads.load_update(src, tgt, ["k"])
    assert once.where("k = 9").count() == 2
    assert rows_of(loads.load_update(src, once, ["k"])) == rows_of(once)
    assert {r.k for r in once.collect()} == {1, 2, 3, 4, 5, 9, None}


def test_update_on_two_keys_keeps_nulls(spark):
    tgt = spark.createDataFrame([(1, None, "a"), (1, 2, "b")], "x int, y int, v string")
    src = spark.createDataFrame([(1, None, "c"), (1, 2, "d")], "x int, y int, v string")
    assert rows_of(loads.load_update(src, tgt, ["x", "y"])) == [
        (1, 2, "d"), (1, None, "a"), (1, None, "c")]


def test_add_is_idempotent_and_keeps_null_days(spark):
    _, tgt = frames(spark)
    src = tgt.where("etl_date = '20240101'").withColumn("v", F.lit("again"))
    once = loads.load_add(src, tgt, "etl_date", "20240101")
    assert once.count() == tgt.count() and once.where("etl_date is null").count() == 1
    assert rows_of(loads.load_add(src, once, "etl_date", "20240101")) == rows_of(once)


@pytest.mark.parametrize("rule,day", [(None, "20240301"), ("", "20240301"), ("T-1", "20240301"),
                                      ("T-2", "20240229"), ("T- 3", "20240228")])
def test_replaced_day(rule, day):
    assert replaced_day("20240301", rule) == day


def test_apply_load_refusals(spark):
    src, tgt = frames(spark)
    for bad in (dict(load_type="upsert"), dict(load_type="merge"), dict(load_type="update"),
                dict(load_type="merge", keys=["k"], partitioned=True)):
        with pytest.raises(ValueError):
            loads.apply_load(src, tgt, etl_date="20240201", **bad)
    assert loads.apply_load(src, None, "full", "20240201") is src
    with pytest.raises(ValueError):
        loads.load_initial(src, registered=False, exists=True)


def test_duplicate_source_keys_are_refused(spark):
    src, _ = frames(spark)
    with pytest.raises(ValueError):
        schema.require_unique(src.union(src), ["k"])
    schema.require_unique(src, ["k"])


def test_audit_ids_differ(spark):
    df = loads.with_audit(spark.range(100), "sys", "20240101")
    assert df.select("bucket_id").distinct().count() == 100
    assert df.columns == ["id", "bucket_id", "system_id", "etl_date"]


def test_reconcile(spark):
    expected = spark.createDataFrame([("a", 3), ("b", -1), ("c", 0), ("d", 2)], "t string, expected int")
    actual = spark.createDataFrame([("a", 3), ("b", 5), ("d", 1)], "t string, loaded long")
    got = {r.t: (r.loaded, r.diff, r.status) for r in loads.reconcile_counts(expected, actual, ["t"]).collect()}
    assert got == {"a": (3, 0, "ok"), "b": (5, 6, "failed"), "c": (0, 0, "ok"), "d": (1, -1, "failed")}
    merge = loads.reconcile_counts(expected, actual, ["t"], "merge")
    assert {r.status for r in merge.collect()} == {"ok", "warning"}


@pytest.mark.parametrize("text,want", [
    ("number(10,2)", "decimal(12,2)"), ("NUMBER(30, 20)", "decimal(38,20)"), ("number(10)", "bigint"),
    ("varchar2(50)", "string"), ("date", "timestamp_ntz"), ("decimal(9,1)", "decimal(9,1)"), ("bigint", "bigint"),
])
def test_types(text, want):
    assert resolve_type(text) == want


def test_sized_number_needs_a_mapping():
    with pytest.raises(ValueError):
        resolve_type("number(10)", {})


@pytest.mark.parametrize("broadcast", [True, False])
def test_merge_appends_columns_and_refuses_keys_delivered_twice(spark, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    tgt = spark.createDataFrame([(1, "a", "20240101"), (2, "b", "20240301"), (None, "n", "20240101"), (4, "d", "20240101")], "k int, v string, etl_date string")
    src = spark.createDataFrame([(1, "A", "20240201", 7), (2, "B", "20240201", 8), (3, "C", "20240201", 9), (None, "N", "20240201", 5), (None, "N", "20240201", 5)],
                                "k int, v string, etl_date string, w int")
    merged = loads.load_merge(src, tgt, ["k"], "20240201")
    assert rows_of(merged) == sorted([(1, "A", "20240201", 7), (2, "b", "20240301", None), (3, "C", "20240201", 9), (4, "d", "20240101", None),
                                      (None, "n", "20240101", None), (None, "N", "20240201", 5), (None, "N", "20240201", 5)], key=repr)
    if not broadcast:
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FullOuter") and "BroadcastHashJoin" not in plan
    for twice in (src.union(src.where("k = 1")), src.union(src.where("k = 3"))):
        with pytest.raises(Exception, match="delivered twice"):
            loads.load_merge(twice, tgt, ["k"], "20240201").collect()
