from datetime import datetime

from conftest import rows_of
from granary.operators import exchange, retention


def listing(spark, rows):
    return spark.createDataFrame(rows, "root string, partition_name string, path string, length long, modified timestamp_ntz")


def test_detect_changes(spark):
    day, old = datetime(2024, 1, 5), datetime(2024, 1, 4, 23, 59)
    files = listing(spark, [
        ("r", "newer", "a", 5, datetime(2024, 2, 1)), ("r", "newer", "b", 5, old), ("r", "exact", "c", 5, day),
        ("r", "older", "d", 5, old), ("r", "zero", "e", 0, old), ("r", "both", "f", 0, day),
        ("r", None, "g", 5, day)])
    known = spark.createDataFrame(
        [("r", p) for p in ("newer", "exact", "older", "zero", "both", "absent", "nofiles", None)], "root string, partition_name string")
    present = known.where("coalesce(partition_name, '') <> 'absent'")
    got = exchange.detect_changes(known, files, "20240105", ["root", "partition_name"], present)
    assert {r.partition_name: (r.state, r.code) for r in got.collect()} == {
        "newer": ("changed", -1), "exact": ("changed", -1), "older": ("unchanged", 0), "zero": ("empty", -2),
        "both": ("changed", -1), "absent": ("missing", -3), "nofiles": ("empty", -2), None: ("changed", -1)}


def test_import_sql_keeps_null_and_is_idempotent(spark):
    tgt = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, n int")
    staged = spark.createDataFrame([(9, 70)], "id int, n int")
    once = exchange.import_sql(staged, tgt, ["n > 10"])
    assert rows_of(once) == [(1, 5), (2, None), (9, 70)]
    assert rows_of(exchange.import_sql(staged, once, ["n > 10"])) == rows_of(once)


def test_import_partition_is_idempotent_and_truncates(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, partition_name string")
    staged = spark.createDataFrame([(7, "a"), (8, "x")], "id int, partition_name string")
    plan = spark.createDataFrame([("a", "replace"), ("b", "truncate"), ("c", "missing")], "partition_name string, action string")
    once = exchange.import_partition(staged, tgt, plan)
    assert rows_of(once) == [(3, "c"), (7, "a")]
    assert rows_of(exchange.import_partition(staged, once, plan)) == rows_of(once)


def test_retention_ties_and_small_roots(spark):
    at = datetime(2024, 1, 1)
    files = listing(spark, [("r", None, p, 1, at) for p in "cabd"] + [("s", None, "z", 1, at)]
                    + [(None, None, p, 1, at) for p in "xyz"])
    expired = retention.expired_entries(files, 2)
    assert sorted(r.path for r in expired.collect()) == ["c", "d", "z"]
    assert expired.where("root is null").count() == 1
    assert retention.expired_entries(files, 0).count() == 8
