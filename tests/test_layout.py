import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from granary.operators import layout


def shift(day, n):
    return (datetime.strptime(day, "%Y%m%d") + timedelta(days=n)).strftime("%Y%m%d")


def packed(histogram, total, limit):
    """The packing rule, one day at a time."""
    rows = sum(n for _, n in histogram)
    out, acc, start = [], 0, None
    lower, last = shift(histogram[0][0], -1), histogram[-1][0]
    for day, n in histogram:
        start = day if acc == 0 else start
        acc += n
        mb = total * acc / rows
        if day == last:
            days = (datetime.strptime(last, "%Y%m%d") - datetime.strptime(start, "%Y%m%d")).days
            width = min(days * int(limit / mb) + 1, layout.MAX_SPAN_DAYS)
            out.append((f"partition_{start}", lower, max(shift(start, width), shift(last, 1))))
        elif mb >= limit:
            out.append((f"partition_{start}", lower, day))
            lower, acc = day, 0
    return out


def random_tables(count, seed):
    rng = random.Random(seed)
    tables = {}
    for t in range(count):
        days = sorted(rng.sample(range(400), rng.randrange(1, 60)))
        tables[t] = [
            (shift("20230101", d), rng.choice([1, 2, 5, 50, 1000])) for d in days
        ]
    return tables


def test_pack_follows_the_rule_and_covers_every_day_once(spark):
    tables = random_tables(150, 11)
    total, limit = 1000.0, 90.0
    histogram = spark.createDataFrame(
        [(t, d, n) for t, days in tables.items() for d, n in days], "t int, day string, n long"
    )
    got = layout.pack_day_partitions(histogram, total, limit, by=["t"]).collect()
    for t, days in tables.items():
        parts = [(r.partition_name, r.lower, r.upper) for r in got if r.t == t]
        assert sorted(parts, key=lambda p: p[2]) == packed(days, total, limit)
        for day, _ in days:
            assert sum(lower <= day < upper for _, lower, upper in parts) == 1
        assert max(upper for _, _, upper in parts) > days[-1][0]


def test_pack_of_an_empty_delivery(spark):
    empty = spark.createDataFrame([], "day string, n long")
    assert layout.pack_day_partitions(empty, 10.0, 1.0).count() == 0


def test_text_that_is_no_day_fails(spark):
    df = spark.createDataFrame([("20240101", 5), ("20240231", 1)], "day string, n long")
    with pytest.raises(Exception, match="not a calendar day"):
        layout.pack_day_partitions(df, 10.0, 1.0).collect()


def test_null_day_fails(spark):
    df = spark.createDataFrame([("20240101",), (None,)], "day string")
    with pytest.raises(Exception, match="holds NULL"):
        layout.day_histogram(df, "day").collect()


@pytest.mark.parametrize("few", [64, 2])
def test_range_label_agrees_with_predicates(spark, monkeypatch, few):
    monkeypatch.setattr(layout, "FEW_BOUNDS", few)
    rng = random.Random(5)
    for with_max in (True, False):
        values = sorted(rng.sample(range(1000), 37))
        bounds = [(f"p{i}", (v,)) for i, v in enumerate(values)]
        if with_max:
            bounds.append(("pmax", (layout.MAXVALUE,)))
        df = spark.range(1050).select(F.col("id").cast("int").alias("c")).union(
            spark.sql("select cast(null as int) c")
        )
        labelled = layout.assign_range_partition(df, ["c"], bounds)
        for name, predicate in layout.range_conditions(["c"], bounds):
            want = rows_of(df.where(predicate))
            assert rows_of(labelled.where(F.col("partition_name") == name).select("c")) == want
        lost = labelled.where("partition_name is null")
        assert lost.count() == (1 if with_max else 1 + 1050 - values[-1])


def test_repeated_bounds_keep_their_interval(spark):
    low, high = layout.MINVALUE, layout.MAXVALUE
    assert layout.intervals([1, 1, 2, high]) == [(low, 1), (low, 1), (1, 2), (2, high)]
    assert layout.intervals([low, 5]) == [(low, low), (low, 5)]
    bounds = [("a", (1, 10)), ("b", (1, 20)), ("c", (2, 30)), ("d", (high, high))]
    df = spark.createDataFrame([(0, 5), (0, 15), (1, 25), (2, 30), (0, 25), (None, 5), (1, None)], "x int, y int")
    got = layout.assign_range_partition(df, ["x", "y"], bounds).select("partition_name").collect()
    assert [r[0] for r in got] == ["a", "b", "c", "d", None, None, None]


def test_minvalue_bound_holds_nothing(spark):
    bounds = [("none", (layout.MINVALUE,)), ("low", (10,)), ("high", (layout.MAXVALUE,))]
    df = layout.assign_range_partition(spark.range(20), ["id"], bounds)
    assert rows_of(df.groupBy("partition_name").count()) == [("high", 10), ("low", 10)]


def test_unordered_bounds_are_refused(spark):
    with pytest.raises(ValueError):
        layout.assign_range_partition(spark.range(3), ["id"], [("a", (5,)), ("b", (2,))])


def test_list_partitions_short_and_long(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("a"), F.concat(F.lit("v"), F.col("id") % 3).alias("b"))
    labels = ["a=1/b=v2", "a=4/b=v0", "a=9/b=v0"]
    short = rows_of(layout.filter_list_partitions(df, labels))
    assert len(short) == 13
    more = [f"b=v{9 + i}/a={i}" for i in range(200)]  # in another order of the columns
    assert rows_of(layout.filter_list_partitions(df, labels + more)) == short
    with pytest.raises(ValueError):
        layout.filter_list_partitions(df, ["a=1", "b=v2"])
    assert layout.filter_list_partitions(df, []).count() == 0


def test_quotes_and_backslashes_in_values(spark):
    df = spark.createDataFrame([("o'x",), ("a\\b",), ("c=d",)], "a string")
    for value in ("o'x", "a\\b", "c=d"):
        assert rows_of(layout.filter_list_partitions(df, [f"a={value}"])) == [(value,)]


def test_summary_keeps_tables_without_ranges(spark):
    tables = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "table string")
    parts = spark.createDataFrame(
        [("t1", "p1", "MINVALUE", "20240101"), ("t1", "p2", "20240101", "20240201"),
         ("t1", "p3", "20240201", "20240301"), ("t2", "p1", "MINVALUE", "20240101")],
        "table string, partition_name string, range_start string, range_end string",
    )
    buckets = spark.createDataFrame([("t1", 4), ("t3", 9)], "table string, bucket_number int")
    got = rows_of(layout.partition_summary(tables, parts, buckets))
    assert got == [
        ("t1", "p3", "20240201", "20240301", "20240201", 4),
        ("t2", None, None, None, None, None),
        ("t3", None, None, None, None, 9),
    ]


def test_next_bound(spark):
    stats = spark.createDataFrame(
        [("20240101", "20240201", 320.0, 10), ("MINVALUE", "20240201", 0.0, 10),
         ("20240101", "20250101", 320.0, 10), ("20240101", "20240201", 1e-9, 10)],
        "newest_start string, newest_end string, newest_mb double, bucket_number int",
    )
    got = layout.next_partition_bound(stats, "20240301", incoming_mb=70.0).collect()
    # 700 MB of room at 10 MB a day; at 70 MB a day; newest partition still open; thirty years
    assert [r.span_days for r in got] == [71, 11, 10950 if 700 // (320 / 367) + 1 > 10950 else int(700 // (320 / 367)) + 1, 10950]
    assert [r.next_bound for r in got] == [
        shift("20240301", 71), shift("20240301", 11), None, shift("20240301", 10950)]


def test_file_counts(spark):
    row = spark.range(1).select(
        layout.file_count(F.lit(139.9)), layout.file_count(F.lit(140.0)),
        layout.file_count_partitioned(F.lit(100.0), F.lit(10)),
        layout.file_count_partitioned(F.lit(1e6), F.lit(10)),
    ).first()
    assert tuple(row) == (2, 3, 8, 61)


def test_size_output_file_count(spark, tmp_path):
    layout.size_output(spark.range(1000), 300.0).write.orc(str(tmp_path / "o"))
    assert len(list((tmp_path / "o").glob("*.orc"))) == 5


@pytest.mark.parametrize("many", [False, True])
def test_listed_labels_are_typed(spark, many, monkeypatch):
    """Escaped values, NULL, and a list whose plan does not grow."""
    rows = [("x/y", 1), (None, 1), ("50%", None), ("a=b", 10), ("z", 9), ("plain", 2)]
    df = spark.createDataFrame(rows, "a string, b int")
    labels = ["b=1/a=x%2Fy", "b=1/a=__HIVE_DEFAULT_PARTITION__", "b=__HIVE_DEFAULT_PARTITION__/a=50%25", "a=a%3Db/b=10", "a=z/b=1"]
    if many:
        labels += [f"a=v{i}/b={i}" for i in range(1000, 6000)]
    found = layout.filter_list_partitions(df, labels)
    assert rows_of(found) == sorted([("x/y", 1), (None, 1), ("50%", None), ("a=b", 10)], key=repr)
    assert len(found._jdf.queryExecution().analyzed().toString()) < 5000


@pytest.mark.parametrize("last", ["ascending", "three columns", "mixed"])
def test_many_bounds_on_several_columns(spark, last, monkeypatch):
    """The search by halving gives what one condition per bound gives."""
    draw = random.Random(4)
    seconds = [5, 20, 40, layout.MAXVALUE]
    bounds = []
    for i, first in enumerate([10, 20, 35, 50, layout.MAXVALUE]):
        for j, second in enumerate(seconds if last != "mixed" else draw.sample([3, 9, 27, 30], 3)):
            bounds.append((f"p{i}_{j}", (first, second, "m") if last == "three columns" else (first, second)))
    if last != "mixed":  # a run begins where the one before ends, so MAXVALUE there would leave it no room
        bounds = [b for b in bounds if b[1][1] != layout.MAXVALUE or b[1][0] == layout.MAXVALUE]
    values = [None, -1, 0, 3, 5, 9, 10, 19, 20, 27, 34, 35, 40, 49, 50, 99]
    df = spark.createDataFrame([(a, b, c) for a in values for b in values for c in ("a", "z", None)], "a int, b bigint, c string")
    columns = ["a", "b", "c"][: len(bounds[0][1])]
    monkeypatch.setattr(layout, "FEW_BOUNDS", 1000)
    want = rows_of(layout.assign_range_partition(df, columns, bounds))
    monkeypatch.setattr(layout, "FEW_BOUNDS", 1)
    found = layout.assign_range_partition(df, columns, bounds)
    assert rows_of(found) == want and any(r[-1] for r in want)


def test_the_plan_of_many_bounds_does_not_grow(spark):
    df = spark.range(10).selectExpr("id a", "id b")
    sizes = []
    for n in (100, 5000):
        bounds = [(f"p{i}_{j}", (10 * (i + 1), 10 * (j + 1))) for i in range(n // 50) for j in range(50)]
        found = layout.assign_range_partition(df, ["a", "b"], bounds)
        sizes.append(found._jdf.queryExecution().analyzed().toString().count("try_element_at"))
        assert {r.partition_name for r in found.collect()} == {"p0_0"}
    assert sizes[0] == sizes[1]
