"""Heavy keys take another route through the plan and must not change any result."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows_of
from granary.operators import ledger, retention
from granary.operators.skew import (
    heavy_keys,
    keyed_join,
    listed_join,
    next_in_order,
    rows_without_match,
    with_run,
)


def skewed(spark, n=6000):
    """A third of the rows on one key, a tenth on NULL, the rest spread."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(F.col("id") % 500)
    )
    return spark.range(n).select(key.cast("long").alias("k"), F.lit("x").alias("s"), "id")


def test_heavy_keys_finds_the_hot_ones(spark):
    found = heavy_keys(skewed(spark), ["k"], share=0.05, min_rows=1)
    hashes = {
        row.h
        for row in spark.sql("select xxhash64(7L) h union all select xxhash64(cast(null as long))").collect()
    }
    assert set(found) == hashes
    assert max(found.values()) >= 6


def test_heavy_keys_of_nothing(spark):
    assert heavy_keys(skewed(spark).where("false"), ["k"], min_rows=1) == {}
    assert heavy_keys(skewed(spark), ["k"]) == {}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_keyed_join_split(spark, no_broadcast, how):
    left = skewed(spark)
    right = spark.range(0, 500, 2).union(spark.range(7, 8)).select(
        F.col("id").alias("k"), (F.col("id") * 10).alias("v")
    )
    split = keyed_join(left, right, ["k"], how, share=0.01, min_rows=1)
    assert "BroadcastHashJoin" in split._jdf.queryExecution().toString()
    assert rows_of(split) == rows_of(left.join(right, ["k"], how))


@pytest.mark.parametrize("how", ["inner", "left_anti"])
def test_keyed_join_null_safe(spark, no_broadcast, how):
    left = skewed(spark)
    right = left.groupBy("k").agg(F.max("id").alias("m")).where("m > 5990")
    split = keyed_join(left, right, ["k"], how, share=0.01, min_rows=1, null_safe=True)
    renamed = right.withColumnRenamed("k", "rk")
    plain = left.join(renamed, left.k.eqNullSafe(renamed.rk), how).drop("rk")
    assert rows_of(split) == rows_of(plain)


def test_keyed_join_float_zero_and_two_keys(spark, no_broadcast):
    left = spark.createDataFrame(
        [(0.0, 1, i) for i in range(50)] + [(-0.0, 1, i) for i in range(50)] + [(2.5, 2, 0)],
        "f double, g int, i int",
    )
    right = spark.createDataFrame([(-0.0, 1, "zero"), (2.5, 2, "other")], "f double, g int, name string")
    split = keyed_join(left, right, ["f", "g"], "inner", share=0.1, min_rows=1)
    assert split.count() == 101


def test_keyed_join_refuses_different_key_types(spark):
    with pytest.raises(TypeError):
        keyed_join(spark.range(3), spark.range(3).selectExpr("cast(id as int) id"), ["id"], "left_semi")


@pytest.mark.parametrize("broadcast", [True, False])
def test_rows_without_match(spark, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    src = spark.createDataFrame([(4,), (2,), (None,), (900,)], "k long")
    assert rows_of(rows_without_match(src, skewed(spark), ["k"])) == [(900,), (None,)]


def test_rows_without_match_never_shuffles_the_big_side(spark):
    big = spark.range(50_000_000).select(F.col("id").alias("k"))
    src = spark.sql("select explode(array(1L, 50000001L)) as k")
    left = rows_without_match(src, big, ["k"])
    assert rows_of(left) == [(50000001,)]


def test_listed_join_falls_back(spark, monkeypatch, no_broadcast):
    from granary.operators import skew

    df = skewed(spark)
    wanted = spark.range(0, 400).select(F.col("id").alias("k"))
    expected = rows_of(df.join(wanted, "k", "left_semi").select("k", "s", "id"))
    assert rows_of(listed_join(df, wanted, ["k"], "left_semi").select("k", "s", "id")) == expected
    other = wanted.selectExpr("cast(k as int) k")
    with pytest.raises(TypeError):
        listed_join(df, other, ["k"], "left_semi")
    monkeypatch.setattr(skew, "LIST_ROWS", 10)
    with pytest.raises(TypeError):
        listed_join(df, other, ["k"], "left_semi")
    assert rows_of(listed_join(df, wanted, ["k"], "left_semi").select("k", "s", "id")) == expected


def test_a_short_list_is_broadcast_and_keeps_its_values(spark, no_broadcast):
    from granary.operators.skew import fetched, is_local

    schema = "a string, b decimal(9,2), c date, d timestamp, e timestamp_ntz, f double, g binary, h boolean"
    made = spark.sql(
        "SELECT 'x' a, 1.25BD b, date'2024-01-02' c, timestamp'1890-01-01 00:00:00.000001' d, timestamp_ntz'2024-03-31 02:30:00' e, "
        "1.5D f, x'00ff' g, true h UNION ALL SELECT null, null, null, null, null, double('nan'), null, null"
    )
    rows = spark.createDataFrame(made.collect(), schema)
    listed = fetched(rows, rows.columns)
    assert is_local(listed) and is_local(listed.where("h")) and str(rows_of(listed)) == str(rows_of(rows))
    assert rows_of(fetched(rows.where("false"), ["a", "d"])) == []
    found = listed_join(rows, rows, rows.columns, "left_semi")
    assert str(rows_of(found)) == str(rows_of(rows))
    assert listed_join(rows, rows, rows.columns, "left_anti").count() == 0
    # no row of the long side is shuffled, whichever key holds most of them
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def events(spark, n=4000, seed=3):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        user = None if rng.random() < 0.1 else (1 if rng.random() < 0.5 else rng.randrange(60))
        # many equal times
        at = start + timedelta(minutes=rng.randrange(900))
        rows.append((i, user, None if rng.random() < 0.02 else at, rng.choice("abc")))
    return spark.createDataFrame(rows, "id long, user long, at timestamp_ntz, kind string")


@pytest.mark.parametrize("parts", [1, 7, 150])
def test_next_in_order_split(spark, parts):
    df = events(spark)
    split = next_in_order(df, ["user"], ["at", "id"], ["at", "kind"], parts)
    window = Window.partitionBy("user").orderBy("at", "id")
    plain = df.select(
        "*",
        F.lead("at").over(window).alias("next_at"),
        F.lead("kind").over(window).alias("next_kind"),
    )
    assert rows_of(split) == rows_of(plain)


def test_run_durations_split_equals_plain(spark):
    df = events(spark).where("at is not null")
    plain = ledger.run_durations(df, ["user"], "at", "id", ["kind"], started="kind = 'a'")
    split = ledger.run_durations(df, ["user"], "at", "id", ["kind"], started="kind = 'a'", parts=40)
    assert rows_of(plain) == rows_of(split)


def test_one_key_of_one_time_is_spread(spark):
    df = spark.range(20_000).selectExpr("id", "7L user", "timestamp'2024-01-01' at", "cast(id % 3 as string) kind")
    sizes = [r["count"] for r in with_run(df, [F.col("user"), F.col("at"), F.col("id")], 50).groupBy("_run").count().collect()]
    assert len(sizes) == 50 and max(sizes) < 3 * 20_000 / 50
    got = next_in_order(df, ["user"], ["at", "id"], ["id"], 50)
    assert got.where("next_id = id + 1").count() == 19_999 and got.where("next_id is null").first().id == 19_999


def test_runs_follow_the_order(spark):
    df = events(spark)
    for parts in (9, 120):
        rows = with_run(df, [F.col("user"), F.col("at"), F.col("id")], parts).orderBy("user", "at", "id").collect()
        runs = [r["_run"] for r in rows]
        assert runs == sorted(runs) and len(set(runs)) > 0.8 * parts


def test_ranks_are_cut_before_the_shuffle(spark):
    df = events(spark)
    newest = ledger.latest_per_key(df, ["user"], "at", ["id"])
    expired = retention.expired_entries(
        df.select(F.col("user").alias("root"), F.col("id").alias("path"), F.col("at").alias("modified")), 8
    )
    timed = df.where("at is not null").selectExpr("user root", "id path", "at modified")
    many = retention.expired_entries(timed, 1500)
    plain = Window.partitionBy("root").orderBy(F.col("modified").desc(), "path")
    want = timed.withColumn("n", F.row_number().over(plain)).where("n > 1500")
    assert rows_of(many) == rows_of(want.drop("n")) != []
    for frame in (newest, expired):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "Partial" in plan
