import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from granary.sources import exchange, files, store


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def test_publish_can_read_itself_and_keeps_one_older_version(spark, root):
    store.publish(spark.range(3), root)
    first = store.current_path(spark, root)
    for _ in range(3):
        table = store.read_table(spark, root)
        store.publish(table.select((F.col("id") + 1).alias("id")), root)
    assert rows_of(store.read_table(spark, root)) == [(3,), (4,), (5,)]
    assert not files.exists(spark, first)
    assert [n for n in files.children(spark, root) if n.startswith("v")] == ["v00000003", "v00000004"]


def test_failed_write_leaves_the_table_as_it_was(spark, root):
    store.publish(spark.range(3), root)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        store.publish(bad, root)
    assert store.read_table(spark, root).count() == 3
    store.publish(spark.range(9), root)
    assert store.read_table(spark, root).count() == 9


def monthly(spark, root):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "01")], "id int, part string")
    store.publish(df, root, ["part"])
    return df.schema


def test_replace_leaves_other_partitions_untouched(spark, root, tmp_path):
    monthly(spark, root)
    before = {p.name for p in (tmp_path / "table").rglob("part=b/*.orc")}
    new = store.read_table(spark, root, "part = 'a'").where("id = 1")
    store.replace_partitions(new, root, ["part"])
    assert rows_of(store.read_table(spark, root)) == [(1, "a"), (3, "b"), (4, "01")]
    assert {p.name for p in (tmp_path / "table").rglob("part=b/*.orc")} == before


def test_replace_drops_emptied_partitions(spark, root):
    monthly(spark, root)
    none = store.read_table(spark, root).where("false")
    cleared = spark.createDataFrame([("a",), ("01",)], "part string")
    store.replace_partitions(none, root, ["part"], cleared)
    assert rows_of(store.read_table(spark, root)) == [(3, "b")]


def test_odd_partition_values(spark, root):
    df = spark.createDataFrame(
        [(1, "a b/c", "x:1"), (2, "+%", "é"), (3, None, "y")], "id int, p string, q string")
    store.publish(df, root, ["p", "q"])
    cleared = df.where("id <> 2").select("p", "q")
    store.replace_partitions(df.where("id = 2").withColumn("id", F.lit(5)), root, ["p", "q"], cleared)
    assert rows_of(store.read_table(spark, root)) == [(5, "+%", "é")]


def cut_short(monkeypatch, at):
    """Replacing partitions ends where ``at`` is called."""
    context = monkeypatch.context()
    patch = context.__enter__()

    def stop(*_, **__):
        raise OSError("cut short")

    patch.setattr(store, at, stop)
    return context


def test_cut_short_swap_is_finished_later(spark, root, monkeypatch):
    schema = monthly(spark, root)
    new = spark.createDataFrame([(9, "b")], schema)
    monkeypatch.setattr(store, "finish_swap", lambda *_: None)
    store.replace_partitions(new, root, ["part"], spark.createDataFrame([("01",)], "part string"))
    monkeypatch.undo()
    # it counts from the pointer on, before the version has it
    assert rows_of(store.read_table(spark, root)) == [(1, "a"), (2, "a"), (9, "b")]
    store.finish_swap(spark, root)
    store.finish_swap(spark, root)
    assert rows_of(store.read_table(spark, root)) == [(1, "a"), (2, "a"), (9, "b")]
    assert sorted(files.children(spark, root)) == ["CURRENT", "v00000001"]


def test_replacement_cut_before_the_pointer_changes_nothing(spark, root, monkeypatch):
    schema = monthly(spark, root)
    context = cut_short(monkeypatch, "set_pointer")
    with pytest.raises(OSError):
        store.replace_partitions(spark.createDataFrame([(9, "b")], schema), root, ["part"])
    context.__exit__(None, None, None)
    assert store.read_table(spark, root, "part = 'b'").first().id == 3
    store.replace_partitions(spark.createDataFrame([(8, "a")], schema), root, ["part"])
    assert rows_of(store.read_table(spark, root)) == [(3, "b"), (4, "01"), (8, "a")]
    assert sorted(files.children(spark, root)) == ["CURRENT", "v00000001"]


@pytest.mark.parametrize("lost", [False, True])
def test_append_after_a_cut_swap_loses_nothing(spark, root, tmp_path, monkeypatch, lost):
    """Also where the engine's overwrite was cut between removing a partition and putting the new one in place."""
    import shutil

    schema = monthly(spark, root)
    with monkeypatch.context() as patch:
        patch.setattr(store, "finish_swap", lambda *_: None)
        store.replace_partitions(spark.createDataFrame([(9, "a")], schema), root, ["part"])
    if lost:
        shutil.rmtree(tmp_path / "table" / "v00000001" / "part=a")
    store.append(spark.createDataFrame([(11, "a"), (12, "c")], schema), root, ["part"])
    store.replace_partitions(spark.createDataFrame([(5, "c")], schema), root, ["part"])
    assert rows_of(store.read_table(spark, root)) == [(11, "a"), (3, "b"), (4, "01"), (5, "c"), (9, "a")]


def test_predicate_and_columns_reach_the_scan(spark, root):
    monthly(spark, root)
    plan = store.read_table(spark, root, "part = 'a' and id > 1", ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,1)]" in text
    assert "part#" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<id:int>" in text


def test_load_external_modes(spark, root):
    exchange.load_external(spark.range(2), root, "insert")
    with pytest.raises(ValueError):
        exchange.load_external(spark.range(2), root, "insert")
    assert exchange.load_external(spark.range(3), root, "add").count() == 5
    assert exchange.load_external(spark.range(4), root, "all").count() == 4
    wider = spark.range(1).withColumn("note", F.lit("x"))
    got = exchange.load_external(wider, root, "add")
    assert got.where("note is null").count() == 4 and got.where("note = 'x'").count() == 1
    # the next reader gets the added column too
    assert store.read_table(spark, root).columns == ["id", "note"]
    with pytest.raises(ValueError):
        exchange.load_external(spark.range(1).withColumnRenamed("id", "other"), root, "add")


def test_delimited_round_trip(spark, tmp_path):
    from granary.sources.landing import read_landing

    df = spark.createDataFrame(
        [(1, 'say "hi"', "a#b&c"), (2, None, '"open'), (3, "tab\t", "é")], "id int, a string, b string")
    exchange.write_delimited(df, str(tmp_path / "t"))
    assert rows_of(read_landing(spark, str(tmp_path / "t"), df.schema)) == rows_of(df)
    exchange.write_delimited(df, str(tmp_path / "c"), compat=True)
    assert spark.read.text(str(tmp_path / "c")).where("value = '2#&\"open'").count() == 1


def test_split_text_bounds_every_piece(spark, tmp_path):
    lines = spark.range(20_000).select(
        F.concat(F.col("id"), F.repeat(F.lit("é"), (F.col("id") % 50).cast("int"))).alias("value"))
    lines.coalesce(2).write.text(str(tmp_path / "whole"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    exchange.split_text(spark, str(tmp_path / "whole"), str(tmp_path / "pieces"), 100_000)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert rows_of(spark.read.text(str(tmp_path / "pieces"))) == rows_of(lines)
    sizes = [p.stat().st_size for p in (tmp_path / "pieces").glob("*.txt")]
    assert max(sizes) <= 100_000 + 110 and len(sizes) <= 2 + sum(sizes) // 100_000


def test_split_text_reads_many_small_pieces_in_one_task(spark, tmp_path):
    import random

    draw = random.Random(4)
    made = [bytes(draw.choice(b"ab \xff\xc3\xa9\"") for _ in range(draw.choice((0, 3, 40, 900)))) for _ in range(3000)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes(b"\n".join(made))
    (tmp_path / "in" / "b.txt").write_bytes(b"\n\r\n\nx\n")
    exchange.split_text(spark, str(tmp_path / "in"), str(tmp_path / "out"), 2_000)
    files = sorted((tmp_path / "out").glob("part-*"))
    pieces = [p.read_bytes() for p in files]
    assert len({p.name[:10] for p in files}) == 1 and len(pieces) > 200
    assert b"".join(pieces) in (b"\n".join(made) + b"\n" + b"\n\n\nx\n", b"\n\n\nx\n" + b"\n".join(made) + b"\n")
    # each ends at the first line end past 2,000 bytes, but for the last of each file
    short = [p for p in pieces if len(p) < 2_000]
    assert len(short) <= 2 and all(len(p[: p[:-1].rfind(b"\n") + 1]) < 2_000 for p in pieces)


def test_split_records_keeps_quoted_line_ends(spark, tmp_path):
    df = spark.range(95).select("id", F.lit("two\nlines").alias("t"))
    exchange.split_records(df.coalesce(1), str(tmp_path / "r"), 10)
    assert len(list((tmp_path / "r").glob("*.csv"))) == 10
    back = spark.read.schema(df.schema).option("multiLine", "true").csv(str(tmp_path / "r"))
    assert rows_of(back) == rows_of(df)


def test_bundle_is_ready_only_at_the_end(spark, tmp_path):
    path = str(tmp_path / "b")
    with pytest.raises(ValueError):
        exchange.read_manifest(spark, path)
    rows = spark.createDataFrame([("t", "all", "replace", None, spark.range(1).schema.json(), 2, None)], exchange.MANIFEST_SCHEMA)
    exchange.write_bundle(spark.range(2), lambda written: rows, path)
    assert rows_of(exchange.read_bundle(spark, path)) == [(0,), (1,)]
    assert rows_of(exchange.import_create(spark, path, str(tmp_path / "new"))) == [(0,), (1,)]
    with pytest.raises(ValueError):
        exchange.import_create(spark, path, str(tmp_path / "new"))


def test_retain_partitions(spark, root):
    df = spark.createDataFrame([(i, f"2024010{i}") for i in range(1, 6)], "id int, day string")
    store.publish(df, root, ["day"])
    assert store.retain_partitions(spark, root, "day", 2) == [f"day=2024010{i}" for i in (1, 2, 3)]
    assert rows_of(store.read_table(spark, root)) == [(4, "20240104"), (5, "20240105")]
    assert store.retain_partitions(spark, root, "day", 2) == []


def test_drop_expired_directories(spark, tmp_path):
    import os

    from granary.plans.retain import drop_expired

    for zone in ("cur", "hist"):
        for i in range(1, 5):
            (tmp_path / zone / f"2024010{i}" / "S").mkdir(parents=True)
            os.utime(tmp_path / zone / f"2024010{i}", (1_700_000_000 + i * 86400,) * 2)
    dropped = drop_expired(spark, [str(tmp_path / "cur"), str(tmp_path / "hist")], 3)
    assert len(dropped) == 2
    assert sorted(p.name for p in (tmp_path / "cur").iterdir()) == ["20240102", "20240103", "20240104"]


def test_a_swap_cut_short_never_overwrites_a_later_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    frame = lambda *rows: spark.createDataFrame(list(rows), "v string, k string")
    store.publish(frame(("old", "a"), ("old", "b")), root, ["k"])
    with monkeypatch.context() as patch:
        patch.setattr(store, "finish_swap", lambda *_: None)
        store.replace_partitions(frame(("stale", "a")), root, ["k"])
    store.publish(frame(("new", "a"), ("new", "b")), root, ["k"])
    store.replace_partitions(frame(("newer", "b")), root, ["k"])
    assert rows_of(store.read_table(spark, root)) == [("new", "a"), ("newer", "b")]


def test_notes_stay_with_the_table(spark, root):
    schema = monthly(spark, root)
    store.publish(store.read_table(spark, root), root, ["part"], notes={"x": [1]})
    store.append(spark.createDataFrame([(5, "c")], schema), root, ["part"])
    store.replace_partitions(spark.createDataFrame([(6, "c")], schema), root, ["part"], notes={"y": 2})
    assert store.pointer(spark, root)["notes"] == {"x": [1], "y": 2}


def test_quoted_pieces_parse_alone(spark, tmp_path):
    import csv
    import random

    draw = random.Random(6)
    made = ["", "plain", 'say "hi"', "two\nlines", '\n\n"\n', '","\n"', "é\n" * 40]
    rows = [[f"{f}-{i}", draw.choice(made), draw.choice(made)] for f in range(2) for i in range(400)]
    (tmp_path / "in").mkdir()
    for f in range(2):
        with open(tmp_path / "in" / f"{f}.csv", "w", newline="") as out:
            csv.writer(out, lineterminator="\n").writerows(r for r in rows if r[0].startswith(f"{f}-"))
    exchange.split_quoted(spark, str(tmp_path / "in"), str(tmp_path / "out"), 500)
    pieces, got = list((tmp_path / "out").rglob("*.txt")), []
    for piece in pieces:
        with open(piece, newline="") as text:
            found = list(csv.reader(text))
        assert all(len(r) == 3 for r in found)
        numbers = [int(r[0].split("-")[1]) for r in found]
        assert numbers == list(range(numbers[0], numbers[0] + len(numbers)))
        got += found
    assert sorted(got) == sorted(rows) and len(pieces) > 40
    assert max(p.stat().st_size for p in pieces) < 500 + 2 * 200 + 500


def test_small_quoted_pieces_share_a_task(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("".join(f'{i},"x\n""{"y" * (i % 90)}\n"\n' for i in range(2000)))
    context, group = spark.sparkContext, str(tmp_path)
    context.setJobGroup(group, "split")
    try:
        exchange.split_quoted(spark, str(tmp_path / "in"), str(tmp_path / "out"), 500)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) <= 16
    pieces = [p.read_text() for p in sorted((tmp_path / "out").rglob("*.txt"))]
    assert len(pieces) > 150 and "".join(pieces) == (tmp_path / "in" / "a.csv").read_text()
    assert all(p.count('"') % 2 == 0 and len(p) < 500 + 2 * 100 for p in pieces)
