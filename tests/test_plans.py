"""Whole deliveries and exchanges, on small files."""

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from granary.operators import schema
from granary.plans import daily, transfer
from granary.sources import exchange, files, landing, store
from test_landing import deliver

DDL = "create table sales.t\n(\n  k number(10),\n  day varchar2(8),\n  v varchar2(20),\n  primary key (k)\n);\n"


class Zone:
    def __init__(self, spark, base):
        self.spark, self.base, self.root = spark, base, str(base / "table")

    def load(self, etl_date, lines, registry=None, ddl=DDL, count=None, **job):
        deliver(self.base / "cur", etl_date, "S", "t", txt="".join(f"{x}\n" for x in lines), SQL=ddl,
                END=str(len(lines) if count is None else count))
        ready = landing.landing_manifest(files.list_files(self.spark, str(self.base / "cur")))
        hist = str(self.base / "hist")
        landing.archive_landing(self.spark, ready, str(self.base / "cur"), hist)
        config = daily.LoadJob("sales.t", "S", "t", **job)
        return daily.run_load(self.spark, config, hist, etl_date, self.root, registry)

    def rows(self, *columns):
        return rows_of(store.read_table(self.spark, self.root).select(*(columns or ("k", "v", "etl_date"))))


@pytest.fixture
def zone(spark, tmp_path):
    return Zone(spark, tmp_path)


def registry(spark, ddl=DDL):
    text = spark.createDataFrame([(ddl,)], "value string")
    return schema.extract_schema(text).withColumn("table_name", F.lit("sales.t"))


def test_full(zone):
    assert zone.load("20240101", ["1#&d#&a", "2#&d#&b"], load_type="full").status == "success"
    assert zone.load("20240102", ["3#&d#&c"], load_type="full").loaded == 1
    assert zone.rows() == [(3, "c", "20240102")]


def test_wrong_count_is_an_error_except_for_merge(zone):
    assert zone.load("20240101", ["1#&d#&a"], count=5, load_type="full").status == "error"
    got = zone.load("20240102", ["1#&d#&b"], count=" ", load_type="merge", keys=["k"])
    assert (got.status, got.expected, got.loaded) == ("success", -1, 1)
    assert any("declared -1" in w for w in got.warnings)


def test_merge_and_update(zone):
    zone.load("20240101", ["1#&d#&a", "2#&d#&b"], load_type="merge", keys=["k"])
    got = zone.load("20240102", ["2#&d#&B", "3#&d#&c"], load_type="merge", keys=["k"])
    assert got.warnings == ()
    assert zone.rows() == [(1, "a", "20240101"), (2, "B", "20240102"), (3, "c", "20240102")]
    zone.load("20240101", ["2#&d#&late", "4#&d#&d"], load_type="merge", keys=["k"])
    assert (2, "B", "20240102") in zone.rows() and (4, "d", "20240101") in zone.rows()
    zone.load("20240103", ["2#&d#&U"], load_type="update", keys=["k"])
    assert (2, "U", "20240103") in zone.rows() and len(zone.rows()) == 4
    with pytest.raises(ValueError):
        zone.load("20240104", ["1#&d#&a", "1#&d#&b"], load_type="merge", keys=["k"])
    assert zone.load("20240104", ["1#&d#&a"], load_type="update", keys=["v"]).warnings


def test_appended_column(zone, spark):
    zone.load("20240101", ["1#&d#&a"], load_type="update", keys=["k"], registry=registry(spark, "create table x (\n)"))
    wider = DDL.replace("  primary", "  extra number(5,1),\n  primary")
    got = zone.load("20240102", ["2#&d#&b#&1.5"], ddl=wider, registry=registry(spark), load_type="update", keys=["k"])
    assert got.warnings == ("columns added: extra",)
    assert [(k, None if e is None else float(e)) for k, e in zone.rows("k", "extra")] == [(1, None), (2, 1.5)]
    with pytest.raises(ValueError, match="lost"):
        zone.load("20240103", ["1#&d#&a"], registry=registry(spark, wider), load_type="full")
    with pytest.raises(ValueError, match="column 1"):
        zone.load("20240103", ["1#&d#&a"], ddl=DDL.replace("day", "date_"), registry=registry(spark), load_type="full")


def test_target_without_registration_is_refused(zone, spark):
    zone.load("20240101", ["1#&d#&a"], load_type="full")
    with pytest.raises(ValueError, match="not registered"):
        zone.load("20240102", ["1#&d#&a"], load_type="full", registry=registry(spark, "create table x (\n)"))


def test_add_without_day_replaces_the_load_day(zone):
    for day in ("20240101", "20240102", "20240102"):
        zone.load(day, [f"1#&d#&{day}"], load_type="add")
    assert zone.rows() == [(1, "20240101", "20240101"), (1, "20240102", "20240102")]


def test_add_by_day(zone, spark):
    first = [f"{i}#&202401{i % 28 + 1:02d}#&x" for i in range(200)]
    got = zone.load("20240128", first, load_type="add", day="day")
    assert (got.status, got.loaded) == ("success", 200)
    again = [line for line in first if "20240128" in line]
    assert zone.load("20240128", again, load_type="add", day="day").status == "success"
    assert len(zone.rows()) == 200
    # a later day opens or joins a later partition; loading it twice changes nothing
    for _ in range(2):
        got = zone.load("20240305", ["900#&20240305#&y", "901#&20240305#&y"], load_type="add", day="day")
        assert (got.status, got.loaded) == ("success", 2)
    assert len(zone.rows()) == 202
    # a day delivered without rows is emptied
    zone.load("20240305", [], load_type="add", day="day")
    assert len(zone.rows()) == 200
    table = store.read_table(spark, zone.root)
    assert table.where("etl_date <> day").count() == 0


def test_add_by_day_late(zone):
    zone.load("20240103", ["1#&20240101#&x", "2#&20240102#&x", "3#&20240103#&x"], load_type="add", day="day")
    zone.load("20240103", ["9#&20240102#&z"], load_type="add", day="day", def_etl_date="T-2")
    assert zone.rows("k", "day") == [(1, "20240101"), (3, "20240103"), (9, "20240102")]


def test_logged_runs(zone, spark, tmp_path):
    log = str(tmp_path / "log")
    job = daily.LoadJob("sales.t", "S", "t", "full")
    hist = str(tmp_path / "hist")
    deliver(tmp_path / "hist", "20240101", "S/t", "t", SQL=DDL, END="1")
    (tmp_path / "hist/20240101/S/t/data").mkdir()
    (tmp_path / "hist/20240101/S/t/data/t.txt").write_text("1#&d#&a\n")
    assert daily.run_logged(spark, job, hist, "20240101", zone.root, log, "b1").status == "success"
    with pytest.raises(Exception):
        daily.run_logged(spark, job, hist, "20240102", zone.root, log, "b1", second_try=True)
    rows = store.read_table(spark, log)
    assert rows_of(rows.select("etl_date", "task_status", "tar_count")) == [
        ("20240101", "running", 0), ("20240101", "success", 1),
        ("20240102", "error1", 0), ("20240102", "running", 0)]
    assert daily.open_runs(rows, "sales.t", "20240101").isEmpty()
    open_run = rows.where("etl_date = '20240101' and task_status = 'running'").withColumn("id", F.lit("other"))
    store.append(open_run, log)
    assert daily.run_logged(spark, job, hist, "20240101", zone.root, log, "b2") is None


def test_comments_become_metadata(zone, spark):
    ddl = DDL + "comment on column sales.t.v is 'the value';\n"
    zone.load("20240101", ["1#&d#&a"], load_type="full", ddl=ddl)
    assert store.read_table(spark, zone.root).schema["v"].metadata == {"comment": "the value"}


def test_day_partitioned_target_in_other_modes(zone, spark):
    zone.load("20240102", [], load_type="add", day="day")  # empty first delivery
    zone.load("20240103", ["1#&20240102#&a", "2#&20240103#&b"], load_type="add", day="day")
    with pytest.raises(ValueError, match="partitioned"):
        zone.load("20240104", ["1#&20240102#&c"], load_type="merge", keys=["k"])
    zone.load("20240104", ["1#&20240104#&moved", "3#&20240104#&new"], load_type="update", keys=["k"], day="day")
    assert zone.rows() == [(1, "moved", "20240104"), (2, "b", "20240103"), (3, "new", "20240104")]
    wider = DDL.replace("  primary", "  extra number(5,1),\n  primary")
    zone.load("20240105", ["5#&20240105#&w#&1.5"], ddl=wider, load_type="add", day="day")
    assert [(k, x is None) for k, x in zone.rows("k", "extra")] == [(1, True), (2, True), (3, True), (5, False)]
    zone.load("20240106", ["9#&20240106#&all#&1"], ddl=wider, load_type="full", day="day")
    assert zone.rows() == [(9, "all", "20240106")]
    assert daily.PARTITION in store.read_table(spark, zone.root).columns


def test_add_to_a_target_without_days_is_refused(zone):
    zone.load("20240101", ["1#&d#&a"], load_type="full")
    with pytest.raises(ValueError, match="not partitioned by day"):
        zone.load("20240102", ["1#&d#&a"], load_type="add")


@pytest.fixture
def sales(spark, tmp_path):
    root = str(tmp_path / "src")
    df = spark.createDataFrame(
        [(1, "a", "m1"), (2, "b", "m1"), (3, "c", "m2"), (4, None, "m3")], "k int, v string, month string")
    store.publish(df, root, ["month"])
    return root, str(tmp_path / "dst"), str(tmp_path / "bundle")


TODAY, LATER = "20200101", "29990101"


def test_exchange_whole_table(spark, sales):
    src, dst, bundle = sales
    transfer.export_table(spark, src, bundle, "s.t", "all", LATER, ["month"])
    for _ in range(2):
        transfer.import_table(spark, bundle, dst, ["month"])
        assert rows_of(store.read_table(spark, dst)) == rows_of(store.read_table(spark, src))


def test_exchange_changed_partitions(spark, sales):
    src, dst, bundle = sales
    store.publish(spark.createDataFrame([(9, "old", "m1"), (8, "kept", "m9")], "k int, v string, month string"), dst, ["month"])
    transfer.export_table(spark, src, bundle, "s.t", "auto", TODAY, ["month"])
    transfer.import_table(spark, bundle, dst, ["month"])
    assert rows_of(store.read_table(spark, dst)) == [
        (1, "a", "m1"), (2, "b", "m1"), (3, "c", "m2"), (4, None, "m3"), (8, "kept", "m9")]
    # nothing changed since a far day: nothing is carried
    transfer.export_table(spark, src, bundle, "s.t", "auto", LATER, ["month"])
    assert exchange.read_manifest(spark, bundle).count() == 0
    transfer.import_table(spark, bundle, dst, ["month"])
    assert store.read_table(spark, dst).count() == 5


def test_exchange_by_predicate(spark, sales):
    src, dst, bundle = sales
    tgt = spark.createDataFrame([(1, "x", "m1"), (7, "y", "m2"), (5, None, "m1")], "k int, v string, month string")
    store.publish(tgt, dst, ["month"])
    transfer.export_table(spark, src, bundle, "s.t", "sql", "m2", ["month"], "month <= '${etl_date}' and v is not null")
    for _ in range(2):
        transfer.import_table(spark, bundle, dst, ["month"])
        assert rows_of(store.read_table(spark, dst)) == [
            (1, "a", "m1"), (2, "b", "m1"), (3, "c", "m2"), (5, None, "m1")]


def test_exchange_unpartitioned_with_removed_and_added_columns(spark, tmp_path):
    src, dst, bundle = (str(tmp_path / n) for n in ("s", "d", "b"))
    store.publish(spark.createDataFrame([(1, "a", "x", 2.0)], "k int, secret string, v string, extra double"), src)
    store.publish(spark.createDataFrame([(1, "old")], "k int, v string"), dst)
    transfer.export_table(spark, src, bundle, "s.t", "all", TODAY)
    transfer.import_table(spark, bundle, dst, remove=["secret"])
    assert rows_of(store.read_table(spark, dst)) == [(1, "x", 2.0)]
    assert store.read_table(spark, dst).columns == ["k", "v", "extra"]


def test_emptied_table_is_truncated_on_the_far_side(spark, tmp_path):
    src, dst, bundle = (str(tmp_path / n) for n in ("s", "d", "b"))
    store.publish(spark.range(0), src)
    store.publish(spark.range(5), dst)
    transfer.export_table(spark, src, bundle, "s.t", "auto", TODAY)
    transfer.import_table(spark, bundle, dst)
    assert store.read_table(spark, dst).count() == 0


@pytest.mark.parametrize("mode", ["auto", "all"])
def test_dropped_partitions_vanish_on_the_far_side(spark, sales, mode):
    """Also the last one: a wholly emptied table empties the far side."""
    src, dst, bundle = sales

    def exchange_once():
        transfer.export_table(spark, src, bundle, "s.t", mode, TODAY, ["month"])
        transfer.import_table(spark, bundle, dst, ["month"])
        return rows_of(store.read_table(spark, dst))

    assert exchange_once() == rows_of(store.read_table(spark, src))
    none = store.read_table(spark, src).where("false")
    store.replace_partitions(none, src, ["month"], spark.createDataFrame([("m1",)], "month string"))
    assert exchange_once() == rows_of(store.read_table(spark, src)) != []
    plan = exchange.read_manifest(spark, bundle).select("partition_name", "action")
    assert ("month=m1", "truncate") in rows_of(plan)
    store.publish(none, src, ["month"])
    assert exchange_once() == []


def test_an_export_cut_short_is_repeated_against_the_old_inventory(spark, sales, monkeypatch):
    src, dst, bundle = sales
    transfer.export_table(spark, src, bundle, "s.t", "auto", TODAY, ["month"])
    transfer.import_table(spark, bundle, dst, ["month"])
    none = store.read_table(spark, src).where("false")
    store.replace_partitions(none, src, ["month"], spark.createDataFrame([("m2",)], "month string"))
    with monkeypatch.context() as patch:
        patch.setattr(files, "write_small", lambda *_: (_ for _ in ()).throw(OSError("cut short")))
        with pytest.raises(OSError):
            transfer.export_table(spark, src, bundle, "s.t", "auto", TODAY, ["month"])
    transfer.export_table(spark, src, bundle, "s.t", "auto", TODAY, ["month"])
    transfer.import_table(spark, bundle, dst, ["month"])
    assert rows_of(store.read_table(spark, dst)) == rows_of(store.read_table(spark, src))


def test_exchange_of_odd_partition_values(spark, tmp_path):
    src, dst, bundle = (str(tmp_path / n) for n in ("src", "dst", "bundle"))
    values = ["a", None, "x:y", "p q", "k/l", "b", "1%2", "c=d", "+", "%41"]
    rows = [(i, k, i % 3 if i % 3 else None) for i, k in enumerate(values * 3)]
    frame = spark.createDataFrame(rows, "n int, k string, m int")
    for mode in ("all", "auto"):
        store.publish(frame, src, ["k", "m"])
        store.publish(frame.where("k = 'b' or k is null").withColumn("n", F.lit(-1)), dst, ["k", "m"])
        transfer.export_table(spark, src, bundle, "s.t", mode, TODAY, ["k", "m"])
        assert exchange.read_manifest(spark, bundle).agg({"row_count": "sum"}).first()[0] == len(rows)
        for _ in range(2):
            transfer.import_table(spark, bundle, dst, ["k", "m"])
            assert rows_of(store.read_table(spark, dst)) == sorted(rows, key=repr)


def test_a_wrong_count_leaves_the_old_state(zone):
    zone.load("20240101", ["1#&d#&a"], load_type="full")
    got = zone.load("20240102", ["2#&d#&b"], count=7, load_type="full")
    assert (got.status, got.loaded) == ("error", 1) and zone.rows() == [(1, "a", "20240101")]


def test_bad_values_and_odd_lines_are_counted(zone):
    ddl = DDL.replace("v varchar2(20)", "v number(5)")
    got = zone.load("20240101", ["1#&d#&7", "2#&d#&b", "3#&d#&8#&more", "4"], ddl=ddl, load_type="full")
    assert got.status == "success"
    assert got.warnings == ("1 rows hold values that do not fit their type", "2 lines have another number of fields")
    assert [(kind, level) for kind, level, _ in got.issues] == [("bad_values", "warning"), ("odd_lines", "warning")]


def test_a_bad_key_leaves_the_old_state(zone):
    zone.load("20240101", ["1#&d#&a"], load_type="full")
    got = zone.load("20240102", ["abc#&d#&b"], load_type="full")
    assert got.status == "error" and ("bad_keys", "error") in [(k, level) for k, level, _ in got.issues]
    assert zone.rows() == [(1, "a", "20240101")]


def test_warnings_are_stored(zone, spark, tmp_path):
    zone.load("20240101", ["1#&d#&a"], load_type="merge", keys=["k"])
    job = daily.LoadJob("sales.t", "S", "t", "merge", keys=["v"])
    log, warned = str(tmp_path / "log"), str(tmp_path / "warned")
    daily.run_logged(spark, job, str(zone.base / "hist"), "20240101", zone.root, log, "b1", warn_root=warned)
    row = store.read_table(spark, warned).first()
    assert (row.warn_type, row.warn_level, row.table_name) == ("other_key", "warning", "sales.t")


def test_a_first_add_cut_short_leaves_nothing(zone, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(store, "set_pointer", lambda *_, **__: (_ for _ in ()).throw(OSError("cut short")))
        with pytest.raises(OSError):
            zone.load("20240101", ["1#&d#&a"], load_type="add")
    zone.load("20240101", ["1#&d#&a"], load_type="add")
    zone.load("20240105", ["2#&d#&b"], load_type="add")
    assert zone.rows() == [(1, "a", "20240101"), (2, "b", "20240105")]


def test_stale_rows_of_a_merge_warn(zone):
    zone.load("20240105", ["1#&d#&a", "2#&d#&b"], load_type="merge", keys=["k"])
    got = zone.load("20240102", ["1#&d#&late", "3#&d#&c"], load_type="merge", keys=["k"])
    assert (got.loaded, got.warnings) == (1, ("declared 2 rows, loaded 1",))


def test_registry_grows_with_accepted_loads(zone, spark):
    known = registry(spark).where("false")
    got = zone.load("20240101", ["1#&d#&a"], registry=known, load_type="full")
    known = daily.register(known, "sales.t", got.columns)
    assert zone.load("20240102", ["1#&d#&a"], registry=known, load_type="full").warnings == ()
    wider = DDL.replace("v varchar2(20),", "v varchar2(20),\n  w varchar2(5),")
    got = zone.load("20240103", ["1#&d#&a#&w"], registry=known, ddl=wider, load_type="full")
    assert got.warnings == ("columns added: w",)
    known = daily.register(known, "sales.t", got.columns)
    assert zone.load("20240104", ["1#&d#&a#&w"], registry=known, ddl=wider, load_type="full").warnings == ()


def test_an_old_day_is_loaded_under_its_own_schema(zone, spark, tmp_path):
    """The load keeps the registry itself, valid from the day of the delivery."""
    kept = str(tmp_path / "registry")
    wider = DDL.replace("v varchar2(20),", "v varchar2(20),\n  w varchar2(5),")
    hist = str(zone.base / "hist")

    first = daily.LoadJob("sales.t", "S", "t", "update", keys=["k"])
    deliver(zone.base / "hist" / "20240101" / "S" / "t", "", "", "t", SQL=DDL, END="1")
    deliver(zone.base / "hist" / "20240101" / "S" / "t", "data", "", "t", txt="1#&d#&a\n")
    deliver(zone.base / "hist" / "20240105" / "S" / "t", "", "", "t", SQL=wider, END="1")
    deliver(zone.base / "hist" / "20240105" / "S" / "t", "data", "", "t", txt="2#&d#&b#&w\n")
    for day in ("20240101", "20240105"):
        assert daily.run_load(spark, first, hist, day, zone.root, registry_root=kept).status == "success"
    rows = rows_of(store.read_table(spark, kept).select("pos", "column_name", "date_change"))
    assert [(p, d) for p, _, d in rows] == [(0, "20240101"), (1, "20240101"), (2, "20240101"), (3, "20240105")]
    # the old day again: its three columns are whole, and the later column stays
    got = daily.run_load(spark, first, hist, "20240101", zone.root, registry_root=kept)
    assert got.status == "success" and got.warnings == ()
    assert rows_of(store.read_table(spark, zone.root).select("k", "v", "w")) == [(1, "a", None), (2, "b", "w")]
    assert store.read_table(spark, kept).count() == 4
    with pytest.raises(ValueError, match="lost columns"):
        deliver(zone.base / "hist" / "20240106" / "S" / "t", "", "", "t", SQL=DDL, END="1")
        deliver(zone.base / "hist" / "20240106" / "S" / "t", "data", "", "t", txt="3#&d#&c\n")
        daily.run_load(spark, first, hist, "20240106", zone.root, registry_root=kept)


def test_a_declaration_without_columns_fails(zone):
    with pytest.raises(ValueError, match="names no column"):
        zone.load("20240101", ["1"], ddl="create table t (k number);", load_type="full")
