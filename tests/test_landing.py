import pytest

from conftest import rows_of
from granary.sources import files, landing


def deliver(root, day, system, name, **kinds):
    folder = root / day / system
    folder.mkdir(parents=True, exist_ok=True)
    for kind, text in kinds.items():
        (folder / f"{name}.{kind}").write_bytes(text if isinstance(text, bytes) else text.encode())


@pytest.fixture
def zone(tmp_path):
    cur, hist = tmp_path / "cur", tmp_path / "hist"
    deliver(cur, "20240101", "CRM", "full", txt="1#&a\n", SQL="create table full (\nid number,\nv varchar2(5)\n);", END="1\n")
    deliver(cur, "20240101", "CRM", "nosql", txt="", END=" \n")
    deliver(cur, "20240101", "CRM", "notxt", SQL="x", END="12")
    deliver(cur, "20240101", "ERP", "waiting", txt="", SQL="")
    deliver(cur, "20240101", "ERP", "again", txt="1#&b\n")
    deliver(hist, "20240101", "ERP/again", "again", END="7")
    return str(cur), str(hist)


def test_manifest_and_counts(spark, zone):
    cur, hist = zone
    got = landing.landing_manifest(files.list_files(spark, cur), files.list_files(spark, hist))
    assert {(r.system_id, r.name): r.status for r in got.collect()} == {
        ("CRM", "full"): "ready", ("CRM", "nosql"): "no_sql", ("CRM", "notxt"): "no_txt",
        ("ERP", "waiting"): "no_end", ("ERP", "again"): "ready_history",
    }
    counts = landing.read_expected_counts(spark, cur)
    assert rows_of(counts.select("name", "expected")) == [("full", 1), ("nosql", -1), ("notxt", 12)]


def test_listing_reads_no_contents(spark, zone):
    plan = files.list_files(spark, zone[0])._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_archive_moves_ready_deliveries(spark, zone):
    cur, hist = zone
    ready = landing.landing_manifest(files.list_files(spark, cur), files.list_files(spark, hist))
    assert landing.archive_landing(spark, ready, cur, hist) == 1
    paths = landing.history_paths(hist, "20240101", "CRM", "full")
    assert all(files.exists(spark, p) for p in paths.values())
    assert not files.exists(spark, f"{cur}/20240101/CRM/full.END")
    again = landing.landing_manifest(files.list_files(spark, cur), files.list_files(spark, hist))
    assert again.where("name = 'full'").first().status == "ready_history"
    assert landing.archive_landing(spark, again, cur, hist) == 0


def test_odd_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text('1#&x#&2.5\n2#&"q#&\n3#&short\n#&#&\nx#&y#&1\n')
    df = landing.read_landing(
        spark, str(tmp_path / "a.txt"),
        spark.createDataFrame([], "a int, b string, c double").schema, corrupt=True)
    got = {r._corrupt_record or r.a: (r.a, r.b, r.c) for r in df.collect()}
    assert got[1] == (1, "x", 2.5) and got[2] == (2, '"q', None)
    assert got["3#&short"] == (3, "short", None)
    assert got[None] == (None, None, None)
    assert got["x#&y#&1"] == (None, "y", 1.0)


def test_empty_delivery(spark, tmp_path):
    (tmp_path / "e.txt").write_text("")
    assert landing.read_landing(spark, str(tmp_path / "e.txt"), spark.range(1).schema).count() == 0


def test_transcode(spark, tmp_path):
    text = "Größe naïve\nzweite Zeile\n"
    (tmp_path / "l1.txt").write_bytes(text.encode("latin-1"))
    landing.transcode_text(spark, str(tmp_path / "l1.txt"), str(tmp_path / "u8"), "ISO-8859-1")
    assert b"".join(p.read_bytes() for p in (tmp_path / "u8").glob("*.txt")) == text.encode()
    landing.transcode_text(spark, str(tmp_path / "u8"), str(tmp_path / "back"), "UTF-8", "ISO-8859-1")
    assert b"".join(p.read_bytes() for p in (tmp_path / "back").glob("*.txt")) == text.encode("latin-1")


def test_transcode_other_charset(spark, tmp_path):
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        (tmp_path / "g.txt").write_bytes("中文 abc\n".encode("gbk"))
        landing.transcode_text(spark, str(tmp_path / "g.txt"), str(tmp_path / "out"), "GBK")
        assert spark.read.text(str(tmp_path / "out")).first().value == "中文 abc"
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "d" / "m")
    files.write_small(spark, path, "eins")
    files.write_small(spark, path, "zwei é")
    assert files.read_small(spark, path) == "zwei é"
    assert files.children(spark, str(tmp_path / "d")) == ["m"]


def test_empty_files_are_listed_and_count_as_blank(spark, tmp_path):
    deliver(tmp_path, "20240101", "S", "a b+c", txt="", SQL="x", END="")
    listing = files.list_files(spark, str(tmp_path))
    assert sorted((r.path.rsplit("/", 1)[1], r.length) for r in listing.collect()) == [
        ("a b+c.END", 0), ("a b+c.SQL", 1), ("a b+c.txt", 0)]
    assert listing.where("modified is null").count() == 0
    assert landing.landing_manifest(listing).first().status == "ready"
    deliver(tmp_path, "20240101", "S", "d", END="4")
    counts = landing.read_expected_counts(spark, str(tmp_path))
    assert rows_of(counts.select("name", "expected")) == [("a b+c", -1), ("d", 4)]


def test_archive_as_data_is_whole_and_repeatable(spark, tmp_path):
    cur, hist = str(tmp_path / "cur"), str(tmp_path / "hist")
    deliver(tmp_path / "cur", "20240101", "CRM", "a", txt="1\n2\n2\n", SQL="ddl a", END="3")
    deliver(tmp_path / "cur", "20240101", "CRM", "none", txt="", SQL="ddl", END="0")
    deliver(tmp_path / "cur", "20240102", "ERP", "part", txt="9\n", SQL="ddl")
    ready = landing.landing_manifest(files.list_files(spark, cur))
    for _ in range(2):
        landing.archive_deliveries(spark, ready, cur, hist)
    assert rows_of(landing.archived_lines(spark, hist).select("name", "value")) == [("a", "1"), ("a", "2"), ("a", "2")]
    receipts = {r.name: r for r in landing.archive_receipts(spark, hist).collect()}
    assert {n: (r.expected, r.lines, r.declaration) for n, r in receipts.items()} == {"a": (3, 3, "ddl a"), "none": (0, 0, "ddl")}
    again = spark.createDataFrame([("2",), ("1",), ("2",)], "value string").repartition(3)
    assert again.agg(landing.content_digest("value")).first().digest == receipts["a"].digest
    # a day delivered later leaves the others
    deliver(tmp_path / "cur", "20240102", "ERP", "part", END="1")
    later = landing.landing_manifest(files.list_files(spark, cur)).where("name = 'part'")
    landing.archive_deliveries(spark, later, cur, hist)
    assert landing.archive_receipts(spark, hist).count() == 3 and landing.archived_lines(spark, hist).count() == 4


def test_parts_of_a_moved_tree_grow_in_number_not_in_size(spark):
    from pathlib import Path

    from granary.plans.queries import QUERIES

    sizes = [f"spark.sql.adaptive.{x}" for x in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize")]
    before, root = [spark.conf.get(x) for x in sizes], Path(spark.conf.get("spark.checkpoint.dir")) / "granary"
    there = set(root.glob("trees-*"))
    for size in sizes:
        spark.conf.set(size, "1k")
    try:
        found = {r.source: r.status for r in QUERIES["verify_content"](spark, "/root/testdata/sf0.001").collect()}
    finally:
        for size, value in zip(sizes, before, strict=True):
            spark.conf.set(size, value)
    assert (found["src0"], found["src1"], found["src2"], found["src3"]) == ("missing", "content_differs", "ok", "extra")
    (tree,) = set(root.glob("trees-*")) - there
    assert len({p.name[:10] for p in (tree / "received").rglob("part-*")}) > 5
