"""The operators on the driver tables, each beside the SQL an independent engine runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import day_of, join_fields
from granary.operators import exchange, layout, ledger, loads, retention, schema
from granary.operators.skew import join_on
from granary.plans import transfer
from granary.sources import exchange as bundles
from granary.sources import files, landing, store
from granary.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name with the SQL it must agree with."""

    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        ORACLE[fn.__name__] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their day."""
    return table(spark, sf_dir, "orders").withColumn("etl_date", day_of("o_orderdate"))


# --------------------------------------------------------------------------- sources and sinks


@query("SELECT * FROM orders")
def read_landing(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = files.shared_dir(spark, "landing")
    bundles.write_delimited(orders, path)
    return landing.read_landing(spark, path, orders.schema)


LANDING_SQL = """
WITH files AS (
  SELECT strftime(o_orderdate, '%Y%m%d') AS etl_date, 'SYS_' || o_orderstatus AS system_id,
         'ord' || o_orderkey AS name,
         o_orderpriority <> '1-URGENT' AS has_end,
         o_orderpriority <> '2-HIGH' AS has_sql,
         o_orderpriority <> '3-MEDIUM' AS has_txt,
         o_totalprice > 250000 AS in_history
  FROM orders)
SELECT *, CASE WHEN NOT has_end AND in_history THEN 'ready_history'
               WHEN NOT has_end THEN 'no_end'
               WHEN NOT has_sql THEN 'no_sql'
               WHEN NOT has_txt THEN 'no_txt'
               ELSE 'ready' END AS status
FROM files
"""


@query(LANDING_SQL)
def landing_manifest(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "base", F.concat_ws("/", day_of("o_orderdate"), F.concat(F.lit("SYS_"), "o_orderstatus"))
    )
    name = F.concat(F.lit("ord"), "o_orderkey")
    kinds = F.array_compact(
        F.array(
            F.when(F.col("o_orderpriority") != "1-URGENT", "END"),
            F.when(F.col("o_orderpriority") != "2-HIGH", "SQL"),
            F.when(F.col("o_orderpriority") != "3-MEDIUM", "txt"),
        )
    )
    current = orders.select("base", name.alias("name"), F.explode(kinds).alias("kind")).select(
        F.concat(F.lit("/in/"), "base", F.lit("/"), "name", F.lit("."), "kind").alias("path")
    )
    history = orders.where("o_totalprice > 250000").select(
        F.concat(F.lit("/hist/"), "base", F.lit("/"), name, F.lit("/"), name, F.lit(".END")).alias(
            "path"
        )
    )
    return landing.landing_manifest(current, history)


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN -1 WHEN 'F' THEN CAST(o_custkey AS INTEGER)
                   ELSE CAST(o_custkey AS INTEGER) * 10 END AS expected
FROM orders
""")
def expected_counts(spark, sf_dir):
    text = (
        F.when(F.col("o_orderstatus") == "P", F.lit(" \n"))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("  "), "o_custkey", F.lit("\r\n")))
        .otherwise(F.concat("o_custkey", F.lit("\n0")))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", landing.expected_count(text).alias("expected")
    )


@query("""
SELECT o_orderkey, o_totalprice, year(o_orderdate)::INTEGER AS order_year FROM orders
WHERE year(o_orderdate) >= 1998 AND o_totalprice > 100000
""")
def read_table(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    root = files.shared_dir(spark, "table")
    store.publish(orders, root, ["order_year"])
    return store.read_table(
        spark,
        root,
        "order_year >= 1998 and o_totalprice > 100000",
        ["o_orderkey", "o_totalprice", "order_year"],
    )


@query("SELECT * FROM events")
def stream_landing(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    work = files.shared_dir(spark, "stream")
    bundles.write_delimited(events, f"{work}/in")
    stream = arrivals.stream_landing(spark, f"{work}/in", events.schema)
    arrivals.run_available(stream, f"{work}/checkpoint", arrivals.append_once(f"{work}/out"))
    return spark.read.orc(f"{work}/out").drop(arrivals.BATCH)


def order_years(spark, sf_dir, path):
    """Orders of every year as one text file each, not yet delivered, and their counts by year."""
    orders = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    lines = orders.select(join_fields(orders.drop("y"), landing.SEPARATOR).alias("value"), "y")
    lines.repartition("y").write.partitionBy("y").text(f"{path}/aside")
    return {row.y: row["count"] for row in orders.groupBy("y").count().collect()}


def deliver(spark, path, year, **kinds):
    """Put files of a year's delivery in place: a text for END and SQL, its lines for txt."""
    base = f"{path}/in/{year}1231/CRM/ord{year}"
    for kind, text in kinds.items():
        if kind == "txt":
            (part,) = [n for n in files.children(spark, f"{path}/aside/y={year}") if n.startswith("part-")]
            files.move(spark, f"{path}/aside/y={year}/{part}", f"{base}.txt")
        else:
            files.write_small(spark, f"{base}.{kind}", text)


DELIVERED_SQL = """
WITH counted AS (SELECT *, year(o_orderdate) AS y, count(*) OVER (PARTITION BY year(o_orderdate)) AS n FROM orders)
"""


@query(DELIVERED_SQL + """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       y || '1231' AS etl_date, 'CRM' AS system_id, 'ord' || y AS name,
       CASE WHEN y % 7 IN (2, 5) THEN -1 ELSE n END::INTEGER AS expected
FROM counted WHERE y % 7 NOT IN (3, 6)
""")
def stream_deliveries(spark, sf_dir):
    """Whole, late, partial, repeated and blank deliveries over three runs; each whole one is loaded once."""
    schema = table(spark, sf_dir, "orders").schema
    path = files.shared_dir(spark, "deliveries")
    counts = order_years(spark, sf_dir, path)
    files.write_small(spark, f"{path}/in/README", "landing")
    files.write_small(spark, f"{path}/notes/README", "")
    first = {0: ("txt", "SQL", "END"), 1: ("txt", "SQL"), 2: ("txt", "SQL", "blank"), 3: ("SQL", "END"), 4: ("txt", "SQL", "END"), 5: ("txt", "SQL"), 6: ("txt", "END")}
    later = {1: ("END",), 4: ("again",), 5: ("blank",)}

    def load(ready, batch_id):
        arrivals.append_once(f"{path}/out")(arrivals.ready_rows(ready, schema), batch_id)

    for run in (first, later, {}):
        for year, n in counts.items():
            for kind in run.get(year % 7, ()):
                if kind == "again":
                    base = f"{path}/in/{year}1231/CRM/ord{year}"
                    files.write_small(spark, f"{base}/ord{year}.END", str(n))
                else:
                    deliver(spark, path, year, **({"END": ""} if kind == "blank" else {kind: str(n)}))
        arrivals.note_blank_ends(spark, f"{path}/in", f"{path}/notes")
        stream = arrivals.stream_deliveries(spark, f"{path}/in", f"{path}/notes")
        arrivals.run_available(stream, f"{path}/checkpoint", arrivals.load_ready(f"{path}/receipts", load), "update")
    return spark.read.orc(f"{path}/out").drop(arrivals.BATCH)


JOINED_ORDERS_SQL = """
SELECT concat_ws('#&', coalesce(CAST(o_orderkey AS VARCHAR), ''),
  coalesce(CAST(o_custkey AS VARCHAR), ''), coalesce(o_orderstatus, ''),
  coalesce(CAST(o_totalprice AS VARCHAR), ''), coalesce(CAST(o_orderdate AS VARCHAR), ''),
  coalesce(o_orderpriority, '')) AS value
FROM orders
"""


@query(JOINED_ORDERS_SQL)
def write_delimited(spark, sf_dir):
    path = files.shared_dir(spark, "text")
    bundles.write_delimited(table(spark, sf_dir, "orders"), path)
    return spark.read.text(path)


@query("SELECT * FROM orders")
def write_target(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = files.shared_dir(spark, "target")
    store.write_target(orders, path, ["o_orderstatus"])
    return spark.read.schema(orders.schema).orc(path)


@query(JOINED_ORDERS_SQL)
def split_text(spark, sf_dir):
    path = files.shared_dir(spark, "split")
    bundles.write_delimited(table(spark, sf_dir, "orders"), f"{path}/whole")
    bundles.split_text(spark, f"{path}/whole", f"{path}/pieces", 20_000)
    return spark.read.text(f"{path}/pieces")


@query("SELECT doc_id, text, source FROM documents")
def split_quoted(spark, sf_dir):
    path = files.shared_dir(spark, "quoted")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows.write.option("escape", '"').option("quoteAll", "true").csv(f"{path}/whole")
    bundles.split_quoted(spark, f"{path}/whole", f"{path}/pieces", 100_000)
    reader = spark.read.schema(rows.schema).option("escape", '"').option("multiLine", "true").option("recursiveFileLookup", "true")
    return reader.csv(f"{path}/pieces")


@query(DELIVERED_SQL + """
SELECT concat_ws('#&', coalesce(CAST(o_orderkey AS VARCHAR), ''),
  coalesce(CAST(o_custkey AS VARCHAR), ''), coalesce(o_orderstatus, ''),
  coalesce(CAST(o_totalprice AS VARCHAR), ''), coalesce(CAST(o_orderdate AS VARCHAR), ''),
  coalesce(o_orderpriority, '')) AS value, y || '1231' AS etl_date, 'CRM' AS system_id, 'ord' || y AS name,
  n::INTEGER AS expected, 'ddl ' || y AS declaration, n AS lines
FROM counted
""")
def archive_deliveries(spark, sf_dir):
    path = files.shared_dir(spark, "archive")
    for year, n in order_years(spark, sf_dir, path).items():
        deliver(spark, path, year, txt="", SQL=f"ddl {year}", END=str(n))
    ready = landing.landing_manifest(files.list_files(spark, f"{path}/in"))
    for _ in range(2):  # a repeated run changes nothing
        landing.archive_deliveries(spark, ready, f"{path}/in", f"{path}/hist")
    receipts = landing.archive_receipts(spark, f"{path}/hist").drop("digest")
    return landing.archived_lines(spark, f"{path}/hist").join(receipts, landing.DELIVERY)


@query("""
SELECT unnest(string_split(text, chr(10))) AS value FROM documents
""")
def transcode_text(spark, sf_dir):
    path = files.shared_dir(spark, "charset")
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    lines.write.text(f"{path}/utf8")
    landing.transcode_text(spark, f"{path}/utf8", f"{path}/latin1", "UTF-8", "ISO-8859-1")
    landing.transcode_text(spark, f"{path}/latin1", f"{path}/back", "ISO-8859-1", "UTF-8")
    return spark.read.text(f"{path}/back")


@query("""
WITH sent AS (
  SELECT 'doc/' || doc_id AS path, strlen(text) AS length, md5(text) AS md5 FROM documents),
received AS (
  SELECT 'doc/' || doc_id AS path,
         strlen(CASE WHEN source = 'src1' THEN text || '.' ELSE replace(text, 'e', 'a') END) AS length,
         md5(CASE WHEN source = 'src1' THEN text || '.' ELSE replace(text, 'e', 'a') END) AS md5
  FROM documents WHERE lang <> 'de'
  UNION ALL SELECT 'page/' || page_id, strlen(html), md5(html) FROM pages)
SELECT coalesce(s.path, r.path) AS path, s.length AS sent_length, s.md5 AS sent_md5,
       r.length AS received_length, r.md5 AS received_md5,
       CASE WHEN r.length IS NULL THEN 'missing' WHEN s.length IS NULL THEN 'extra'
            WHEN s.length <> r.length THEN 'size_differs'
            WHEN s.md5 <> r.md5 THEN 'content_differs' ELSE 'ok' END AS status
FROM sent s FULL JOIN received r ON s.path = r.path
""")
def verify_transfer(spark, sf_dir):
    def listing(df, path, text):
        return df.select(path.alias("path"), text.alias("text")).select(
            "path", F.octet_length("text").cast("long").alias("length"), F.md5("text").alias("md5")
        )

    documents = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("doc/"), "doc_id")
    changed = F.when(F.col("source") == "src1", F.concat("text", F.lit("."))).otherwise(
        F.replace("text", F.lit("e"), F.lit("a"))
    )
    pages = table(spark, sf_dir, "pages")
    received = listing(documents.where("lang <> 'de'"), path, changed).unionByName(
        listing(pages, F.concat(F.lit("page/"), "page_id"), F.col("html"))
    )
    return landing.verify_transfer(
        listing(documents, path, F.col("text")), received, checksum=True
    )


@query(r"""
WITH lines AS (SELECT source, unnest(string_split(text, chr(10))) AS value FROM documents),
sent AS (SELECT source, count(*) AS sent_rows FROM lines WHERE source <> 'src3' GROUP BY source),
received AS (SELECT source, count(*) AS received_rows FROM lines WHERE source <> 'src0' GROUP BY source)
SELECT coalesce(s.source, r.source) AS source, sent_rows, received_rows,
       CASE WHEN r.source IS NULL THEN 'missing' WHEN s.source IS NULL THEN 'extra'
            WHEN r.source = 'src1' THEN 'content_differs' ELSE 'ok' END AS status
FROM sent s FULL JOIN received r USING (source)
""")
def verify_content(spark, sf_dir):
    """A tree that was cut, re-encoded and compressed against its source; one file lost, one added, one altered."""
    path = files.shared_dir(spark, "trees")
    lines = table(spark, sf_dir, "documents").select("source", F.explode(F.split("text", "\n")).alias("value"))
    lines.where("source <> 'src3'").write.partitionBy("source").text(f"{path}/sent")
    altered = F.when(F.col("source") == "src1", F.concat(F.lit("x"), "value")).otherwise(F.col("value"))
    # another cut than the sent one, into parts of bounded size however many rows there are
    moved = lines.where("source <> 'src0'").withColumn("value", altered).hint("rebalance")
    moved.write.partitionBy("source").option("maxRecordsPerFile", 500).option("compression", "gzip").text(f"{path}/received")
    schema = "value string, source string"
    return landing.verify_content(
        spark.read.schema(schema).text(f"{path}/sent"), spark.read.schema(schema).text(f"{path}/received"), ["source"]
    )


@query("""
WITH registry AS (
  SELECT l_orderkey, l_linenumber AS pos, 'c' || l_partkey AS column_name, 'number(' || l_suppkey || ')' AS column_type,
         strftime(l_shipdate, '%Y%m%d') AS date_change FROM lineitem),
days AS (SELECT o_orderkey, strftime(o_orderdate + INTERVAL 30 DAY, '%Y%m%d') AS etl_date FROM orders)
SELECT o_orderkey AS table_name, etl_date, pos, column_name, column_type, date_change
FROM registry JOIN days ON l_orderkey = o_orderkey AND date_change <= etl_date
QUALIFY row_number() OVER (PARTITION BY o_orderkey, etl_date, pos ORDER BY date_change DESC, column_name DESC, column_type DESC) = 1
""")
def registry_as_of(spark, sf_dir):
    """Columns of a table per order as they stood 30 days after it, where every line of it is a registered change."""
    registry = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("table_name"), F.col("l_linenumber").alias("pos"), F.concat(F.lit("c"), "l_partkey").alias("column_name"),
        F.concat(F.lit("number("), "l_suppkey", F.lit(")")).alias("column_type"), day_of("l_shipdate").alias("date_change"),
    )
    days = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("table_name"), day_of(F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("etl_date")
    )
    return schema.registry_as_of(registry, days)


@query("""
SELECT 'sales.orders' AS table_name, 'o_orderstatus=' || o_orderstatus AS partition_name,
       'replace' AS action, CAST(NULL AS VARCHAR) AS predicate, count(*) AS row_count
FROM orders GROUP BY o_orderstatus
""")
def export_bundle(spark, sf_dir):
    path = files.shared_dir(spark, "bundle")
    store.publish(table(spark, sf_dir, "orders"), f"{path}/table", ["o_orderstatus"])
    transfer.export_table(
        spark, f"{path}/table", f"{path}/out", "sales.orders", "all", "20240101", ["o_orderstatus"]
    )
    return bundles.read_manifest(spark, f"{path}/out").drop("schema_json", "partition_values")


ODD_SQL = """
WITH odd AS (
  SELECT o_orderkey, o_totalprice,
         CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 'x:y' WHEN '3-MEDIUM' THEN 'k/l'
              WHEN '5-LOW' THEN '50%25' ELSE 'p q+' END AS k,
         CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN 'a=b/c=d' ELSE o_orderstatus END AS l
  FROM orders)
"""


def odd_partitions(spark, sf_dir):
    """Orders under partition values that need escaping in a path, and NULL."""
    k = F.when(F.col("o_orderpriority") == "1-URGENT", None)
    for name, value in (("2-HIGH", "x:y"), ("3-MEDIUM", "k/l"), ("5-LOW", "50%25")):
        k = k.when(F.col("o_orderpriority") == name, value)
    l = F.when(F.col("o_orderstatus") == "F", None).when(F.col("o_orderstatus") == "O", "a=b/c=d")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", k.otherwise("p q+").alias("k"), l.otherwise(F.col("o_orderstatus")).alias("l")
    )


def exported(spark, sf_dir, mode):
    """A bundle's rows, each with its partition's count in the manifest."""
    path = files.shared_dir(spark, "odd")
    store.publish(odd_partitions(spark, sf_dir), f"{path}/table", ["k", "l"])
    transfer.export_table(spark, f"{path}/table", f"{path}/out", "s.odd", mode, "20000101", ["k", "l"])
    rows = bundles.read_bundle(spark, f"{path}/out")
    values = F.from_json("partition_values", "k string, l string")
    plan = bundles.read_manifest(spark, f"{path}/out").select("action", "row_count", values.alias("v"))
    plan = plan.select("action", "row_count", "v.k", "v.l")
    return join_on(rows, plan, ["k", "l"], "left", null_safe=True)


@query(ODD_SQL + "SELECT *, 'replace' AS action, count(*) OVER (PARTITION BY k, l) AS row_count FROM odd")
def export_table_all(spark, sf_dir):
    return exported(spark, sf_dir, "all")


@query(ODD_SQL + "SELECT *, 'replace' AS action, count(*) OVER (PARTITION BY k, l) AS row_count FROM odd")
def export_table_auto(spark, sf_dir):
    return exported(spark, sf_dir, "auto")


@query(ODD_SQL + """
SELECT * FROM odd UNION ALL SELECT o_orderkey, 0, 'kept', NULL FROM odd WHERE k = 'x:y'
""")
def import_table(spark, sf_dir):
    path = files.shared_dir(spark, "odd")
    rows = odd_partitions(spark, sf_dir)
    store.publish(rows, f"{path}/table", ["k", "l"])
    old = rows.withColumn("o_totalprice", F.lit(0.0).cast(rows.schema["o_totalprice"].dataType))
    kept = old.where("k = 'x:y'").withColumns({"k": F.lit("kept"), "l": F.lit(None).cast("string")})
    store.publish(old.unionByName(kept), f"{path}/far", ["k", "l"])
    transfer.export_table(spark, f"{path}/table", f"{path}/out", "s.odd", "auto", "20000101", ["k", "l"])
    transfer.import_table(spark, f"{path}/out", f"{path}/far", ["k", "l"])
    return store.read_table(spark, f"{path}/far")


@query("""
SELECT o_orderpriority AS partition_name,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'changed' WHEN '2-HIGH' THEN 'missing' WHEN '3-MEDIUM' THEN 'empty' ELSE 'unchanged' END AS state,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'replace' WHEN '2-HIGH' THEN 'truncate' WHEN '3-MEDIUM' THEN 'truncate' END AS action,
       CASE o_orderpriority WHEN '1-URGENT' THEN count(*) WHEN '2-HIGH' THEN 0 WHEN '3-MEDIUM' THEN 0 END AS exported,
       CASE WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN NULL ELSE count(*) END AS far_rows,
       CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(sum(o_orderkey + 1) AS BIGINT)
            WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN NULL ELSE CAST(sum(o_orderkey) AS BIGINT) END AS far_keys
FROM orders GROUP BY o_orderpriority
""")
def export_inventory(spark, sf_dir):
    """A changed, a dropped, an emptied and unchanged partitions, exported and imported."""
    path = files.shared_dir(spark, "inventory")
    key = "o_orderpriority"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", key)
    near, far, out = f"{path}/table", f"{path}/far", f"{path}/out"

    def exchange_once(mode, day):
        transfer.export_table(spark, near, out, "s.orders", mode, day, [key])
        transfer.import_table(spark, out, far, [key])

    store.publish(orders, near, [key])
    exchange_once("all", "20240101")
    version = store.current_path(spark, near)
    for name in ("3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"):
        for part in files.children(spark, f"{version}/{key}={name}"):
            files.set_modified(spark, f"{version}/{key}={name}/{part}", 1_000_000_000)
            if name == "3-MEDIUM":
                files.write_small(spark, f"{version}/{key}={name}/{part}", "")
                files.set_modified(spark, f"{version}/{key}={name}/{part}", 1_000_000_000)
    changed = orders.where(f"{key} = '1-URGENT'").withColumn("o_orderkey", F.col("o_orderkey") + 1)
    dropped = spark.createDataFrame([("2-HIGH",)], f"{key} string")
    store.replace_partitions(changed, near, [key], dropped)
    states = transfer.table_changes(spark, near, "20200101", [key], orders.schema, store.read_table(spark, f"{out}/{bundles.INVENTORY}"))
    states = states.select(F.col(key).alias("partition_name"), "state")
    exchange_once("auto", "20200101")
    plan = bundles.read_manifest(spark, out).select(
        F.from_json("partition_values", f"{key} string")[key].alias("partition_name"), "action", F.col("row_count").alias("exported")
    )
    held = store.read_table(spark, far).groupBy(F.col(key).alias("partition_name"))
    held = held.agg(F.count("*").alias("far_rows"), F.sum("o_orderkey").alias("far_keys"))
    return states.join(plan, "partition_name", "full").join(held, "partition_name", "full")


@query("""
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
""")
def import_create(spark, sf_dir):
    path = files.shared_dir(spark, "create")
    store.publish(table(spark, sf_dir, "orders"), f"{path}/table")
    transfer.export_table(spark, f"{path}/table", f"{path}/out", "sales.orders", "all", "20240101")
    return bundles.import_create(spark, f"{path}/out", f"{path}/new", ["o_custkey"])


@query("SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_acctbal < 0")
def load_external(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    root = files.shared_dir(spark, "external")
    bundles.load_external(customer, root, "insert")
    bundles.load_external(customer, root, "all")
    return bundles.load_external(customer.where("c_acctbal < 0"), root, "add")


# ----------------------------------------------------------------------- schema and partitions


@query("""
WITH base AS (
  SELECT c_custkey, 'crm.cust' || c_custkey AS table_name, lower(c_mktsegment) AS seg,
         c_nationkey, lower(c_name) AS nm, 'all of ' || lower(c_name) AS table_comment
  FROM customer)
SELECT c_custkey, table_name, 0 AS pos, 'id' AS column_name, 'number(10)' AS column_type,
       true AS is_key, 'key of ' || nm AS comment, table_comment FROM base
UNION ALL SELECT c_custkey, table_name, 1, 'bal_' || seg,
       'number(' || (c_nationkey + 5) || ',2)', false, NULL, table_comment FROM base
UNION ALL SELECT c_custkey, table_name, 2, seg, 'varchar2(50)', true, NULL, table_comment FROM base
UNION ALL SELECT c_custkey, table_name, 3, 'opened', 'date', false, NULL, table_comment FROM base
""")
def extract_schema(spark, sf_dir):
    name = F.concat(F.lit("CRM.CUST"), "c_custkey")
    script = F.concat(
        F.lit("CREATE TABLE "), name, F.lit(" (\n  ID   NUMBER(10) NOT NULL,\n  BAL_"),
        "c_mktsegment", F.lit(" NUMBER("), F.col("c_nationkey") + 5, F.lit(",2),\n\n  "),
        "c_mktsegment", F.lit(" VARCHAR2(50),\n  OPENED DATE,\n  PRIMARY KEY (ID, "),
        "c_mktsegment", F.lit(")\n);\nCOMMENT ON TABLE "), name, F.lit(" IS 'All of "), "c_name",
        F.lit("';\nCOMMENT ON COLUMN "), name, F.lit(".ID IS 'Key of "), "c_name", F.lit("';\n"),
    )
    return schema.extract_schema(
        table(spark, sf_dir, "customer").select("c_custkey", script.alias("value"))
    )


LINE_TYPES = [
    ("l_orderkey", "number(20)"),
    ("l_quantity", "number(10,2)"),
    ("l_extendedprice", "number(30,2)"),
    ("l_returnflag", "varchar2(1)"),
    ("l_shipdate", "date"),
    ("code", "number"),
]


@query("""
SELECT l_orderkey, CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity,
       CAST(l_extendedprice AS DECIMAL(32,2)) AS l_extendedprice, l_returnflag, l_shipdate,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS code,
       CASE WHEN l_returnflag = 'N' THEN 'code' ELSE '' END AS failed
FROM lineitem
""")
def cast_to_target(spark, sf_dir):
    text = table(spark, sf_dir, "lineitem").withColumn(
        "code",
        F.when(F.col("l_returnflag") == "N", F.col("l_linestatus")).otherwise(
            F.col("l_linenumber").cast("string")
        ),
    )
    text = text.select(*[F.col(name).cast("string").alias(name) for name, _ in LINE_TYPES])
    typed = schema.cast_to_target(text, LINE_TYPES, failed="failed")
    return typed.withColumn("failed", F.concat_ws(",", "failed"))


DRIFT_SQL = """
WITH lines AS (
  SELECT 't' || l_orderkey AS table_name, l_linenumber AS pos, min(l_partkey) AS p0,
         max(l_partkey) AS p1, min(l_returnflag) AS f0, max(l_returnflag) AS f1,
         max(l_discount) AS discount, min(l_tax) AS tax
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
cur AS (SELECT table_name, pos, 'c' || p1 AS column_name, f1 AS column_type FROM lines
        WHERE discount < 0.1),
reg AS (SELECT table_name, pos, 'c' || p0 AS old_name, f0 AS old_type FROM lines WHERE tax > 0),
drift AS (
  SELECT coalesce(c.table_name, r.table_name) AS table_name, coalesce(c.pos, r.pos) AS pos,
         column_name, column_type, old_name, old_type,
         CASE WHEN column_name IS NULL THEN 'removed' WHEN old_name IS NULL THEN 'appended'
              WHEN column_name <> old_name THEN 'renamed'
              WHEN column_type <> old_type THEN 'retyped' ELSE 'same' END AS change
  FROM cur c FULL JOIN reg r ON c.table_name = r.table_name AND c.pos = r.pos)
"""


def line_schemas(spark, sf_dir):
    """Delivered and registered schemas derived from order lines."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.concat(F.lit("t"), "l_orderkey").alias("table_name"), F.col("l_linenumber").alias("pos")
        )
        .agg(
            F.min("l_partkey").alias("p0"),
            F.max("l_partkey").alias("p1"),
            F.min("l_returnflag").alias("f0"),
            F.max("l_returnflag").alias("f1"),
            F.max("l_discount").alias("discount"),
            F.min("l_tax").alias("tax"),
        )
    )

    def side(rows, part, flag):
        return rows.select(
            "table_name",
            "pos",
            F.concat(F.lit("c"), part).alias("column_name"),
            F.col(flag).alias("column_type"),
        )

    return side(lines.where("discount < 0.1"), "p1", "f1"), side(lines.where("tax > 0"), "p0", "f0")


@query(DRIFT_SQL + "SELECT * FROM drift")
def schema_drift(spark, sf_dir):
    return schema.schema_drift(*line_schemas(spark, sf_dir))


@query(DRIFT_SQL + """
SELECT table_name,
       CASE WHEN count(*) FILTER (change IN ('removed', 'renamed', 'retyped')) > 0 THEN 'error'
            WHEN count(old_name) = 0 THEN 'initial'
            WHEN count(*) FILTER (change = 'appended') > 0 THEN 'appended' ELSE 'same' END AS verdict,
       min(pos) FILTER (change IN ('removed', 'renamed', 'retyped')) AS bad_pos,
       count(*) FILTER (change = 'appended') AS appended
FROM drift GROUP BY table_name
""")
def schema_verdict(spark, sf_dir):
    return schema.drift_verdict(schema.schema_drift(*line_schemas(spark, sf_dir)))


@query("""
SELECT c_custkey, c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal,
       CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer WHERE c_acctbal < 0
UNION ALL SELECT * FROM customer WHERE c_acctbal >= 0
""")
def evolve_add_columns(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    old = customer.where("c_acctbal < 0").select("c_custkey", "c_name", "c_nationkey")
    return schema.evolve_add_columns(old, customer.schema.fields).unionByName(
        customer.where("c_acctbal >= 0")
    )


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def conform(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    target = T.StructType(orders.schema.fields[:3])
    return schema.conform(orders, target, remove=["O_ORDERPRIORITY"])


@query("SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def remove_fields(spark, sf_dir):
    return schema.remove_fields(table(spark, sf_dir, "customer"), ["c_name", "C_ACCTBAL"])


YEAR_BOUNDS = [(f"p{year}", (f"{year + 1}0101",)) for year in range(1995, 2000)] + [
    ("pmax", (layout.MAXVALUE,))
]


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS etl_date,
       CASE WHEN year(o_orderdate) >= 2000 THEN 'pmax' ELSE 'p' || year(o_orderdate) END
         AS partition_name
FROM orders
""")
def assign_range_partition(spark, sf_dir):
    days = order_days(spark, sf_dir).select("o_orderkey", "etl_date")
    return layout.assign_range_partition(days, ["etl_date"], YEAR_BOUNDS)


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS etl_date, o_totalprice,
  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' AND o_totalprice < 100000 THEN 'old_low'
       WHEN o_orderdate < TIMESTAMP '1998-01-01' AND o_totalprice >= 100000
            AND o_totalprice < 300000 THEN 'old_mid'
       WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND o_totalprice >= 300000 THEN 'new_high'
  END AS partition_name
FROM orders
""")
def assign_range_partition_two_columns(spark, sf_dir):
    days = order_days(spark, sf_dir).select("o_orderkey", "etl_date", "o_totalprice")
    bounds = [
        ("old_low", ("19980101", 100000)),
        ("old_mid", ("19980101", 300000)),
        ("new_high", (layout.MAXVALUE, layout.MAXVALUE)),
    ]
    return layout.assign_range_partition(days, ["etl_date", "o_totalprice"], bounds)


@query("""
SELECT o_orderkey, CASE WHEN o_custkey % 1000 >= 20 AND o_orderkey % 10000 < 100 THEN NULL
  ELSE 'p' || (o_custkey % 1000) // 20 || '_' || (o_orderkey % 10000) // 100 END AS partition_name
FROM orders
""")
def assign_range_partition_many(spark, sf_dir):
    """5,000 bounds on two columns. From the second run on a run's first bound has no room: it begins where the run before ends."""
    keys = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey % 1000 AS a", "o_orderkey % 10000 AS b")
    bounds = [(f"p{i}_{j}", (20 * (i + 1), 100 * (j + 1))) for i in range(50) for j in range(100)]
    return layout.assign_range_partition(keys, ["a", "b"], bounds).drop("a", "b")


@query("""
SELECT * FROM lineitem WHERE (l_returnflag = 'A' AND l_linestatus = 'F')
   OR (l_returnflag = 'R' AND l_linestatus = 'O')
""")
def filter_list_partitions(spark, sf_dir):
    labels = ["l_returnflag=A/l_linestatus=F", "l_returnflag=R/l_linestatus=O"]
    return layout.filter_list_partitions(table(spark, sf_dir, "lineitem"), labels)


@query("SELECT * FROM lineitem WHERE l_partkey BETWEEN 1 AND 149 AND l_linenumber = l_partkey % 7 + 1")
def filter_list_partitions_many(spark, sf_dir):
    pairs = [(f"l_partkey={i}", f"l_linenumber={i % 7 + 1}") for i in range(1, 150)]
    labels = ["/".join(pair if i % 2 else pair[::-1]) for i, pair in enumerate(pairs)]
    return layout.filter_list_partitions(table(spark, sf_dir, "lineitem"), labels)


@query("""
WITH parts AS (
  SELECT o_custkey AS tab, 'p' || o_orderkey AS partition_name,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'MINVALUE'
              ELSE strftime(o_orderdate, '%Y%m%d') END AS s,
         strftime(o_orderdate + INTERVAL 7 DAY, '%Y%m%d') AS e
  FROM orders),
ranges AS (
  SELECT tab, max(partition_name) AS partition_name, max(s || ',' || e) AS newest,
         min(s || ',' || e) AS oldest
  FROM parts WHERE s NOT LIKE 'M%' GROUP BY tab),
buckets AS (SELECT o_custkey AS tab, max(l_linenumber) AS bucket_number
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)
SELECT c_custkey AS "table", partition_name, newest[1:8] AS newest_start,
       newest[10:17] AS newest_end, oldest[10:17] AS oldest_end, bucket_number
FROM customer LEFT JOIN ranges r ON c_custkey = r.tab LEFT JOIN buckets b ON c_custkey = b.tab
""")
def partition_summary(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    tables = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("table"))
    start = F.when(F.col("o_orderpriority") == "3-MEDIUM", layout.MINVALUE).otherwise(
        day_of("o_orderdate")
    )
    partitions = orders.select(
        F.col("o_custkey").alias("table"),
        F.concat(F.lit("p"), "o_orderkey").alias("partition_name"),
        start.alias("range_start"),
        day_of(F.date_add(F.to_date("o_orderdate"), 7)).alias("range_end"),
    )
    buckets = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
        .join(orders.select("o_orderkey", "o_custkey"), "o_orderkey")
        .select(F.col("o_custkey").alias("table"), F.col("l_linenumber").alias("bucket_number"))
    )
    return layout.partition_summary(tables, partitions, buckets)


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def duplicate_keys(spark, sf_dir):
    return schema.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT false AS matches_declared, count(*) AS duplicate_keys,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
""")
def check_merge_key(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return schema.check_merge_key(lineitem, ["l_orderkey", "l_linenumber"], ["l_orderkey"])


# ---------------------------------------------------------------------------------- load modes


@query("""
SELECT *, 'sales' AS system_id, strftime(o_orderdate, '%Y%m%d') AS etl_date FROM orders
""")
def with_audit(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return loads.with_audit(orders, "sales", day_of("o_orderdate")).drop(loads.BUCKET)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM customer")
def load_full(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    root = files.shared_dir(spark, "full")
    store.publish(customer, root)
    tgt = store.read_table(spark, root)
    src = customer.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    store.publish(loads.load_full(src, tgt), root)
    return store.read_table(spark, root)


ADD_SQL = """
WITH days AS (SELECT *, strftime(o_orderdate, '%Y%m%d') AS etl_date FROM orders)
SELECT * FROM days WHERE etl_date <> '{gone}'
UNION ALL
SELECT o_orderkey, o_custkey, 'N' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       etl_date FROM days WHERE etl_date BETWEEN '{gone}' AND '19980803'
"""


def delivered_days(tgt, first, last):
    return tgt.where(F.col("etl_date").between(first, last)).withColumn(
        "o_orderstatus", F.lit("N")
    )


@query(ADD_SQL.format(gone="19980803"))
def load_add(spark, sf_dir):
    tgt = order_days(spark, sf_dir)
    src = delivered_days(tgt, "19980803", "19980803")
    return loads.load_add(src, tgt, "etl_date", "19980803")


@query(ADD_SQL.format(gone="19980801"))
def load_add_late(spark, sf_dir):
    tgt = order_days(spark, sf_dir)
    src = delivered_days(tgt, "19980801", "19980803")
    return loads.load_add(src, tgt, "etl_date", "19980803", "T-3")


@query(ADD_SQL.format(gone="19980803"))
def load_add_partitions(spark, sf_dir):
    tgt = order_days(spark, sf_dir).withColumn("etl_month", F.substring("etl_date", 1, 6))
    root = files.shared_dir(spark, "add")
    store.publish(tgt, root, ["etl_month"])
    held = store.read_table(spark, root).where("etl_month = '199808'")
    src = delivered_days(tgt, "19980803", "19980803")
    state = loads.load_add(src, held, "etl_date", "19980803")
    store.replace_partitions(state, root, ["etl_month"])
    return store.read_table(spark, root).drop("etl_month")


def delivered_customers(spark, sf_dir):
    """Changed and new customers: all but one segment, with a changed balance."""
    return (
        table(spark, sf_dir, "customer")
        .where("c_mktsegment <> 'FURNITURE'")
        .withColumn("c_acctbal", F.col("c_acctbal") + 1)
        .withColumns({"system_id": F.lit("new"), "etl_date": F.lit("20240201")})
    )


def loaded_customers(spark, sf_dir):
    """The target before: all but another segment; debtors were loaded later than the rest."""
    day = F.when(F.col("c_acctbal") < 0, "20240301").otherwise("20240101")
    return (
        table(spark, sf_dir, "customer")
        .where("c_mktsegment <> 'MACHINERY'")
        .withColumns({"system_id": F.lit("old"), "etl_date": day})
    )


CUSTOMER_SQL = """
WITH src AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment,
         'new' AS system_id, '20240201' AS etl_date
  FROM customer WHERE c_mktsegment <> 'FURNITURE'),
tgt AS (
  SELECT *, 'old' AS system_id,
         CASE WHEN c_acctbal < 0 THEN '20240301' ELSE '20240101' END AS etl_date
  FROM customer WHERE c_mktsegment <> 'MACHINERY'),
updated AS (
  SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.c_custkey = t.c_custkey)
  UNION ALL SELECT * FROM src),
merged AS (
  SELECT t.c_custkey,
         CASE WHEN s.c_custkey IS NOT NULL AND t.etl_date <= '20240201' THEN s.c_name
              ELSE t.c_name END AS c_name,
         CASE WHEN s.c_custkey IS NOT NULL AND t.etl_date <= '20240201' THEN s.c_nationkey
              ELSE t.c_nationkey END AS c_nationkey,
         CASE WHEN s.c_custkey IS NOT NULL AND t.etl_date <= '20240201' THEN s.c_acctbal
              ELSE t.c_acctbal END AS c_acctbal,
         CASE WHEN s.c_custkey IS NOT NULL AND t.etl_date <= '20240201' THEN s.c_mktsegment
              ELSE t.c_mktsegment END AS c_mktsegment,
         t.system_id,
         CASE WHEN s.c_custkey IS NOT NULL AND t.etl_date <= '20240201' THEN '20240201'
              ELSE t.etl_date END AS etl_date
  FROM tgt t LEFT JOIN src s ON t.c_custkey = s.c_custkey
  UNION ALL
  SELECT * FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE s.c_custkey = t.c_custkey))
"""


@query(CUSTOMER_SQL + "SELECT * FROM updated")
def load_update(spark, sf_dir):
    return loads.load_update(
        delivered_customers(spark, sf_dir), loaded_customers(spark, sf_dir), ["c_custkey"]
    )


@query(CUSTOMER_SQL + "SELECT * FROM merged")
def load_merge(spark, sf_dir):
    return loads.load_merge(
        delivered_customers(spark, sf_dir),
        loaded_customers(spark, sf_dir),
        ["c_custkey"],
        "20240201",
    )


@query(CUSTOMER_SQL + "SELECT *, CASE WHEN etl_date = '20240201' THEN 'g' || c_custkey END AS grade FROM merged")
def load_merge_evolved(spark, sf_dir):
    src = delivered_customers(spark, sf_dir).withColumn("grade", F.concat(F.lit("g"), "c_custkey"))
    return loads.load_merge(src, loaded_customers(spark, sf_dir), ["c_custkey"], "20240201")


@query(CUSTOMER_SQL + "SELECT *, CASE WHEN etl_date = '20240201' THEN 'g' || c_custkey END AS grade FROM merged")
def load_merge_large(spark, sf_dir):
    """The plan of a delivery too large to broadcast, in a session of its own."""
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return load_merge_evolved(session, sf_dir)


@query("SELECT * FROM orders")
def load_initial(spark, sf_dir):
    root = files.shared_dir(spark, "initial")
    src = table(spark, sf_dir, "orders")
    store.publish(loads.load_initial(src, False, store.table_exists(spark, root)), root)
    return store.read_table(spark, root)


@query("SELECT strftime(o_orderdate, '%Y%m%d') AS day, count(*) AS n FROM orders GROUP BY 1")
def day_histogram(spark, sf_dir):
    return layout.day_histogram(order_days(spark, sf_dir), "etl_date").orderBy("day")


TOTAL_MB, SPAN_MB = 4000.0, 300.0

PACK_SQL = """
WITH RECURSIVE hist AS (
  SELECT strftime(o_orderdate, '%Y%m%d') AS day, count(*) AS n FROM orders GROUP BY 1),
days AS (
  SELECT day, n, row_number() OVER (ORDER BY day) AS i, max(day) OVER () AS last_day,
         min(day) OVER () AS first_day, sum(n) OVER () AS all_rows FROM hist),
fold AS (
  SELECT i, day, last_day, n AS acc, day AS start_day,
         strftime(strptime(first_day, '%Y%m%d') - INTERVAL 1 DAY, '%Y%m%d') AS lower_day,
         (day = last_day OR 4000.0::DOUBLE * n / all_rows >= 300.0) AS closed,
         4000.0::DOUBLE * n / all_rows AS mb
  FROM days WHERE i = 1
  UNION ALL
  SELECT d.i, d.day, d.last_day, CASE WHEN f.closed THEN d.n ELSE f.acc + d.n END,
         CASE WHEN f.closed THEN d.day ELSE f.start_day END,
         CASE WHEN f.closed THEN f.day ELSE f.lower_day END,
         (d.day = d.last_day OR
          4000.0::DOUBLE * CASE WHEN f.closed THEN d.n ELSE f.acc + d.n END / d.all_rows >= 300.0),
         4000.0::DOUBLE * CASE WHEN f.closed THEN d.n ELSE f.acc + d.n END / d.all_rows
  FROM fold f JOIN days d ON d.i = f.i + 1),
parts AS (
  SELECT 'partition_' || start_day AS partition_name, lower_day AS "lower",
         CASE WHEN day <> last_day THEN day ELSE strftime(greatest(
           strptime(start_day, '%Y%m%d') + to_days(CAST(least(10950,
             date_diff('day', strptime(start_day, '%Y%m%d'), strptime(last_day, '%Y%m%d'))
             * floor(300.0 / mb) + 1) AS INTEGER)),
           strptime(last_day, '%Y%m%d') + INTERVAL 1 DAY), '%Y%m%d') END AS "upper"
  FROM fold WHERE closed)
"""


@query(PACK_SQL + 'SELECT partition_name, "lower", "upper" FROM parts')
def pack_day_partitions(spark, sf_dir):
    histogram = layout.day_histogram(order_days(spark, sf_dir), "etl_date")
    return layout.pack_day_partitions(histogram, TOTAL_MB, SPAN_MB)


@query(PACK_SQL + """
SELECT p.partition_name, count(*) AS n
FROM orders o JOIN parts p ON strftime(o_orderdate, '%Y%m%d') >= p."lower"
                          AND strftime(o_orderdate, '%Y%m%d') < p."upper"
GROUP BY p.partition_name
""")
def load_initial_partitioned(spark, sf_dir):
    labelled = layout.load_initial_partitioned(
        order_days(spark, sf_dir), "etl_date", TOTAL_MB, SPAN_MB
    )
    root = files.shared_dir(spark, "packed")
    store.publish(labelled, root, ["partition_name"])
    return store.read_table(spark, root).groupBy("partition_name").agg(F.count("*").alias("n"))


@query("""
WITH sizes AS (
  SELECT strftime(o_orderdate, '%Y%m') AS etl_month, count(*) AS n,
         count(DISTINCT strftime(o_orderdate, '%Y%m%d')) AS days,
         count(*) * 1000000 / 1024.0::DOUBLE / 1024.0::DOUBLE / 10.0::DOUBLE AS mb
  FROM orders GROUP BY 1)
SELECT etl_month, n, CAST(floor(mb / 70) + 1 AS INTEGER) AS files,
       CAST(floor(least(mb / days * 49, 4200.0::DOUBLE) / 70) + 1 AS INTEGER) AS span_files
FROM sizes
""")
def size_output(spark, sf_dir):
    months = (
        order_days(spark, sf_dir)
        .groupBy(F.substring("etl_date", 1, 6).alias("etl_month"))
        .agg(F.count("*").alias("n"), F.count_distinct("etl_date").alias("days"))
    )
    mb = layout.text_size_mb((F.col("n") * 1_000_000).cast("double"))
    return months.select(
        "etl_month",
        "n",
        layout.file_count(mb).alias("files"),
        layout.file_count_partitioned(mb, F.col("days")).alias("span_files"),
    )


@query("""
WITH stats AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) / 100.0::DOUBLE AS newest_mb,
         min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders GROUP BY 1),
spans AS (
  SELECT *, CAST(least(floor(70.0::DOUBLE * 60 / (newest_mb / (date_diff('day', s, e) + 1))) + 1,
                       10950) AS INTEGER) AS span_days FROM stats)
SELECT order_year, newest_mb, strftime(s, '%Y%m%d') AS newest_start,
       strftime(e, '%Y%m%d') AS newest_end, 60 AS bucket_number, span_days,
       CASE WHEN '20000601' >= strftime(e, '%Y%m%d')
            THEN strftime(TIMESTAMP '2000-06-01' + to_days(span_days), '%Y%m%d') END AS next_bound
FROM spans
""")
def next_partition_bound(spark, sf_dir):
    stats = (
        order_days(spark, sf_dir)
        .groupBy(F.year("o_orderdate").alias("order_year"))
        .agg(
            (F.count("*") / 100.0).alias("newest_mb"),
            F.min("etl_date").alias("newest_start"),
            F.max("etl_date").alias("newest_end"),
        )
        .withColumn("bucket_number", F.lit(60))
    )
    return layout.next_partition_bound(stats, "20000601", incoming_mb=1.0)


@query("""
WITH expected AS (SELECT o_orderkey, CAST(floor(o_totalprice / 100000) AS BIGINT) AS expected FROM orders),
     actual AS (SELECT l_orderkey AS o_orderkey, count(*) AS loaded FROM lineitem GROUP BY 1)
SELECT o_orderkey, expected, coalesce(loaded, 0) AS loaded,
       coalesce(loaded, 0) - expected AS diff,
       CASE WHEN coalesce(loaded, 0) = expected THEN 'ok' ELSE 'failed' END AS status
FROM expected LEFT JOIN actual USING (o_orderkey)
""")
def reconcile_counts(spark, sf_dir):
    return loads.reconcile_counts(*line_counts(spark, sf_dir), ["o_orderkey"])


def line_counts(spark, sf_dir):
    """Declared and loaded lines per order; an order stands for one declared line per 100,000 of its
    price."""
    expected = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.floor(F.col("o_totalprice") / 100_000).alias("expected")
    )
    actual = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("loaded"))
    )
    return expected, actual


@query(CUSTOMER_SQL + """
SELECT 'full' AS load_type, * FROM src UNION ALL SELECT 'update', * FROM updated
UNION ALL SELECT 'merge', * FROM merged
UNION ALL SELECT 'add', * FROM (SELECT * FROM tgt WHERE etl_date <> '20240201'
                                UNION ALL SELECT * FROM src)
""")
def apply_load(spark, sf_dir):
    src, tgt = delivered_customers(spark, sf_dir), loaded_customers(spark, sf_dir)
    states = [
        loads.apply_load(src, tgt, kind, "20240201", ["c_custkey"]).select(
            F.lit(kind).alias("load_type"), *tgt.columns
        )
        for kind in loads.LOAD_TYPES
    ]
    out = states[0]
    for state in states[1:]:
        out = out.unionByName(state)
    return out


# -------------------------------------------------------------------------- export and import

MONTH_FILES_SQL = """
WITH listing AS (
  SELECT strftime(o_orderdate, '%Y%m') AS partition_name, o_orderdate AS modified,
         CASE WHEN year(o_orderdate) = 1996 THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END
           AS length
  FROM orders),
known AS (SELECT DISTINCT strftime(l_shipdate, '%Y%m') AS partition_name FROM lineitem),
stats AS (SELECT partition_name, max(modified) AS modified, sum(length)::BIGINT AS bytes,
                 count(*) AS files FROM listing GROUP BY 1),
changes AS (
  SELECT partition_name,
         CASE WHEN files IS NULL THEN 'missing'
              WHEN strftime(modified, '%Y%m%d') >= '20000615' THEN 'changed'
              WHEN bytes = 0 THEN 'empty' ELSE 'unchanged' END AS state,
         CASE WHEN files IS NULL THEN -3 WHEN strftime(modified, '%Y%m%d') >= '20000615' THEN -1
              WHEN bytes = 0 THEN -2 ELSE 0 END AS code,
         coalesce(files, 0) AS files, coalesce(bytes, 0) AS bytes
  FROM known LEFT JOIN stats USING (partition_name))
"""


def month_changes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    size = F.when(F.year("o_orderdate") == 1996, 0).otherwise(F.floor("o_totalprice"))
    listing = orders.select(
        F.date_format("o_orderdate", "yyyyMM").alias("partition_name"),
        F.col("o_orderdate").alias("modified"),
        size.cast("long").alias("length"),
    )
    known = table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyyMM").alias("partition_name")
    )
    return exchange.detect_changes(known, listing, "20000615")


@query(MONTH_FILES_SQL + "SELECT * FROM changes")
def detect_changes(spark, sf_dir):
    return month_changes(spark, sf_dir)


@query("SELECT * FROM customer")
def export_all(spark, sf_dir):
    path = files.shared_dir(spark, "export")
    store.publish(table(spark, sf_dir, "customer"), f"{path}/table")
    transfer.export_table(spark, f"{path}/table", f"{path}/out", "crm.customer", "all", "20240101")
    return bundles.read_bundle(spark, f"{path}/out")


def order_months(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn(
        "partition_name", F.date_format("o_orderdate", "yyyyMM")
    )


@query(MONTH_FILES_SQL + """
SELECT o.*, strftime(o_orderdate, '%Y%m') AS partition_name FROM orders o
WHERE strftime(o_orderdate, '%Y%m') IN (SELECT partition_name FROM changes WHERE state = 'changed')
""")
def export_auto(spark, sf_dir):
    return exchange.export_auto(order_months(spark, sf_dir), month_changes(spark, sf_dir))


@query(MONTH_FILES_SQL + """
SELECT 'sales.orders' AS table_name, c.partition_name,
       CASE state WHEN 'changed' THEN 'replace' WHEN 'empty' THEN 'truncate' ELSE 'missing' END
         AS action,
       'month = ''' || c.partition_name || '''' AS predicate, '{}' AS schema_json,
       CASE WHEN state = 'changed' THEN files ELSE 0 END AS row_count
FROM changes c WHERE state <> 'unchanged'
""")
def plan_export(spark, sf_dir):
    changes = month_changes(spark, sf_dir)
    rows = exchange.export_auto(order_months(spark, sf_dir), changes)
    counts = rows.groupBy("partition_name").agg(F.count("*").alias("row_count"))
    predicates = changes.select(
        "partition_name",
        F.concat(F.lit("month = '"), "partition_name", F.lit("'")).alias("predicate"),
    )
    return exchange.plan_export(changes, counts, predicates, "sales.orders", "{}")


@query("SELECT * FROM orders WHERE strftime(o_orderdate, '%Y%m%d') >= '19990101' AND o_orderstatus = 'F'")
def export_sql(spark, sf_dir):
    predicate = "date_format(o_orderdate, 'yyyyMMdd') >= '${etl_date}' and o_orderstatus = 'F'"
    return exchange.export_sql(table(spark, sf_dir, "orders"), predicate, "19990101")


@query("""
SELECT concat_ws('#&', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
  CAST(o_totalprice AS VARCHAR), CAST(o_orderdate AS VARCHAR), o_orderpriority,
  strftime(o_orderdate, '%Y%m%d')) AS value
FROM orders WHERE strftime(o_orderdate, '%Y%m%d') = '19980801'
""")
def export_rows(spark, sf_dir):
    return exchange.export_rows(order_days(spark, sf_dir), "auto", "19980801")


@query("""
SELECT concat_ws('#&', CAST(event_id AS VARCHAR), CAST(ts AS VARCHAR),
  CASE WHEN event_type = 'error' THEN NULL ELSE event_type END, props) AS value
FROM events
""")
def export_rows_compat(spark, sf_dir):
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type")
    events = table(spark, sf_dir, "events").select("event_id", "ts", kind, "props")
    return exchange.export_rows(events, "all", "20240101", compat=True)


@query(MONTH_FILES_SQL + """
, staged AS (SELECT o_orderkey, o_custkey, 'N' AS o_orderstatus, o_totalprice, o_orderdate,
                    o_orderpriority, strftime(o_orderdate, '%Y%m') AS partition_name FROM orders)
SELECT o.*, strftime(o_orderdate, '%Y%m') AS partition_name FROM orders o
WHERE strftime(o_orderdate, '%Y%m') NOT IN
      (SELECT partition_name FROM changes WHERE state IN ('changed', 'empty'))
UNION ALL
SELECT * FROM staged
WHERE partition_name IN (SELECT partition_name FROM changes WHERE state = 'changed')
""")
def import_partition(spark, sf_dir):
    tgt = order_months(spark, sf_dir)
    state = F.col("state")
    action = F.when(state == "changed", "replace").when(state == "empty", "truncate")
    actions = month_changes(spark, sf_dir).select("partition_name", action.alias("action"))
    staged = tgt.withColumn("o_orderstatus", F.lit("N"))
    return exchange.import_partition(staged, tgt, actions)


@query("""
WITH flagged AS (
  SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS amount
  FROM orders)
SELECT * FROM flagged WHERE amount <= 200000 OR amount IS NULL
UNION ALL
SELECT o_orderkey, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority, amount
FROM flagged WHERE amount > 200000
""")
def import_sql(spark, sf_dir):
    tgt = table(spark, sf_dir, "orders").withColumn(
        "amount", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice"))
    )
    staged = exchange.export_sql(tgt, "amount > 200000", "20240101")
    staged = staged.withColumn("o_orderstatus", F.lit("N"))
    return exchange.import_sql(staged, tgt, ["amount > 200000"])


# ------------------------------------------------------------------------------------- ledger


def customer_ledger(spark, sf_dir):
    """Orders as a ledger of customers: month, status, batch."""
    status = (
        F.when(F.col("o_orderstatus") == "P", "running")
        .when(F.col("o_orderstatus") == "F", "error")
        .otherwise("success")
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.date_format("o_orderdate", "yyyyMM").alias("etl_date"),
        status.alias("task_status"),
        F.col("o_orderpriority").alias("batch_id"),
        F.col("o_orderdate").alias("end_time"),
        F.col("o_orderkey").alias("id"),
    )


LEDGER_SQL = """
WITH ledger AS (
  SELECT o_custkey AS c_custkey, strftime(o_orderdate, '%Y%m') AS etl_date,
         CASE o_orderstatus WHEN 'P' THEN 'running' WHEN 'F' THEN 'error' ELSE 'success' END
           AS task_status,
         o_orderpriority AS batch_id, o_orderdate AS end_time, o_orderkey AS id
  FROM orders),
latest AS (
  SELECT * FROM ledger
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY end_time DESC, id DESC) = 1)
"""


@query(LEDGER_SQL + """
SELECT * FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM ledger l WHERE l.c_custkey = c.c_custkey AND etl_date = '199808')
""")
def unprocessed(spark, sf_dir):
    return ledger.unprocessed(
        table(spark, sf_dir, "customer"), customer_ledger(spark, sf_dir), ["c_custkey"], "199808"
    )


@query(LEDGER_SQL + """
SELECT * FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM ledger l WHERE l.c_custkey = c.c_custkey
     AND (batch_id = '1-URGENT' OR task_status = 'running') AND etl_date = '199808')
""")
def unprocessed_by_batch(spark, sf_dir):
    return ledger.unprocessed(
        table(spark, sf_dir, "customer"),
        customer_ledger(spark, sf_dir),
        ["c_custkey"],
        "199808",
        scope="1-URGENT",
    )


@query(LEDGER_SQL + "SELECT * FROM latest")
def latest_per_key(spark, sf_dir):
    return ledger.latest_per_key(customer_ledger(spark, sf_dir), ["c_custkey"], "end_time", ["id"])


@query("""
SELECT event_id, ts, user_id, event_type, value, props,
       CASE WHEN event_type = 'click' THEN NULL ELSE ts END AS end_time
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id
  ORDER BY CASE WHEN event_type = 'click' THEN TIMESTAMP '2024-02-01' ELSE ts END DESC,
           event_id DESC) = 1
""")
def latest_event_per_user(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn(
        "end_time", F.when(F.col("event_type") != "click", F.col("ts"))
    )
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return ledger.latest_per_key(events, ["user_id"], "end_time", ["event_id"], now)


@query(LEDGER_SQL + """
SELECT * FROM customer WHERE c_custkey NOT IN
  (SELECT c_custkey FROM latest WHERE task_status <> 'error')
""")
def retryable(spark, sf_dir):
    rows = customer_ledger(spark, sf_dir)
    newest = ledger.latest_per_key(rows, ["c_custkey"], "end_time", ["id"])
    return ledger.retryable(table(spark, sf_dir, "customer"), newest, ["c_custkey"])


@query(LEDGER_SQL + "SELECT * FROM ledger WHERE task_status = 'running' AND etl_date = '199808'")
def in_state(spark, sf_dir):
    return ledger.in_state(customer_ledger(spark, sf_dir), "running", "199808")


@query(LEDGER_SQL + """
SELECT * FROM customer WHERE c_custkey IN (SELECT c_custkey FROM latest WHERE task_status = 'error')
""")
def failed_items(spark, sf_dir):
    rows = customer_ledger(spark, sf_dir)
    newest = ledger.latest_per_key(rows, ["c_custkey"], "end_time", ["id"])
    return ledger.failed_items(
        table(spark, sf_dir, "customer"), newest, ["c_custkey"], failed="error"
    )


def gate_sides(spark, sf_dir):
    """Orders gated by their parts deliveries: lines as upstream, shipped lines as its ledger."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.when(F.col("l_linestatus") == "F", "error").otherwise("success").alias("task_status"),
    )
    upstream = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return (
        table(spark, sf_dir, "orders"),
        upstream.select(F.col("l_orderkey").alias("o_orderkey")),
        lines,
    )


@query("""
SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
  AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus <> 'F')
""")
def gated(spark, sf_dir):
    return ledger.gated(*gate_sides(spark, sf_dir), ["o_orderkey"])


@query("""
SELECT * FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'R')
""")
def gated_by_any(spark, sf_dir):
    return ledger.gated(*gate_sides(spark, sf_dir), ["o_orderkey"], strict=False)


@query("""
SELECT *, concat_ws(',', CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'flag' END,
    CASE WHEN l_linestatus = 'F' AND l_discount = 0 THEN 'discount' END,
    CASE WHEN l_quantity > 45 THEN 'quantity' END) AS reasons
FROM lineitem
""")
def validate_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "given", F.nullif(F.col("l_discount"), F.lit(0.0))
    )
    rules = {
        "flag": ledger.allowed("l_returnflag", ["A", "N"]),
        "discount": ledger.required_if("l_linestatus = 'F'", "given"),
        "quantity": F.col("l_quantity") > 45,
    }
    checked = ledger.validate_rows(lines, rules).drop("given")
    return checked.withColumn("reasons", F.concat_ws(",", "reasons"))


@query("""
SELECT * FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 100
""")
def top_by_priority(spark, sf_dir):
    order = ["o_orderpriority", F.col("o_totalprice").desc(), "o_orderkey"]
    return ledger.top_by_priority(table(spark, sf_dir, "orders"), order, 100)


@query("""
WITH paired AS (
  SELECT event_id, ts, user_id, event_type, props,
         lead(ts) OVER w AS next_ts, lead(event_type) OVER w AS next_event_type
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT *, (epoch_us(next_ts) - epoch_us(ts)) // 1000000 AS used_seconds
FROM paired WHERE event_type = 'view'
""")
def run_durations(spark, sf_dir):
    events = table(spark, sf_dir, "events").drop("value")
    return ledger.run_durations(
        events,
        ["user_id"],
        "ts",
        "event_id",
        carry=["event_type"],
        started="event_type = 'view'",
    )


@query("""
SELECT user_id, min(ts) FILTER (event_type = 'view') AS start_time,
       max(ts) FILTER (event_type <> 'view') AS end_time,
       arg_max(CASE WHEN event_type = 'view' THEN 'running' ELSE event_type END, ts) AS task_status
FROM events GROUP BY user_id
""")
def runs_by_id(spark, sf_dir):
    status = F.when(F.col("event_type") == "view", "running").otherwise(F.col("event_type"))
    events = table(spark, sf_dir, "events").withColumn("task_status", status)
    return ledger.runs_by_id(events, "user_id", "ts", "task_status")


@query("""
SELECT 'key' AS issue_type, '3' AS "level", l_orderkey || '/' || l_linenumber AS subject,
       CAST(count(*) AS VARCHAR) AS detail
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'count', '2', CAST(o_orderkey AS VARCHAR),
       CAST(coalesce(n, 0) - CAST(floor(o_totalprice / 100000) AS BIGINT) AS VARCHAR)
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
  ON o_orderkey = l_orderkey
WHERE coalesce(n, 0) <> floor(o_totalprice / 100000)
""")
def issues(spark, sf_dir):
    keys = schema.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    subject = F.concat_ws("/", "l_orderkey", "l_linenumber")
    counts = loads.reconcile_counts(*line_counts(spark, sf_dir), ["o_orderkey"])
    return ledger.issues(
        keys.select(*ledger.issue("key", "3", subject, F.col("n"))),
        counts.where("status <> 'ok'").select(
            *ledger.issue("count", "2", F.col("o_orderkey"), F.col("diff"))
        ),
    )


@query("""
SELECT l_orderkey, count(*) AS started, count(*) FILTER (l_linestatus = 'F') AS succeeded,
       count(*) = count(*) FILTER (l_linestatus = 'F') AS complete
FROM lineitem GROUP BY l_orderkey
""")
def completion_check(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return ledger.completion_check(lines, ["l_orderkey"], "l_linestatus = 'F'")


# ---------------------------------------------------------------------------------- retention


@query("""
SELECT user_id, event_id, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) > 8
""")
def expired_entries(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return retention.expired_entries(events, 8, "user_id", "event_id", "ts")


@query("""
SELECT event_type, event_id, ts FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) > 1200
""")
def expired_entries_many(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "ts")
    return retention.expired_entries(events, 1200, "event_type", "event_id", "ts")


@query("""
SELECT *, strftime(o_orderdate, '%Y%m%d') AS etl_date FROM orders
WHERE o_orderdate IN (SELECT DISTINCT o_orderdate FROM orders ORDER BY 1 DESC LIMIT 30)
""")
def apply_retention(spark, sf_dir):
    return retention.apply_retention(order_days(spark, sf_dir), 30)
