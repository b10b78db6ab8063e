import pytest
from pyspark.sql import types as T

from conftest import rows_of
from granary.operators import schema

DDL = """
create table SALES.Orders
(
  order_id     NUMBER(10) not null,
  amount       NUMBER(10,2),
  note         VARCHAR2(50) default 'x, y',
  "Opened"     date,
  primary key (order_id, note)
);
comment on table SALES.Orders is 'All orders';
comment on column SALES.Orders.amount is 'Amount; in cents';
"""


def test_extract_schema(spark):
    df = spark.createDataFrame([("f1", DDL), ("f2", "create table t (\r\n a number,\r\n b date\r\n)")], "path string, value string")
    got = schema.extract_schema(df).orderBy("path", "pos")
    assert [tuple(r) for r in got.select("path", "table_name", "pos", "column_name", "column_type", "is_key", "comment").collect()] == [
        ("f1", "sales.orders", 0, "order_id", "number(10)", True, None),
        ("f1", "sales.orders", 1, "amount", "number(10,2)", False, "amount; in cents"),
        ("f1", "sales.orders", 2, "note", "varchar2(50)", True, None),
        ("f1", "sales.orders", 3, "opened", "date", False, None),
        ("f2", "t", 0, "a", "number", False, None),
        ("f2", "t", 1, "b", "date", False, None),
    ]
    assert got.first().table_comment == "all orders"


def test_spark_schema():
    got = schema.spark_schema([("a", "number(10,2)", "money"), ("b", "date", None)])
    assert got["a"].dataType == T.DecimalType(12, 2) and got["a"].metadata == {"comment": "money"}


def test_drift(spark):
    reg = spark.createDataFrame(
        [("same", 0, "a", "x"), ("gone", 0, "a", "x"), ("gone", 1, "b", "x"), ("more", 0, "a", "x"),
         ("renamed", 0, "a", "x"), ("retyped", 0, "a", "x")],
        "table_name string, pos int, column_name string, column_type string")
    cur = spark.createDataFrame(
        [("same", 0, "a", "x"), ("gone", 0, "a", "x"), ("more", 0, "a", "x"), ("more", 1, "b", "x"),
         ("renamed", 0, "z", "x"), ("retyped", 0, "a", "y"), ("first", 0, "a", "x")],
        "table_name string, pos int, column_name string, column_type string")
    got = rows_of(schema.drift_verdict(schema.schema_drift(cur, reg)))
    assert got == [("first", "initial", None, 1), ("gone", "error", 1, 0), ("more", "appended", None, 1),
                   ("renamed", "error", 0, 0), ("retyped", "error", 0, 0), ("same", "same", None, 0)]


def struct(text):
    return T.DataType.fromDDL(text)


def test_agreed_schema():
    target = struct("a int, b varchar(5)")
    assert schema.agreed_schema(struct("A int, b varchar(9)"), target) == struct("a int, b varchar(9)")
    assert schema.agreed_schema(struct("a int, b varchar(5), c date"), target).names == ["a", "b", "c"]
    assert schema.agreed_schema(struct("a int, x int, b varchar(5)"), target, ["X"]).names == ["a", "b"]
    for bad in ("a int", "a int, z varchar(5)", "a bigint, b varchar(5)"):
        with pytest.raises(ValueError):
            schema.agreed_schema(struct(bad), target)


def test_cast_failures_are_named(spark):
    df = spark.createDataFrame([("1", "x"), ("y", None), (None, "2.345")], "a string, b string")
    got = schema.cast_to_target(df, [("a", "number"), ("b", "number(3,2)")], failed="bad")
    assert [[str(v) for v in r] for r in got.collect()] == [
        ["1", "None", "['b']"], ["None", "None", "['a']"], ["None", "2.35", "[]"]]


def test_evolve_is_idempotent(spark):
    fields = struct("id bigint, extra string").fields
    once = schema.evolve_add_columns(spark.range(2), fields)
    assert schema.evolve_add_columns(once, fields).columns == ["id", "extra"]


def test_last_comment_wins_and_lines_may_lead(spark):
    ddl = "-- made by hand\n\ncreate table a.t (\n x int,\n y varchar(3)\n);\ncomment on column a.t.x is 'one';\ncomment on column a.t.x is 'two';\ncomment on table a.t is 'old';\ncomment on table a.t is 'new';"
    rows = schema.extract_schema(spark.createDataFrame([(ddl,), ("select 1",)], "value string")).collect()
    assert [(r.table_name, r.column_name, r.comment, r.table_comment) for r in rows] == [("a.t", "x", "two", "new"), ("a.t", "y", None, "new")]
