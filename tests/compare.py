"""Run registered queries and their oracle SQL on the same tables and compare the rows.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return repr(value) if isinstance(value, (list, dict)) else value


def differences(spark, con, name: str, sf_dir: str) -> list[str]:
    """What is wrong with a query's answer; nothing when it agrees."""
    import __spark_entry__ as e

    df = e.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(tuple(cell(row[c]) for c in columns) for row in df.collect())
    result = con.execute(e.oracle_sql()[name])
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    if sorted(names) != columns:
        return [f"columns {columns} against {sorted(names)}"]
    want = Counter(tuple(cell(row[i]) for i in order) for row in result.fetchall())
    if got == want:
        return [] if got else ["no rows"]
    extra, lost = got - want, want - got
    return [f"{sum(got.values())} against {sum(want.values())} rows",
            f"only here {list(extra.items())[:3]}", f"only there {list(lost.items())[:3]}"]


def main() -> int:
    from granary.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as e

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or e.queries():
        began = time.time()
        try:
            found = differences(spark, con, name, sf_dir)
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - began:.1f}s", *found, sep="\n     " if found else " ", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or e.queries())} differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
