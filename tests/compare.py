"""Run registered queries against their SQL counterparts: python tests/compare.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def rows_of(columns, data) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in data)


def differences(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None where both give the same columns, values and number of rows."""
    df = query(spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    relation = con.sql(sql)
    theirs = relation.fetchall()
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} / {sorted(relation.columns)}"
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    sql_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}
    wrong = {n: (t, sql_types[n]) for n, t in spark_types.items() if same.get(t) != sql_types[n]}
    a, b = rows_of(df.columns, ours), rows_of(relation.columns, theirs)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        return f"rows {len(a)} / {len(b)}; ours {only_a[:2]}; theirs {only_b[:2]}; types {wrong}"
    return f"types {wrong}" if wrong else None


def main() -> None:
    import __spark_entry__ as entry
    from starmill.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(master=os.environ.get("COMPARE_MASTER", "local[8]"), **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        start = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            found = differences(spark, con, sf_dir, entry.queries()[name], sql) if sql else "no SQL"
        except Exception as error:  # noqa: BLE001 - a report, not a handler
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24s} {time.time() - start:6.1f}s {'ok' if found is None else 'DIFF ' + found}", flush=True)


if __name__ == "__main__":
    main()
