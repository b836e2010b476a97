"""Compare catalogue queries with their SQL: column names, row counts, values.

Also a script: ``python tests/oracle.py [sf_dir] [query ...]``.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


# Spark and DuckDB names of the column types the catalogue gives.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    types = {column[0]: str(column[1]) for column in cursor.description}
    wrong = {n: (t, types.get(n)) for n, t in df.dtypes if SAME_TYPE[t] != types.get(n)}
    if wrong:
        return f"types {wrong}"
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    places = [names.index(name) for name in order]
    want = sorted((tuple(row[i] for i in places) for row in expected), key=repr)
    got = sorted((tuple(row) for row in df.select(*order).collect()), key=repr)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for mine, other in zip(got, want):
        if mine != other or [type(v) for v in mine] != [type(v) for v in other]:
            return f"{str(mine)[:300]} != {str(other)[:300]}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from fettle.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, failed = duck(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            df = query(spark, sf_dir)
            problem = difference(df, connection, sqls[name]) if name in sqls else (
                None if df.count() else "no rows")
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - began:6.2f}s  {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
