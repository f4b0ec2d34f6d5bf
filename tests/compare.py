"""Run registered queries next to their SQL and compare them value by value.

``python tests/compare.py SF [NAME ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
# A Spark type and the type the database gives the same column.
SAME_TYPE = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
}


def database(folder: Path) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _sort_key(row):
    return [(value is None, str(type(value)), value if value is not None else 0) for value in row]


def differences(spark_df, connection, sql: str) -> list[str]:
    """What differs between a Spark result and a SQL result; empty if nothing."""
    names = sorted(spark_df.columns)
    relation = connection.sql(sql)
    found = []
    if sorted(relation.columns) != names:
        return [f"columns {names} against {sorted(relation.columns)}"]
    types = dict(zip(relation.columns, map(str, relation.types)))
    for name, spark_type in spark_df.dtypes:
        if types[name] not in SAME_TYPE[spark_type]:
            found.append(f"type of {name}: {spark_type} against {types[name]}")
    ours = sorted((tuple(row) for row in spark_df.select(*names).collect()), key=_sort_key)
    chosen = ", ".join(f'"{name}"' for name in names)
    theirs = sorted(connection.execute(f"SELECT {chosen} FROM ({sql})").fetchall(), key=_sort_key)
    if len(ours) != len(theirs):
        return found + [f"{len(ours)} rows against {len(theirs)}"]
    if not ours:
        found.append("no rows")
    for mine, other in zip(ours, theirs):
        same = all(
            a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))
            for a, b in zip(mine, other)
        )
        if not same:
            return found + [f"{str(mine)[:300]} against {str(other)[:300]}"]
    return found


def main(scale: str, names: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries
    from talkweave.session import build_session, clear_scratch

    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = TESTDATA / f"sf{scale}"
    connection = database(folder)
    oracle = oracle_sql()
    for name, run in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            result = run(spark, str(folder))
            if name in oracle:
                verdict = differences(result, connection, oracle[name]) or "same"
            else:
                verdict = f"{result.count()} rows, no SQL"
        except Exception as error:  # report it and go on to the next query
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:38} {time.time() - started:6.1f}s  {verdict}", flush=True)
    clear_scratch(spark)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
