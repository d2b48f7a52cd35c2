"""Run registered queries on Spark and their SQL on DuckDB, and compare.

    python -m tests.oracle [folder] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

from scholarmart.suite.roles import TABLES

KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string",
    "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(round(value, 9) + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> tuple[int, list[str]]:
    """Rows on the Spark side and what differs."""
    mine = spark_df.collect()
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    theirs = cursor.fetchall()
    out = []
    if sorted(columns) != sorted(spark_df.columns):
        return len(mine), [f"columns {sorted(spark_df.columns)} against {sorted(columns)}"]
    for name, kind in spark_df.dtypes:
        if KINDS.get(kinds[name], kinds[name]) != kind:
            out.append(f"type of {name}: {kind} against {kinds[name]}")
    a, b = _rows(spark_df.columns, mine), _rows(columns, theirs)
    if len(a) != len(b):
        out.append(f"rows {len(a)} against {len(b)}")
    if a != b:
        left, right = set(a) - set(b), set(b) - set(a)
        out.append(f"values differ: {len(left)} / {len(right)}; {sorted(left)[:2]} against {sorted(right)[:2]}")
    return len(mine), out


def main() -> int:
    import __spark_entry__ as contract
    from scholarmart.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), contract.oracle_sql(), 0
    for name, run in contract.queries().items():
        if wanted and not any(name == w or name.startswith(w + "_") for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in sqls:
                rows, problems = compare(df, con, sqls[name])
            else:
                rows, problems = len(df.collect()), []
            note = "" if name in sqls else " (no SQL)"
        except Exception as error:  # noqa: BLE001
            rows, problems, note = -1, [f"{type(error).__name__}: {str(error)[:700]}"], ""
        bad += bool(problems)
        print(f"{'ok ' if not problems else 'BAD'} {name:28s} {rows:7d} rows {time.time() - start:6.2f}s{note}", *problems, sep="\n      " if problems else "", flush=True)
    print("failed:", bad)
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
