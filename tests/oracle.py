"""Compare registered queries with their SQL in DuckDB.

Run as ``python tests/oracle.py [sf_dir] [query ...]`` for a report.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

SF = "/root/testdata/sf0.01"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str, queries: dict, oracles: dict) -> str | None:
    """None when equal, else what differs."""
    df = queries[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(oracles[name])
    columns = [d[0] for d in cur.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = rows_of(columns, cur.fetchall())
    if got == want:
        return None
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())}; "
        f"only here {list((got - want).items())[:3]}; only expected {list((want - got).items())[:3]}"
    )


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from __spark_entry__ import oracle_sql, queries
    from millrace import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else SF
    spark = build_session(
        "oracle",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.driver.host": "localhost", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in sys.argv[2:] or list(queries()):
        start = time.time()
        try:
            if name in oracle_sql():
                problem = compare(spark, con, sf_dir, name, queries(), oracle_sql())
            else:
                count = queries()[name](spark, sf_dir).count()
                problem = None if count else "no rows"
        except Exception as error:  # reported per query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
