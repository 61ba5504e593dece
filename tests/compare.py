"""Run catalog queries on Spark and their SQL on DuckDB, and compare all rows.

Usage: python tests/compare.py FOLDER [QUERY ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 8")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    """Floats by their exact digits, so that -0.0 and 0.0 differ too."""
    return repr(value) if isinstance(value, float) else value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(frame, con, sql: str) -> str | None:
    """What differs between a query's result and its SQL, or None."""
    ours = frame.collect()
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    }
    spark_kinds = {k: kinds.get(t, t) for k, t in frame.dtypes}
    sql_kinds = {d[0]: str(d[1]) for d in theirs.description}
    fetched = theirs.fetchall()
    left, right = rows_of(frame.columns, ours), rows_of(names, fetched)
    if left != right:
        only_left, only_right = list((left - right).items())[:3], list((right - left).items())[:3]
        return f"{len(ours)} != {len(fetched)} rows; Spark only {only_left}; SQL only {only_right}"
    odd = {k: (spark_kinds[k], sql_kinds[k]) for k in spark_kinds if spark_kinds[k] != sql_kinds[k]}
    return f"types {odd}" if odd else None


def main() -> None:
    import __spark_entry__ as entry
    from pairloom.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(folder)
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        if name not in sqls:
            print(f"{name:24s} rows {query(spark, folder).count()} in {time.time() - began:.1f}s", flush=True)
            continue
        try:
            found = difference(query(spark, folder), con, sqls[name])
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24s} {'ok' if found is None else 'DIFFERS ' + str(found)[:900]} {time.time() - began:.1f}s", flush=True)


if __name__ == "__main__":
    main()
