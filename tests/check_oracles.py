"""Run registered queries next to their SQL on DuckDB and report differences.

Usage: python tests/check_oracles.py [sf dir] [query name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _sortable(row: tuple) -> tuple:
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= 1e-8 * max(1.0, abs(a)) or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def _exact(rows: list[tuple]) -> list[str]:
    return sorted(repr(r) for r in rows)


def compare(frame, connection, sql: str) -> str | None:
    """None when equal, otherwise what differs. Rows are compared as multisets."""
    columns = sorted(frame.columns)
    spark_rows = [tuple(r[c] for c in columns) for r in frame.collect()]
    relation = connection.sql(sql)
    if sorted(relation.columns) != columns:
        return f"columns {columns} vs {sorted(relation.columns)}"
    index = [relation.columns.index(c) for c in columns]
    duck_rows = [tuple(r[i] for i in index) for r in relation.fetchall()]
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows vs {len(duck_rows)}"
    if _exact(spark_rows) == _exact(duck_rows):
        return None
    pairs = list(zip(sorted(spark_rows, key=_sortable), sorted(duck_rows, key=_sortable)))
    different = [(a, b) for a, b in pairs if not all(_same(x, y) for x, y in zip(a, b))]
    if not different:
        return "equal only within 1e-8"
    a, b = different[0]
    cells = [(c, x, y) for c, x, y in zip(columns, a, b) if not _same(x, y)]
    return f"{len(different)} rows differ, e.g. {cells[:3]}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    from cohortspark.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = get_session("check", "local[8]", spark_ui_enabled="false", spark_ui_showConsoleProgress="false", spark_sql_shuffle_partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    connection, failures = connect(sf_dir), 0
    oracles = oracle_sql()
    for name, build in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            frame = build(spark, sf_dir)
            if name in oracles:
                problem, kind = compare(frame, connection, oracles[name]), "V"
            else:
                problem, kind = (None if frame.count() else "no rows"), "R"
        except Exception as error:  # report and go on with the next query
            problem, kind = f"{type(error).__name__}: {str(error)[:600]}", "E"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failures} failures")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
