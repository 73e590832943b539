"""Run queries next to their SQL twins and report differences.

``python -m querybook.compare <sf_dir> [query ...]``
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from querybook.oracles import SQL
from querybook.queries import QUERIES


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def differences(spark, con, sf: str, name: str) -> list[str]:
    """Empty when both sides agree in columns, rows and every value."""
    df = QUERIES[name](spark, sf)
    got, columns = [tuple(r) for r in df.collect()], df.columns
    result = con.execute(SQL[name])
    expected_columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(expected_columns):
        return [f"columns {columns} against {expected_columns}"]
    left, right = _rows(columns, got), _rows(expected_columns, expected)
    if len(left) != len(right):
        return [f"{len(left)} rows against {len(right)}"]
    unlike = [(a, b) for a, b in zip(left, right) if repr(a) != repr(b)]
    return [f"{len(unlike)} of {len(left)} rows, first {a} against {b}" for a, b in unlike[:1]]


def main(sf: str, names: list[str]) -> int:
    from reviewlens.session import local_session

    spark, con, failed = local_session("/tmp/checkpoints"), connect(sf), 0
    for name in names or SQL:
        start = time.time()
        try:
            found = differences(spark, con, sf, name)
        except Exception as error:  # report and go on to the next query
            found = [f"{type(error).__name__}: {str(error)[:500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':5s}{name:28s}{time.time() - start:7.2f}s {' '.join(found)}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
