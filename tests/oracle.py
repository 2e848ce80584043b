"""Compare a registered query with its SQL counterpart in DuckDB."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

TESTDATA = "/root/testdata"


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_plain(r[i]) for i in order) for r in rows])


SAME_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def compare(spark, con, query, folder: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = query.run(spark, folder)
    left_names, left = _sorted([tuple(r) for r in df.collect()], df.columns)
    cursor = con.execute(query.sql)
    names = [d[0] for d in cursor.description]
    right_names, right = _sorted(cursor.fetchall(), names)
    if left_names != right_names:
        return f"columns {left_names} vs {right_names}"
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {query.sql}").fetchall()}
    for name, kind in df.dtypes:
        if SAME_TYPES.get(kind, kind.upper()) != types[name]:
            return f"type of {name}: {kind} vs {types[name]}"
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}; {left[:2]} vs {right[:2]}"
    for a, b in zip(left, right):
        if a != b:
            return f"rows differ ({left_names}): {a} vs {b}"
    return None


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tidemark.queries import REGISTRY
    from tidemark.session import local_session

    folder = f"{TESTDATA}/{os.environ.get('SF', 'sf0.01')}"
    spark, con = local_session(8), connect(folder)
    wanted = sys.argv[1:]
    bad = 0
    for name, query in REGISTRY.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if query.sql is None:
                result = f"rows only: {query.run(spark, folder).count()}"
            else:
                result = compare(spark, con, query, folder)
        except Exception as exc:  # noqa: BLE001
            result = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += result is not None and query.sql is not None
        print(f"{'ok ' if result is None else 'BAD'} {name} {time.time() - start:.2f}s {result or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
