"""Compare registered queries with their SQL in DuckDB.

``python -m tests.oracle [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path("/root/testdata")


def connect(folder: str):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark, con, folder: str, name: str, fn, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    df = fn(spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            columns = sorted(names)
            wrong = [(c, x, y) for c, x, y in zip(columns, a, b) if x != y]
            return f"{sum(x != y for x, y in zip(mine, theirs))} rows differ, first {wrong[:6]} in {a[:5]}"
    return None


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from martflow.session import build_session

    folder = argv[0] if argv else str(ROOT / "sf0.01")
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(queries)
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, folder, name, queries[name], oracles[name])
            else:
                problem = f"(no SQL) {queries[name](spark, folder).count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None and not problem.startswith("(no SQL)")
        print(f"{name:34s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{bad} of {len(names)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
