"""Run registered queries in Spark and their SQL in DuckDB and compare the results.

    python -m checks.compare_results <sf_dir> [name ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from typing import Any

from checks.base import CHECKS, TABLES, Check


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v: Any) -> str:
    if v is None:
        return "<null>"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "<nan>" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, check: Check, sf_dir: str) -> tuple[bool, str]:
    """(same, explanation) for one query."""
    df = check.query(spark, sf_dir)
    got_columns = df.columns
    nested = [n for n, t in df.dtypes if t.startswith(("array", "map", "struct", "variant", "decimal"))]
    if nested:
        return False, f"nested or decimal output: {nested}"
    got = [tuple(r) for r in df.collect()]
    if check.sql is None:
        return len(got) > 0, f"{len(got)} rows, no SQL"
    cursor = con.execute(check.sql)
    want_columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return False, f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    a, b = _rows(got_columns, got), _rows(want_columns, want)
    if a != b:
        only_a = [x for x in a if x not in set(b)][:3]
        only_b = [x for x in b if x not in set(a)][:3]
        return False, f"rows {len(a)} vs {len(b)}; spark only {only_a}; sql only {only_b}; {sorted(got_columns)}"
    return len(a) > 0, f"{len(a)} rows"


def main() -> None:
    import checks.catalog  # noqa: F401
    from inventrace import session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = session.build("local[8]", 8, "compare", tempfile.mkdtemp(prefix="compare-"))
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf_dir)
    bad = 0
    for name in names or CHECKS:
        start = time.time()
        try:
            ok, why = compare(spark, con, CHECKS[name], sf_dir)
        except Exception as e:  # report and go on with the next query
            ok, why = False, f"{type(e).__name__}: {str(e)[:700]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {why}", flush=True)
    print(f"{len(names or CHECKS)} queries, {bad} failed")


if __name__ == "__main__":
    main()
