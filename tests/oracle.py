"""Compare registered queries with their SQL on the same Parquet tables.

python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

KINDS = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "TIMESTAMP": "timestamp",
    "BOOLEAN": "boolean",
}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, run, sql: str) -> str | None:
    """None if equal, else what differs."""
    df = run(spark, sf_dir)
    result = con.sql(sql)
    expected_types = {c: KINDS.get(str(t), str(t)) for c, t in zip(result.columns, result.types, strict=True)}
    types = {f.name: f.dataType.simpleString().replace("_ntz", "") for f in df.schema.fields}
    if types != expected_types:
        return f"schema {types} expected {expected_types}"
    got, want = rows_of(df.columns, [tuple(r) for r in df.collect()]), rows_of(result.columns, result.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    wrong = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    from panelweave.session import local_session
    from panelweave.workload import QUERIES, SQL

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in SQL:
                problem = compare(spark, con, sf_dir, QUERIES[name], SQL[name])
            else:
                problem = None if QUERIES[name](spark, sf_dir).count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        failed += problem is not None
        print(f"{name:32} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{len(names)} queries, {failed} failed")


if __name__ == "__main__":
    main()
