"""Compare checked queries with their SQL, row by row.

Run as a script: ``python tests/oracle.py [folder] [query ...]``.
"""

from __future__ import annotations

import collections
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


# The SQL type that goes with a Spark type.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def sql_rows(
    db: duckdb.DuckDBPyConnection, sql: str
) -> tuple[list[str], list[str], list[tuple]]:
    result = db.execute(sql)
    names, types = zip(*[(c[0], str(c[1])) for c in result.description])
    return list(names), list(types), result.fetchall()


def difference(df, columns: list[str], types: list[str], rows: list[tuple]) -> str | None:
    """Why the tables differ, or None."""
    names = sorted(columns)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} <> {names}"
    wanted_types = dict(zip(columns, types))
    for name, dtype in df.dtypes:
        if TYPES.get(dtype) != wanted_types[name]:
            return f"type of {name}: {dtype} <> {wanted_types[name]}"
    order = [columns.index(n) for n in names]
    wanted = collections.Counter(tuple(r[i] for i in order) for r in rows)
    found = collections.Counter(
        tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()
    )
    if wanted == found:
        return None
    missing, extra = wanted - found, found - wanted
    return (
        f"rows {found.total()} <> {wanted.total()}; missing {missing.total()}, e.g."
        f" {str(list(missing)[:2])[:600]}; extra e.g. {str(list(extra)[:2])[:600]}"
    )


def main() -> None:
    from session import local_session

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = local_session()
    db = connect(folder)
    oracles, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in oracles:
                problem = difference(df, *sql_rows(db, oracles[name]))
                verdict = problem or "ok"
            else:
                verdict = f"{df.count()} rows, no SQL"
        except Exception as error:  # report every query
            verdict = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        bad += not (verdict == "ok" or verdict.endswith("no SQL"))
        print(f"{name:24} {time.time() - start:6.2f}s {verdict}", flush=True)
    print("all good" if not bad else f"{bad} bad")


if __name__ == "__main__":
    main()
