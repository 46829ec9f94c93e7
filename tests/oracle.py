"""Compare registered queries with their SQL in DuckDB: `python tests/oracle.py <folder> [name part …]`."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, int):
        return f"i:{value}"
    if isinstance(value, float):
        return f"f:{value + 0.0!r}"
    if isinstance(value, decimal.Decimal):
        return f"d:{value.normalize()}"
    if isinstance(value, dt.datetime):
        return f"t:{value.replace(tzinfo=None).isoformat()}"
    if isinstance(value, dt.date):
        return f"t:{value.isoformat()}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return f"s:{value}"


def rows_of(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(rec[i]) for i in order) for rec in records)


WIDTHS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]",
}


def compare(spark, con, folder, name, run, sql) -> str:
    """Empty when the results agree, else what differs."""
    df = run(spark, folder)
    ours, theirs = df.collect(), con.execute(sql)
    described = {d[0]: str(d[1]) for d in theirs.description}
    names_b, rows_b = rows_of(list(described), theirs.fetchall())
    names_a, rows_a = rows_of(df.columns, [tuple(x) for x in ours])
    if names_a != names_b:
        return f"columns {names_a} vs {names_b}"
    for column, kind in df.dtypes:
        if WIDTHS.get(kind) != described[column]:
            return f"type of {column}: {kind} vs {described[column]}"
    if len(rows_a) != len(rows_b):
        return f"{len(rows_a)} rows vs {len(rows_b)}"
    if rows_a != rows_b:
        bad = [(x, y) for x, y in zip(rows_a, rows_b) if x != y]
        return f"{len(bad)} rows differ, e.g. {names_a}\n   {bad[0][0]}\n   {bad[0][1]}"
    return "" if rows_a else "both empty"


def main(folder: str, parts: list[str]) -> int:
    import __spark_entry__ as entry
    from stockloom.session import local_session

    spark, con, sql = local_session(), connect(folder), entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, folder, name, run, sql[name])
                note = "same"
            else:
                problem, note = "", f"{len(run(spark, folder).collect())} rows, no SQL"
        except Exception as e:  # noqa: BLE001 - the report goes on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(problem)
        print(f"{time.time() - start:6.1f}s {name}: {('DIFFERS ' + problem) if problem else note}", flush=True)
    print(f"{failed} problems")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
