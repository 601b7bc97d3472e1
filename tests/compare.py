"""Run registered queries beside their DuckDB text and compare names, types and rows.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SOURCES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN",
}


def database(sf_dir: str):
    con = duckdb.connect()
    for name in SOURCES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, Decimal):
        return round(float(value), 6)
    return value


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, text: str) -> str | None:
    """What differs between a DataFrame and a query text, None if nothing does."""
    cursor = con.execute(text)
    expected_names = [d[0] for d in cursor.description]
    expected_types = {d[0]: str(d[1]) for d in cursor.description}
    expected = rows_of(cursor.fetchall(), expected_names)
    if sorted(df.columns) != sorted(expected_names):
        return f"columns {sorted(df.columns)} / {sorted(expected_names)}"
    for field in df.schema:
        want = TYPES.get(field.dataType.simpleString(), field.dataType.simpleString().upper())
        if want != expected_types[field.name]:
            return f"type of {field.name}: {want} / {expected_types[field.name]}"
    got = rows_of(df.collect(), df.columns)
    if got != expected:
        missing = [r for r in expected if r not in set(got)][:2]
        extra = [r for r in got if r not in set(expected)][:2]
        return f"{len(got)} / {len(expected)} rows; missing {missing}; extra {extra}"
    return None


def main():
    import __spark_entry__ as entry
    from tests.conftest import session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark, con = session(), database(sf_dir)
    queries, texts = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args or queries:
        started = time.time()
        df = queries[name](spark, sf_dir)
        try:
            found = difference(df, con, texts[name]) if name in texts else None
        except duckdb.Error as error:
            found = f"check: {error}"
        rows = df.count() if found is None else -1
        failed += found is not None
        note = "" if name in texts else " (rows only)"
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {rows} rows {time.time() - started:.1f}s{note} {found or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
