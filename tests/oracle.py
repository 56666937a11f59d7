"""Run a query in Spark and its oracle in DuckDB and compare the rows, order aside."""

import datetime
import glob
import math
import os

import duckdb


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(row[i]) for i in order] for row in rows), key=repr)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR",
    "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN",
}


def compare(df, con, sql):
    """Problems as a list of texts; empty when both sides agree."""
    cursor = con.execute(sql)
    duck_cols = [d[0] for d in cursor.description]
    kinds = dict(zip(duck_cols, [str(d[1]) for d in cursor.description]))
    expected = canonical(duck_cols, cursor.fetchall())
    found = canonical(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if sorted(duck_cols) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(duck_cols)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name] and kinds[name] not in ("STRING", "NUMBER", "BOOL"):
            problems.append(f"type of {name}: {kind} vs {kinds[name]}")
    if len(expected) != len(found):
        problems.append(f"rows {len(found)} != {len(expected)}")
    elif expected != found:
        first = next((f, e) for f, e in zip(found, expected) if f != e)
        problems.append(f"first difference: spark {first[0]} duckdb {first[1]}")
    if not found:
        problems.append("no rows")
    return problems
