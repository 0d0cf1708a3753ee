"""Compares query results with DuckDB; also runs from the command line."""

import math
import sys
import time
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_KINDS = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
          "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


def database(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


def compare(frame, con, sql):
    """None if names, types and the multiset of rows agree, else what differs."""
    relation = con.sql(sql)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    ours = {name: _KINDS.get(kind, kind) for name, kind in frame.dtypes}
    if ours != theirs:
        return f"schema {ours} vs {theirs}"
    names = sorted(ours)
    left = frame.select(*[f"`{n}`" for n in names]).toArrow()
    right = relation.fetchall()
    order = [relation.columns.index(n) for n in names]
    a = sorted(tuple(map(_cell, row)) for row in _rows(left))
    b = sorted(tuple(_cell(row[i]) for i in order) for row in right)
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{names}: {str(x)[:300]} vs {str(y)[:300]}"
    return None


def _rows(table):
    columns = [column.to_pylist() for column in table.columns]
    return zip(*columns) if columns else []


def main(names):
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    import __spark_entry__ as entry
    from corpuslake.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    spark = local_session()
    con = database(sf_dir)
    todo, sql = entry.queries(), entry.oracle_sql()
    print("without SQL:", sorted(set(todo) - set(sql)), "unknown:", sorted(set(sql) - set(todo)))
    bad = 0
    for name, run in todo.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = run(spark, sf_dir)
            problem = compare(frame, con, sql[name]) if name in sql else f"rows {frame.count()}"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        if problem and not problem.startswith("rows "):
            bad += 1
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(set(sys.argv[1:]))
