"""Runs a query and its SQL over the same tables and compares names, types and rows."""

import datetime
import decimal
import glob
import os

import duckdb


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{source}'")
    return con


def plain(x):
    if isinstance(x, float):
        return float(f"{x:.9g}")
    if isinstance(x, decimal.Decimal):
        return str(x.normalize())
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, datetime.date):
        return x.isoformat()
    return x


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def kinds(spark_types: dict[str, str], duck_types: dict[str, str]) -> list[str]:
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}
    return [f"{c}: {t} and {duck_types.get(c)}" for c, t in spark_types.items() if same.get(t, t.upper()) != duck_types.get(c) and not t.startswith("decimal")]


def compare(spark, con, f, sql: str, sf: str) -> None:
    df = f(spark, sf)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(want), (len(got), len(want))
    wrong = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
    assert not wrong, (len(wrong), sorted(names), wrong[:3])
