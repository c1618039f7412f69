"""Run a registered query and its SQL on the same files and compare names, rows and values."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    return float(f"{float(value):.10g}")


def key(row):
    return tuple((v is None, str(v)) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(([plain(r[n]) for n in names] for r in df.collect()), key=key)


def oracle_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, sorted(([plain(r[i]) for i in order] for r in result.fetchall()), key=key)


def type_family(name: str) -> str:
    name = name.lower()
    for family, words in {
        "int": ("bigint", "integer", "int"), "float": ("double", "float"), "text": ("string", "varchar"),
        "date": ("date",), "time": ("timestamp",),
    }.items():
        if any(name.startswith(w) for w in words):
            return family
    return name


def schema_differences(df, con, sql) -> list[str]:
    other = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        f"{n}: {t} / {other.get(n)}" for n, t in df.dtypes if type_family(t) != type_family(str(other.get(n)))
    ]
