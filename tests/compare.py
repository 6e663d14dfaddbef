"""Run a query on Spark and its SQL on the checking engine, and compare rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def checking_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def spark_rows(df):
    cols = sorted(df.columns)
    kinds = {n: t for n, t in df.dtypes}
    rows = [tuple(_plain(r[c]) for c in cols) for r in df.collect()]
    return cols, [kinds[c] for c in cols], sorted(rows, key=repr)


def check_rows(con, sql):
    kinds = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in rel.fetchall()]
    return sorted(names), [kinds[n] for n in sorted(names)], sorted(rows, key=repr)


SAME_KIND = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def differences(spark, con, sf_dir, run, sql) -> list[str]:
    """Human-readable differences; empty when both sides agree."""
    cols, kinds, left = spark_rows(run(spark, sf_dir))
    names, check_kinds, right = check_rows(con, sql)
    out = []
    if cols != names:
        return [f"columns {cols} != {names}"]
    for c, k, d in zip(cols, kinds, check_kinds):
        if d != SAME_KIND.get(k, k):
            out.append(f"type of {c}: {k} != {d}")
    if len(left) != len(right):
        out.append(f"rows {len(left)} != {len(right)}")
    if left != right:
        only_l = [r for r in left if r not in set(right)][:3] if len(left) < 200000 else []
        only_r = [r for r in right if r not in set(left)][:3] if len(right) < 200000 else []
        out.append(f"columns {cols}; only spark {only_l}; only sql {only_r}")
    return out
