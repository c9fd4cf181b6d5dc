"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def kind(sql_type: str) -> str:
    t = str(sql_type).lower()
    aliases = {"integer": "int", "long": "bigint", "varchar": "string", "bool": "boolean"}
    return aliases.get(t, t)


def difference(spark_df, con, sql: str) -> str | None:
    """None when names, types and rows agree, else a description of the first difference."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: kind(c[1]) for c in result.description}
    want = result.fetchall()
    columns = sorted(names)
    if columns != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {columns}"
    ours = {f.name: kind(f.dataType.simpleString()) for f in spark_df.schema.fields}
    if ours != types:
        return f"types {[(c, ours[c], types[c]) for c in columns if ours[c] != types[c]]}"
    order = [names.index(c) for c in columns]
    key = lambda row: tuple((v is None, str(v)) for v in row)
    expected = sorted((tuple(r[i] for i in order) for r in want), key=key)
    got = sorted((tuple(r) for r in spark_df.select(*columns).collect()), key=key)
    if got == expected:
        return None
    extra = [r for r in got if r not in set(expected)][:3]
    lacking = [r for r in expected if r not in set(got)][:3]
    return f"{len(got)} rows against {len(expected)}; {columns}; only ours {extra}; only theirs {lacking}"
