"""Run a registered query and its SQL side by side and compare schema, count and values."""

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Spark and DuckDB type names that mean the same.
KINDS = {
    "bigint": "int64", "int": "int32", "double": "double", "string": "text", "boolean": "bool",
    "BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "double", "VARCHAR": "text", "BOOLEAN": "bool",
}


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def check(df, con, sql):
    got_types = {c: KINDS.get(t, t) for c, t in df.dtypes}
    rel = con.sql(sql)
    want_types = {c: KINDS.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert got_types == want_types
    got = normal([tuple(r) for r in df.collect()], df.columns)
    want = normal(rel.fetchall(), rel.columns)
    assert len(got) == len(want)
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, different[:5]
    return len(got)
