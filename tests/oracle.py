"""Spark results against DuckDB's on the same tables."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def rows(names, found):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(r[k] for k in order) for r in found), key=repr)


def difference(spark, con, query, sql, sf):
    """None if both give the same rows; else what differs."""
    df = query(spark, sf)
    ours = rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    return next((f"{a} and {b}" for a, b in zip(ours, theirs, strict=True) if a != b), None)
