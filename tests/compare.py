"""Running a query and its SQL twin and comparing the results."""

from __future__ import annotations

import math
import os

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r)
    )


def difference(spark_df, con, sql):
    """None when both give the same rows, else a description."""
    cols, rows = canonical(spark_df.columns, spark_df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_cols, want = canonical(names, cur.fetchall())
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    if len(rows) != len(want):
        return f"{len(rows)} rows != {len(want)}"
    bad = [(a, b) for a, b in zip(rows, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(rows)} rows differ, first {bad[0]}"
    types = [type(x) for x in rows[0]] if rows else []
    want_types = [type(x) for x in want[0]] if want else []
    if any(a is not b for a, b in zip(types, want_types) if type(None) not in (a, b)):
        return f"types {types} != {want_types}"
    return None
