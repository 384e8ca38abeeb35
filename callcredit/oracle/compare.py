"""Compare a Spark result with a DuckDB oracle result (row count, columns,
order-insensitive multiset of normalised values)."""

from __future__ import annotations

import collections
import datetime as dt
import decimal

TEST_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral_value() else format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, int):
        return str(v)
    return str(v)


def compare(spark_df, sql: str, con) -> dict:
    cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_cols": sorted(cols), "oracle_cols": sorted(d_cols)}
    out["schema_match"] = sorted(cols) == sorted(d_cols)
    if not out["schema_match"]:
        out["match"] = False
        return out
    s_order = sorted(range(len(cols)), key=lambda i: cols[i])
    d_idx = {c: i for i, c in enumerate(d_cols)}
    d_order = [d_idx[cols[i]] for i in s_order]
    sc = collections.Counter(tuple(_norm(r[i]) for i in s_order) for r in s_rows)
    dc = collections.Counter(tuple(_norm(r[i]) for i in d_order) for r in d_rows)
    out["match"] = sc == dc
    if not out["match"]:
        out["only_spark"] = list((sc - dc).items())[:5]
        out["only_oracle"] = list((dc - sc).items())[:5]
    return out
