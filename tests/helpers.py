"""Hand-built inputs for unit tests."""

import datetime as dt

from callcredit.sources.schemas import SCHEMAS


def T(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def make_inputs(spark, **tables):
    """Every input of the job as a DataFrame; unspecified ones are empty.

    Each table is given as a list of dicts (missing columns are NULL).
    """
    out = {}
    for name, schema in SCHEMAS.items():
        rows = tables.get(name, [])
        data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
        out[name] = spark.createDataFrame(data, schema)
    return out


def _key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def srt(items):
    """Sort tuples that may hold NULLs (NULL first)."""
    return sorted(items, key=_key)


def rows(df, *cols):
    cols = cols or df.columns
    return srt(tuple(r[c] for c in cols) for r in df.collect())
