"""Set operations (U1, U2). Branches are aligned by name, not position."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """SQL ``UNION``: NULLs compare equal when removing duplicates."""
    return union_all(*dfs).distinct()
