"""Usage aggregates over matched card transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import counted_usage_time

MONEY_SUM = "decimal(38,2)"


def usage_measures(amount: Column, ts: Column, merchant: Column, cutover,
                   total: str | None = "distinct", count_name: str = "num_transaction") -> list[Column]:
    """Sum, counted-usage count, first usage and (optionally) transaction count.

    ``total`` selects ``count(distinct ts)`` ("distinct", card usage),
    ``count(ts)`` ("count", BNPL usage) or no count (None).
    """
    out = [
        F.sum(amount).cast(MONEY_SUM).alias("total_amount"),
        F.count(counted_usage_time(ts, merchant, cutover)).alias(count_name),
        F.min(ts).alias("first_usage_date"),
    ]
    if total == "distinct":
        out.append(F.count_distinct(ts).alias("total_transaction"))
    elif total == "count":
        out.append(F.count(ts).alias("total_transaction"))
    return out


def usage_summary(df: DataFrame, keys: list[str], amount: str, ts: str, merchant: str,
                  cutover, total: str | None = "distinct",
                  count_name: str = "num_transaction") -> DataFrame:
    """Collapse identical (merchant, amount, time) rows per key, then aggregate."""
    dedup = df.select(*keys, merchant, amount, ts).distinct()
    return dedup.groupBy(*keys).agg(*usage_measures(F.col(amount), F.col(ts), F.col(merchant), cutover,
                                                    total, count_name))
