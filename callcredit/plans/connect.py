"""M1 connected calls and M2 connected clients per month and agent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import rules as R
from ..functions.dates import month_key, months_back_start
from ..operators.joins import validity_join


def qualified_calls(inputs, as_of, rules: R.Rules = R.DEFAULT_RULES) -> DataFrame:
    """Qualified, counted calls since last month joined to the agent version
    valid at call time (shared by M1 and M2)."""
    return _qualified_calls(inputs, as_of, rules, excluded_days=False)


def _qualified_calls(inputs, as_of, rules: R.Rules, excluded_days: bool) -> DataFrame:
    bound = months_back_start(as_of, 1)
    g = inputs["call_log"]
    ts = F.col("time_of_call_start")
    cond = (P.since(ts, bound)
            & P.qualified_call(F.col("durations"), F.col("off_by"))
            & P.counted_call(ts, F.col("call_type"), F.col("custom_data_4"), F.col("name"), rules))
    if excluded_days:
        cond = cond & P.not_on_days(ts, rules.excluded_days)
    calls = g.where(cond).select("time_of_call_start", "resource_name", "cuid",
                                 F.lower("resource_name").alias("_agent"))
    emp = (inputs["employee"].where(F.col("channel").isin(*R.CONNECT_CHANNELS))
           .select("username", "channel", "date_valid_from", "date_valid_to"))
    return validity_join(calls, emp, F.col("_agent") == F.col("username"), ts,
                         F.col("date_valid_from"), F.col("date_valid_to"), as_of)


def connected_calls(inputs, as_of, rules: R.Rules = R.DEFAULT_RULES,
                    joined: DataFrame | None = None) -> DataFrame:
    """M1: qualified calls per month, agent and agent channel (excluded days
    removed). ``joined`` may pass ``qualified_calls(...)`` already computed."""
    if joined is None:
        j = _qualified_calls(inputs, as_of, rules, excluded_days=True)
    else:
        j = joined.where(P.not_on_days(F.col("time_of_call_start"), rules.excluded_days))
    return (j.groupBy(month_key(F.col("time_of_call_start")).alias("month"),
                      F.col("resource_name").alias("username"), "channel")
             .agg(F.count(F.lit(1)).alias("connected"))
             .select("month", "username", "connected", "channel"))


def connected_clients(inputs, as_of, rules: R.Rules = R.DEFAULT_RULES,
                      joined: DataFrame | None = None) -> DataFrame:
    """M2: distinct clients per month and agent (no excluded days)."""
    j = _qualified_calls(inputs, as_of, rules, excluded_days=False) if joined is None else joined
    return (j.groupBy(month_key(F.col("time_of_call_start")).alias("month"),
                      F.col("resource_name").alias("username"))
             .agg(F.count_distinct("cuid").alias("connected_client")))
