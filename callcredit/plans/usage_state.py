"""Mergeable state of distinct withdrawal times (A6 in M10).

M10 counts the distinct withdrawal times of an account since a signature, over
years. The state keeps, for every account and day, the sorted distinct times of
that day; times of different days differ, so counts of days add up, and a day's
times are the merge of what any runs have seen of it. A refresh reads only the
transactions of the days since its last run, and LATE_DAYS before it for rows
that came late, and replaces just those days of the state. M10 then adds up a
number a day, and looks into the times of the signature's own day only.

The state is a versioned table partitioned by day (K1). A day's array has at
most a time a second, as the source's times do.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.dates import as_datetime, day_floor, ts_lit
from ..operators.joins import contract_accounts
from ..sources import sinks, versions

LATE_DAYS = 7
TIME = "dtime_auth_transaction"


def withdrawal_times(inputs, since) -> DataFrame:
    """(skp_card_account, times, n_times, day) of the withdrawals from ``since`` on."""
    t = F.col(TIME)
    seen = (inputs["card_txn"].where((F.col("code_card_transaction_group") == R.WITHDRAWAL) & (t >= ts_lit(since)))
            .select("skp_card_account", t.alias("t"), F.date_format(t, "yyyy-MM-dd").alias("day")))
    days = seen.groupBy("skp_card_account", "day").agg(F.sort_array(F.collect_set("t")).alias("times"))
    # Few files a day, and a large day in several.
    return days.select("skp_card_account", "times", F.size("times").cast("long").alias("n_times"), "day").hint("rebalance", F.col("day"))


def refresh_times(spark: SparkSession, inputs, path: str, as_of, rules: R.Rules = R.DEFAULT_RULES, late_days: int = LATE_DAYS,
                  note: dict | None = None) -> DataFrame:
    """Brings the state at ``path`` up to ``as_of``; returns it.

    The first run reads everything since the earliest signature. A state that
    was made for another earliest signature, or later than ``as_of``, is made anew.
    """
    since = day_floor(rules.earliest_sign)
    now = versions.current(spark, path)
    held = now.note if now else {}
    goes_on = held.get("earliest") == str(since) and as_datetime(held["as_of"]) <= as_datetime(as_of)
    if goes_on:
        since = max(since, day_floor(held["as_of"]) - dt.timedelta(days=late_days))
    first = since.date().isoformat()
    sinks.replace_window(withdrawal_times(inputs, since), path, "day", lambda v: not goes_on or v >= first,
                         note=(note or {}) | {"as_of": str(as_of), "earliest": str(day_floor(rules.earliest_sign))})
    return sinks.read_table(spark, path)


def times_since(pairs: DataFrame, times: DataFrame, inputs) -> DataFrame:
    """(contract_code, sign_date, total_transaction): distinct withdrawal times of
    each pair's account since its signature; pairs without any are left out."""
    t = times.withColumnRenamed("skp_card_account", "_times_account").hint("merge")
    own_day, day = F.date_format("sign_date", "yyyy-MM-dd"), F.col("day")
    accounts = contract_accounts(pairs, "contract_code", inputs["contract_dim"], inputs["card_account"])
    met = accounts.join(t, (F.col("skp_card_account") == F.col("_times_account")) & (day >= own_day))
    later = F.when(day > own_day, F.col("n_times")).otherwise(
        F.size(F.filter("times", lambda x: x >= F.col("sign_date"))).cast("long"))
    # An account of one contract: its days are disjoint. Several accounts may share times, so those are told apart below.
    per_account = met.groupBy("contract_code", "sign_date", "skp_card_account").agg(F.sum(later).alias("n"))
    single = per_account.groupBy("contract_code", "sign_date").agg(F.sum("n").alias("total_transaction"), F.count(F.lit(1)).alias("_accounts"))
    shared = single.where("_accounts > 1").select("contract_code", "sign_date")
    merged = (
        met.join(shared, ["contract_code", "sign_date"], "left_semi")
        .select("contract_code", "sign_date", F.explode(F.filter("times", lambda x: x >= F.col("sign_date"))).alias("t"))
        .groupBy("contract_code", "sign_date").agg(F.count_distinct("t").alias("total_transaction")))
    return single.where((F.col("_accounts") == 1) & (F.col("total_transaction") > 0)).drop("_accounts").unionByName(merged)
