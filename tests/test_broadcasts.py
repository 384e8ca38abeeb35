"""What joins broadcast: no side that is small as compressed files only."""

import pytest
from pyspark.sql import functions as F

from callcredit.functions.dates import plus_days
from callcredit.operators.joins import band_join, contract_accounts
from callcredit.session import apply_session_conf

START = "timestamp_ntz'2024-01-01 00:00:00'"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Calls, sign-ups and contracts as files of a few MB, far below their size in memory."""
    base = tmp_path_factory.mktemp("broadcasts")
    ids = spark.range(0, 1_200_000, numPartitions=4)
    ids.selectExpr("id * 7919 % 400000 AS cuid", f"timestampadd(MINUTE, cast(id % 40000 AS int), {START}) AS at",
                   "concat('AGENT', id % 50) AS agent").write.parquet(f"{base}/calls")
    ids.where("id < 400000").selectExpr("id * 7919 % 400000 AS client", f"timestampadd(DAY, cast(5 + id % 20 AS int), {START}) AS since").write.parquet(f"{base}/signups")
    ids.selectExpr("id AS skp_contract", "concat('C', id) AS text_contract_number").write.parquet(f"{base}/contracts")
    ids.selectExpr("id + 1000000 AS skp_card_account", "id AS skp_contract").write.parquet(f"{base}/accounts")
    apply_session_conf(spark)
    return {n: spark.read.parquet(f"{base}/{n}") for n in ("calls", "signups", "contracts", "accounts")}


def final_plan(df) -> str:
    """The plan as it was run, after all adaptive changes."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_band_exploded_into_days_is_not_broadcast(stored):
    """Neither the calls nor the days of the sign-ups go through the driver."""
    since, at = F.col("since"), F.col("at")
    cond = (F.col("cuid") == F.col("client")) & at.between(plus_days(since, -7), since)
    found = band_join(stored["calls"], stored["signups"], cond, point=at, low=plus_days(since, -7), high=since)
    counted = found.groupBy().agg(F.count("agent").alias("n"))
    assert "BroadcastHashJoin" not in final_plan(counted)
    assert counted.first()["n"] == stored["calls"].join(stored["signups"].hint("merge"), cond).count() > 0


def test_contract_and_account_maps_are_not_broadcast(stored):
    """a map of every contract grows with the input, so it is no small dimension."""
    contracts = stored["contracts"].select(F.col("text_contract_number").alias("contract_code"))
    found = contract_accounts(contracts, "contract_code", stored["contracts"], stored["accounts"])
    counted = found.groupBy().agg(F.count("skp_card_account").alias("n"))
    assert "BroadcastHashJoin" not in final_plan(counted)
    assert counted.first()["n"] == 1_200_000


def test_small_sides_are_still_broadcast(spark, stored):
    agents = spark.range(50).selectExpr("concat('AGENT', id) AS name")
    assert "BroadcastHashJoin" in final_plan(stored["calls"].join(agents, F.col("agent") == F.col("name")).groupBy().count())
