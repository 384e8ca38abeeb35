"""Plan checks: no cartesian or nested-loop joins, partial top-1 before the
shuffle, time bounds pushed into the Parquet scans."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

QUERIES = E.queries()
TOP1 = ["m03_mobile_signups", "m04_sending_lead", "m05_pushing_sign", "m08_push_usage",
        "m09_usage_before_first_push", "m15_bnpl_usage_bonus"]


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", TOP1)
def test_top1_is_partial_before_shuffle(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    agg = "partial_max(struct(" if name != "m09_usage_before_first_push" else "partial_min(struct("
    assert agg in p


def test_time_bounds_reach_the_scan(spark):
    p = plan(QUERIES["m07_push_usage_calls"](spark, SF_SMALL))
    # the 30-day look-back from 2024-01-31 12:00 and the lost-days gap are Parquet filters
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in p
    assert "Or(LessThan(ts,2023-03-16T00:00),GreaterThanOrEqual(ts,2023-03-21T00:00))" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in p
    p = plan(QUERIES["m01_connected_calls"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts,2023-12-01T00:00)" in p


def _physical(df) -> str:
    return plan(df).split("\n\n\n")[0]


def test_transactions_are_never_broadcast(spark):
    """The card-transaction fact table joins by shuffle (merge hint), even when small."""
    for name in ("m08_push_usage", "m09_usage_before_first_push", "m10_unrewarded_contracts",
                 "m15_bnpl_usage_bonus", "j12_card_withdrawals_left"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        details = p.split("\n\n\n", 1)[1]
        # the lineitem scan (the transaction projection) never feeds a BroadcastExchange
        for block in details.split("\n\n"):
            if block.startswith("(") and "BroadcastExchange" in block.splitlines()[0]:
                assert "l_orderkey" not in block and "l_partkey" not in block, (name, block)


def test_fixed_width_bands_join_on_the_day(spark):
    for name in ("m03_mobile_signups", "m07_push_usage_calls", "j05_signup_band", "j07_appointment_band",
                 "j10_callback_days"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "_day_bucket_p" in p and "_day_bucket_r" in p, name
        assert "explode(CASE WHEN" in p and "sequence(" in p, name


def test_counts_and_next_events_form_no_pairs(spark):
    """J10's counts and J15's next event join no calls with calls: windows over one client's events."""
    p = plan(QUERIES["j15_next_calls"](spark, SF_SMALL))
    assert "Window" in p and "Join" not in p.split("\n\n\n")[0]
    p = plan(QUERIES["j10_callback_pairs"](spark, SF_SMALL))
    assert "Window" in p and "_day_bucket" not in p


def test_sequence_ids_use_a_range_shuffle(spark):
    p = plan(QUERIES["w07_contract_sequence"](spark, SF_SMALL))
    assert "Scan ExistingRDD" in p  # slices and positions are stored once
    assert "Window" in p  # only over the small per-slice counts
