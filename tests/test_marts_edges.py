"""Marts on hand-built rows: boundary instants, ties, collapsing, anti join."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from callcredit.functions.rules import TEST_RULES
from callcredit.plans import mobile, usage_bonus
from callcredit.plans.usage_calls import OUTPUT
from tests.helpers import T, make_inputs, rows

AS_OF = T("2024-01-31 12:00:00")


def test_mobile_band_bounds_and_latest(spark):
    eff = T("2024-01-20 00:00:00")
    calls = [{"time_of_call_start": t, "resource_name": n, "cuid": 7}
             for t, n in [(eff - dt.timedelta(days=7, seconds=1), "A"), (eff - dt.timedelta(days=7), "B"),
                          (eff, "C"), (eff + dt.timedelta(seconds=1), "D")]]
    inputs = make_inputs(spark, online_user=[{"skp_client": 1, "date_effective": eff}],
                         client_dim=[{"skp_client": 1, "id_cuid": 7}], call_log=calls)
    got = mobile.mobile_signups(inputs, AS_OF, TEST_RULES)
    assert rows(got) == [("2024-01", 7, eff, "C", eff)]
    # the lower bound is inclusive too
    only_b = make_inputs(spark, online_user=[{"skp_client": 1, "date_effective": eff}],
                         client_dim=[{"skp_client": 1, "id_cuid": 7}], call_log=[calls[0], calls[1]])
    assert rows(mobile.mobile_signups(only_b, AS_OF, TEST_RULES), "username") == [("B",)]


def _push_calls(spark, data):
    types = ("date_campaign_start timestamp_ntz, date_campaign_end timestamp_ntz, text_name_call_list string, "
             "time_of_call_start timestamp_ntz, time_of_call_end timestamp_ntz, durations int, call_type string, "
             "record_type string, cuid string, il_communication_id bigint, call_id bigint, username string, "
             "skp_client bigint, code_call_list_type string, contract_code string, product_type string, "
             "apl_sign_dtm timestamp_ntz")
    return spark.createDataFrame([tuple(d.get(c) for c in OUTPUT) for d in data], types)


def test_push_usage_tie_and_identical_transactions(spark):
    call = {"date_campaign_start": T("2024-01-10"), "text_name_call_list": "L", "time_of_call_start": T("2024-01-12"),
            "durations": 30, "cuid": "5", "il_communication_id": 99, "call_id": 1, "username": "agent1",
            "product_type": "CCX", "apl_sign_dtm": T("2024-01-01")}
    # the same call carries two active contracts: one row is kept, deterministically
    push = _push_calls(spark, [dict(call, contract_code="C1"), dict(call, contract_code="C3")])
    txn = {"skp_card_account": 1003, "name_card_acceptor": "GRAB", "amt_billing": Decimal("100.00"),
           "dtime_auth_transaction": T("2024-01-13"), "code_card_transaction_group": "WITHDRAWAL"}
    inputs = make_inputs(
        spark, contract_dim=[{"skp_contract": 1, "text_contract_number": "C1"},
                             {"skp_contract": 3, "text_contract_number": "C3"}],
        card_account=[{"skp_card_account": 1001, "skp_contract": 1}, {"skp_card_account": 1003, "skp_contract": 3}],
        card_txn=[txn, dict(txn), dict(txn, dtime_auth_transaction=T("2024-01-30"))],  # last one after the window
        employee=[{"username": "agent1", "team": "T1", "date_valid_from": T("2023-01-01"), "channel": "CCX"}])
    got = usage_bonus.push_usage(inputs, push, AS_OF, TEST_RULES).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.contract_code, r.total_amount, r.num_transaction, r.total_transaction, r.team) == \
        ("C3", Decimal("100.00"), 1, 1, "T1")
    assert r.end_apt_push_usage == T("2024-01-18")


def test_push_usage_overlapping_validity_doubles_sums(spark):
    call = {"date_campaign_start": T("2024-01-10"), "text_name_call_list": "L", "time_of_call_start": T("2024-01-12"),
            "cuid": "5", "il_communication_id": 1, "call_id": 1, "username": "agent1", "contract_code": "C1",
            "product_type": "CCX", "apl_sign_dtm": T("2024-01-01")}
    emp = {"username": "agent1", "team": "T1", "date_valid_from": T("2023-01-01"), "channel": "CCX"}
    inputs = make_inputs(
        spark, contract_dim=[{"skp_contract": 1, "text_contract_number": "C1"}],
        card_account=[{"skp_card_account": 1001, "skp_contract": 1}],
        card_txn=[{"skp_card_account": 1001, "name_card_acceptor": "GRAB", "amt_billing": Decimal("7.00"),
                   "dtime_auth_transaction": T("2024-01-13"), "code_card_transaction_group": "WITHDRAWAL"}],
        employee=[emp, dict(emp), dict(emp, team="T2")])
    got = usage_bonus.push_usage(inputs, _push_calls(spark, [call]), AS_OF, TEST_RULES)
    assert rows(got, "team", "total_amount", "num_transaction", "total_transaction") == \
        [("T1", Decimal("14.00"), 2, 1), ("T2", Decimal("7.00"), 1, 1)]


def test_unrewarded_anti_join_flag_null_vs_one(spark):
    card = {"name_credit_status": "Active", "cuid": 1, "sign_date": T("2024-01-05"), "product_code": "CC1",
            "product_gr": "Card", "t_amount_usage_bonus": Decimal("0"), "number_trans_bonus": 0,
            "apt_user": "agent1", "apt_team": "CCX_A"}
    inputs = make_inputs(spark, card_bonus=[dict(card, contract_code="C1"), dict(card, contract_code="C2"),
                                            dict(card, contract_code="C3", name_credit_status="Cancelled")])
    pu = spark.createDataFrame([("C1", "CCX", T("2024-01-10"), Decimal("600000"), 0, 0),
                                ("C2", "CCX", T("2024-01-10"), Decimal("10"), 0, 0)],
                               "contract_code string, product_type string, date_campaign_start timestamp_ntz, "
                               "total_amount decimal(38,2), num_transaction long, total_transaction long")
    bp = spark.createDataFrame([], "contract_code string, product_code string, sign_date timestamp_ntz, "
                                   "total_amount decimal(38,2), num_transaction long, total_transaction long")
    got = usage_bonus.unrewarded_contracts(inputs, pu, bp, AS_OF, TEST_RULES)
    assert rows(got, "contract_code", "total_transaction") == [("C2", 0)]


def test_results_ignore_input_order(spark):
    """Metamorphic: reshuffling the inputs leaves tie-broken results unchanged."""
    from pyspark.sql import functions as F

    from callcredit.plans import lead
    from callcredit.sources.fixtures import load_inputs
    from tests.conftest import SF_SMALL
    base = load_inputs(spark, SF_SMALL)
    shuffled = {k: v.repartition(7, F.rand(11)) for k, v in base.items()}
    for fn in (lead.sending_lead, lead.pushing_sign):
        assert rows(fn(base, AS_OF, TEST_RULES)) == rows(fn(shuffled, AS_OF, TEST_RULES))
    from callcredit.plans import usage_calls
    a = usage_bonus.push_usage(base, usage_calls.push_usage_calls(base, AS_OF, TEST_RULES), AS_OF, TEST_RULES)
    b = usage_bonus.push_usage(shuffled, usage_calls.push_usage_calls(shuffled, AS_OF, TEST_RULES), AS_OF,
                               TEST_RULES)
    assert rows(a) == rows(b)
