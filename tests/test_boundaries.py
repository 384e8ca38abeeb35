"""Boundary instants of the band joins on hand-built rows."""

from callcredit.functions.rules import TEST_RULES
from callcredit.plans import contract, lead, usage_calls
from tests.helpers import T, make_inputs, rows

AS_OF = T("2024-01-31 12:00:00")


def test_appointment_band_ends_before_day_plus_8(spark):
    loan = {"cuid": 7, "product_code": "CLWND", "preprocess_date": T("2024-01-20"), "name_credit_status": "Active"}
    call = {"call_id": 1, "cuid": "7", "time_of_call_start": T("2024-01-20 10:00:00"), "durations": 30,
            "response_result_2": "Schedule_Appointment_with_SA", "username": "agent1"}
    inputs = make_inputs(spark, appl_loan=[dict(loan, contract_code="C1", sign_date=T("2024-01-28 00:00:00")),
                                           dict(loan, contract_code="C2", sign_date=T("2024-01-27 23:59:59"))],
                         call_disp=[call])
    got = lead.sending_lead(inputs, AS_OF, TEST_RULES)
    assert rows(got, "contract_code", "product", "username") == [("C2", "CLW", "agent1")]


def test_callback_band_ends_before_day_plus_4(spark):
    base = {"cuid": "9", "durations": 20, "response_result_2": "Client agrees", "channel": "CCXP",
            "call_type": "Outbound", "interaction_type_key": 1, "username": "agent1", "record_type": "General",
            "call_list_gen": "SAS_TLS_OUTBOUND_CCX_USAGE_PUSH"}
    calls = [dict(base, call_id=1, il_communication_id=55, time_of_call_start=T("2024-01-20 10:00:00")),
             dict(base, call_id=2, time_of_call_start=T("2024-01-23 23:59:59")),
             dict(base, call_id=3, time_of_call_start=T("2024-01-24 00:00:00"))]
    task = {"id_source": "55.1", "skp_client": 1, "date_campaign_start": T("2024-01-18"),
            "date_campaign_end": T("2024-02-10"), "code_call_list_type": "STD",
            "text_name_call_list": "CCX_USAGE_X_PUSH", "code_output_load_type": "TLS",
            "date_communication_start": T("2024-01-15"), "dtime_created": T("2024-01-05")}
    inputs = make_inputs(spark, call_disp=calls, campaign_load=[task])
    got = usage_calls.push_usage_calls(inputs, AS_OF, TEST_RULES)
    assert rows(got, "call_id", "call_type", "il_communication_id", "product_type") == \
        [(1, "1st call", 55, "OTHER"), (2, "Call back Personal", 55, "OTHER")]


def test_sign_call_after_approval_minus_one_minute(spark):
    loan = {"contract_code": "C1", "cuid": 3, "approve_date": T("2024-01-10 00:00:00"),
            "sign_date": T("2024-01-20"), "preprocess_date": T("2024-01-05"), "name_credit_status": "Active",
            "product_gr": "CLX"}
    base = {"cuid": "3", "team": "QS_Internal", "code_disposition": "Sign successful", "username": "agent2"}
    calls = [dict(base, call_id=1, time_of_call_start=T("2024-01-09 23:59:00"),
                  time_of_call_end=T("2024-01-09 23:59:05"), durations=5),
             dict(base, call_id=2, time_of_call_start=T("2024-01-09 23:59:01"),
                  time_of_call_end=T("2024-01-09 23:59:21"), durations=20)]
    inputs = make_inputs(spark, appl_loan=[loan], call_disp=calls)
    got = contract.mc_contracts(inputs, AS_OF, TEST_RULES)
    assert rows(got, "contract_code", "time_of_call_start", "user_name", "inserted_date") == \
        [("C1", T("2024-01-09 23:59:01"), "agent2", AS_OF)]
    # the 15-second total counts every team call in the band, not only the credited one
    short = make_inputs(spark, appl_loan=[loan], call_disp=[dict(calls[1], durations=14)])
    assert contract.mc_contracts(short, AS_OF, TEST_RULES).count() == 0
