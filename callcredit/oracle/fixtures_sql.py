"""DuckDB versions of the test-input projections (see sources/fixtures.py).

``FIXTURES`` is a list of ``name AS (...)`` CTE bodies; every oracle query
starts with ``WITH`` + these, then its own CTEs.
"""

D = "(TIMESTAMP '2024-01-01' + to_days(CAST({} AS INTEGER)))"


def d(expr: str) -> str:
    return D.format(expr)


def h(ts: str, expr: str) -> str:
    return f"({ts} + to_hours(CAST({expr} AS INTEGER)))"


_STATUS = """CASE WHEN o_orderstatus = 'F' THEN 'Finished'
            WHEN o_orderstatus = 'O' THEN 'Active'
            WHEN o_orderstatus = 'P' AND o_orderkey % 4 < 2 THEN 'Signed'
            WHEN o_orderstatus = 'P' THEN 'Cancelled' END"""
_SIGN = h(d("o_orderkey % 31"), "o_orderkey % 24")
_TXN_TIME = h(d("(l_orderkey * 7 + l_partkey + l_linenumber * 5) % 40"), "l_suppkey % 24")

FIXTURES = [
    f"""employee AS (
  SELECT 'agent' || CAST(s_suppkey // 2 AS VARCHAR) AS username,
         CASE s_suppkey % 3 WHEN 0 THEN 'CCX_A' WHEN 1 THEN 'QS_Internal' WHEN 2 THEN 'External Service' END AS team,
         CASE WHEN s_suppkey % 2 = 0 THEN TIMESTAMP '2023-01-01' ELSE TIMESTAMP '2024-01-15' END AS date_valid_from,
         CASE WHEN s_suppkey % 2 = 0 THEN TIMESTAMP '2024-01-14' END AS date_valid_to,
         CASE s_suppkey % 5 WHEN 0 THEN 'CLX' WHEN 1 THEN 'ACLX' WHEN 2 THEN 'CCX' WHEN 3 THEN 'CCXP' WHEN 4 THEN 'TSA' END AS channel
  FROM supplier)""",
    """call_log AS (
  SELECT ts AS time_of_call_start,
         'AGENT' || CAST(event_id % 50 AS VARCHAR) AS resource_name,
         user_id AS cuid,
         CAST(floor(value) AS INTEGER) AS durations,
         CASE event_id % 4 WHEN 0 THEN 'Agent' WHEN 1 THEN 'Client' ELSE 'System' END AS off_by,
         CASE WHEN event_type IN ('view', 'click') THEN 'Inbound' ELSE 'Outbound' END AS call_type,
         CASE WHEN event_id % 3 = 0 THEN 'LIST_SAS' ELSE 'LIST_OTHER' END AS name,
         CASE event_id % 4 WHEN 0 THEN 'x ProAct' WHEN 1 THEN 'x TLS' WHEN 2 THEN 'x Pred' WHEN 3 THEN 'x' END AS custom_data_4
  FROM events)""",
    """call_disp AS (
  SELECT event_id AS call_id,
         ts AS time_of_call_start,
         ts + to_seconds(CAST(CAST(floor(value) AS INTEGER) AS BIGINT)) AS time_of_call_end,
         CAST(floor(value) AS INTEGER) AS durations,
         CASE WHEN event_id % 7 = 0 THEN 'Campaign Callback' ELSE 'General' END AS record_type,
         CAST(user_id AS VARCHAR) AS cuid,
         CASE WHEN event_id % 5 <> 0 THEN user_id END AS il_communication_id,
         'agent' || CAST(event_id % 50 AS VARCHAR) AS username,
         CASE event_type WHEN 'purchase' THEN 'Client agrees' WHEN 'click' THEN 'Sending Lead'
              WHEN 'view' THEN 'Schedule_Appointment_with_SA' WHEN 'error' THEN 'Sign successful'
              WHEN 'signup' THEN 'none' END AS response_result_2,
         CASE WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 'Use Agree'
              WHEN event_type = 'signup' AND event_id % 3 = 1 THEN 'Sign Agree'
              WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'Sign successful' END AS code_disposition,
         CASE WHEN event_id % 6 = 0 THEN 'SAS_RTDM_TLS_OUTBOUND_CCX_USAGE_PUSH_CALLBACK'
              ELSE 'SAS_TLS_OUTBOUND_CCX_USAGE_PUSH' END AS call_list_gen,
         CASE event_id % 3 WHEN 0 THEN 'CLX' WHEN 1 THEN 'CCX' WHEN 2 THEN 'CCXP' END AS channel,
         CASE WHEN event_id % 4 = 3 THEN 'Inbound' ELSE 'Outbound' END AS call_type,
         CAST(event_id % 10 AS INTEGER) AS interaction_type_key,
         CASE event_id % 3 WHEN 0 THEN 'QS_Internal' WHEN 1 THEN 'External Service' WHEN 2 THEN 'CCX_A' END AS team,
         user_id AS orig_offer_id
  FROM events)""",
    """call_backfill AS (
  SELECT event_id AS call_id,
         CASE event_id % 6 WHEN 0 THEN 'campaign' WHEN 2 THEN 'personal' END AS call_back_type,
         CASE WHEN event_id % 10 <> 0 THEN CAST(user_id AS VARCHAR) END AS il_communication_id,
         CASE WHEN event_id % 4 <> 0 THEN 'BACKFILL_LIST' END AS call_back_call_list
  FROM events
  WHERE event_id % 2 = 0 AND ts >= TIMESTAMP '2024-01-16' AND ts < TIMESTAMP '2024-01-21')""",
    f"""appl_loan AS (
  SELECT 'C' || CAST(o_orderkey AS VARCHAR) AS contract_code,
         o_custkey AS cuid,
         {_SIGN} AS sign_date,
         {d("o_orderkey % 31 - 2")} AS preprocess_date,
         {d("o_orderkey % 31 - 5")} AS approve_date,
         CASE WHEN o_orderkey % 10 = 9 THEN {d("40")} END AS cancel_date,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'CLXMCB1' WHEN '2' THEN 'CLWND'
              WHEN '3' THEN 'CLXSA1' WHEN '4' THEN 'CLWAD' WHEN '5' THEN 'CLX01' END AS product_code,
         'CLX' AS product_gr,
         {_STATUS} AS name_credit_status,
         o_custkey AS orig_offer_id
  FROM orders WHERE o_orderkey % 2 = 0)""",
    f"""appl_card AS (
  SELECT 'C' || CAST(o_orderkey AS VARCHAR) AS contract_code,
         o_custkey AS cuid,
         {_SIGN} AS sign_date,
         {d("o_orderkey % 31 - 2")} AS preprocess_date,
         {d("o_orderkey % 31 - 5")} AS approve_date,
         CASE WHEN o_orderkey % 10 = 9 THEN {d("40")} END AS cancel_date,
         'CCX' AS product_gr,
         {_STATUS} AS name_credit_status,
         o_custkey AS orig_offer_id
  FROM orders WHERE o_orderkey % 2 = 1)""",
    f"""card_bonus AS (
  SELECT 'C' || CAST(o_orderkey AS VARCHAR) AS contract_code,
         {_STATUS} AS name_credit_status,
         o_custkey AS cuid,
         {d("o_orderkey % 31 - 5")} AS apt_date,
         'agent' || CAST(o_orderkey % 50 AS VARCHAR) AS apt_user,
         'CCX_A' AS apt_team,
         {_SIGN} AS sign_date,
         CASE WHEN o_orderkey % 5 = 0 THEN 'VC1' ELSE 'CC1' END AS product_code,
         CASE WHEN o_orderkey % 5 = 0 THEN 'Virtual Card' ELSE 'Card' END AS product_gr,
         CAST((o_orderkey % 9) * 100000 AS DECIMAL(18,2)) AS t_amount_usage_bonus,
         CAST(o_orderkey % 5 AS BIGINT) AS number_trans_bonus,
         {_SIGN} + to_days(1) AS f_use
  FROM orders WHERE o_orderkey % 2 = 1)""",
    """operator_roster AS (
  SELECT upper(username) AS username, 'CCX' AS product, '2023-12' AS bonus_term, 'Ex_1' AS team
  FROM employee)""",
    f"""online_user AS (
  SELECT c_custkey AS skp_client, {d("5 + c_custkey % 25")} AS date_effective FROM customer)""",
    """client_dim AS (
  SELECT c_custkey AS skp_client, c_custkey AS id_cuid FROM customer)""",
    f"""campaign_load AS (
  SELECT CASE WHEN c_custkey % 17 = 0 THEN CAST(c_custkey AS VARCHAR)
              ELSE CAST(c_custkey AS VARCHAR) || '.1' END AS id_source,
         c_custkey + 500 AS skp_client,
         {d("12 + c_custkey % 14")} AS date_campaign_start,
         {d("28 + c_custkey % 10")} AS date_campaign_end,
         CASE WHEN c_custkey % 9 = 1 THEN 'GAMI_TRX_LESS500K' WHEN c_custkey % 9 <> 0 THEN 'STD' END AS code_call_list_type,
         CASE c_custkey % 4 WHEN 0 THEN 'CCX_USAGE_X_PUSH' WHEN 1 THEN 'CCX_ACTIVATE_PUSH'
              WHEN 2 THEN 'ATM USAGE PUSH' WHEN 3 THEN 'Q_TLS_HPL_USAGE_1' END AS text_name_call_list,
         CASE WHEN c_custkey % 10 = 0 THEN 'SMS' ELSE 'TLS' END AS code_output_load_type,
         {d("5 + c_custkey % 20")} AS date_communication_start,
         {d("c_custkey % 20")} AS dtime_created
  FROM customer)""",
    f"""crm_appl AS (
  SELECT o_custkey AS id_cuid,
         'C' || CAST(o_orderkey AS VARCHAR) AS num_apl_contract,
         CASE (o_orderkey // 2) % 5 WHEN 0 THEN 'CCX' WHEN 1 THEN 'CC_VCC' WHEN 2 THEN 'CC_BHX' ELSE 'BNPL1' END AS code_apl_prod_gr,
         CASE WHEN o_orderkey % 13 = 0 THEN TIMESTAMP '3000-01-01' ELSE {d("o_orderkey % 31 - 15")} END AS dtime_apl_sign,
         CASE WHEN o_orderkey % 3 = 0 THEN {d("25")} END AS dtime_apl_close,
         CASE WHEN o_orderkey % 11 = 0 THEN {d("10")} ELSE TIMESTAMP '3000-01-01' END AS dtime_apl_cancel
  FROM orders WHERE o_orderkey % 2 = 1)""",
    """contract_dim AS (
  SELECT o_orderkey AS skp_contract, 'C' || CAST(o_orderkey AS VARCHAR) AS text_contract_number FROM orders)""",
    """card_account AS (
  SELECT o_orderkey + 1000000 AS skp_card_account, o_orderkey AS skp_contract
  FROM orders WHERE o_orderkey % 2 = 1)""",
    f"""card_txn AS (
  SELECT l_orderkey + 1000000 AS skp_card_account,
         CASE l_partkey % 8 WHEN 0 THEN 'Foody HN' WHEN 1 THEN 'SENDONGA SHOP' WHEN 2 THEN 'Sendo VN'
              WHEN 3 THEN 'CNBENTRECTYKAYGROUP' WHEN 4 THEN 'Be Group JSC' WHEN 5 THEN 'BAEMIN'
              WHEN 6 THEN 'BOOKING.COM' WHEN 7 THEN 'ATM 01' END AS name_card_acceptor,
         CAST(l_extendedprice * 10 AS DECIMAL(18,2)) AS amt_billing,
         {_TXN_TIME} AS dtime_auth_transaction,
         {_TXN_TIME} AS date_transaction,
         CASE WHEN l_returnflag = 'N' THEN 'PAYMENT' ELSE 'WITHDRAWAL' END AS code_card_transaction_group,
         CASE WHEN l_linenumber <= 5 THEN '1711699' ELSE '1' END AS skp_card_transaction_type,
         CASE WHEN l_linestatus = 'O' THEN 'a' ELSE 'n' END AS code_status
  FROM lineitem)""",
]


def with_fixtures(*ctes: str) -> str:
    """``WITH`` + fixture CTEs + the given extra CTE bodies (without trailing select)."""
    return "WITH " + ",\n".join(FIXTURES + list(ctes))
