"""Oracle SQL for the operator-level queries (DuckDB)."""

from __future__ import annotations

from ..functions import rules as R
from .fixtures_sql import with_fixtures
from .sql_base import MERCHANTS, OUTCOME as DISP, listed, ts


def _q(body: str, *ctes: str) -> str:
    return with_fixtures(*ctes) + "\n" + body


def checks_sql(as_of, rules: R.Rules) -> dict[str, str]:
    a = ts(as_of)
    cut = ts(R.TEST_CUTOVER)
    return {
        "q06_validity_overlaps": _q(f"""
SELECT * FROM (
  SELECT username, team, date_valid_from, date_valid_to, channel,
         max(coalesce(date_valid_to, {a}) + INTERVAL 1 DAY) OVER (
           PARTITION BY username
           ORDER BY date_valid_from ASC NULLS FIRST, coalesce(date_valid_to, {a}) + INTERVAL 1 DAY ASC NULLS FIRST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_end
  FROM employee) x
WHERE previous_end > date_valid_from"""),
        "j01_validity_join": _q(f"""
SELECT g.time_of_call_start, g.resource_name, g.cuid, e.username, e.team, e.channel
FROM call_log g JOIN employee e ON lower(g.resource_name) = e.username
 AND g.time_of_call_start >= e.date_valid_from
 AND g.time_of_call_start < coalesce(e.date_valid_to, {a}) + INTERVAL 1 DAY"""),
        "j02_validity_left_join": _q(f"""
SELECT c.call_id, c.username AS agent, e.team
FROM call_disp c LEFT JOIN (SELECT * FROM employee WHERE channel IN ('CCX', 'CCXP')) e
  ON c.username = e.username AND c.time_of_call_start >= e.date_valid_from
 AND c.time_of_call_start < coalesce(e.date_valid_to, {a}) + INTERVAL 1 DAY"""),
        "j05_signup_band": _q("""
SELECT g.cuid, u.date_effective, g.time_of_call_start, g.resource_name
FROM online_user u JOIN client_dim d ON u.skp_client = d.skp_client
JOIN call_log g ON d.id_cuid = g.cuid
 AND g.time_of_call_start BETWEEN u.date_effective - INTERVAL 7 DAY AND u.date_effective"""),
        "j07_appointment_band": _q("""
SELECT l.contract_code, c.call_id
FROM appl_loan l JOIN call_disp c ON c.cuid = CAST(l.cuid AS VARCHAR)
 AND c.time_of_call_start < l.sign_date
 AND l.sign_date < date_trunc('day', c.time_of_call_start) + INTERVAL 8 DAY"""),
        "j09_approval_band": _q("""
SELECT l.contract_code, count(*) AS n_calls
FROM appl_loan l JOIN call_disp c ON c.cuid = CAST(l.cuid AS VARCHAR)
 AND c.time_of_call_start > l.approve_date - INTERVAL 1 MINUTE
 AND c.time_of_call_start < l.sign_date
GROUP BY l.contract_code"""),
        "j10_callback_pairs": _q("""
SELECT t2.call_id AS first_call_id, count(*) AS n_later
FROM call_disp t1 JOIN call_disp t2 ON t1.cuid = t2.cuid
 AND t1.time_of_call_start > t2.time_of_call_start
 AND t1.time_of_call_start < date_trunc('day', t2.time_of_call_start) + INTERVAL 4 DAY
GROUP BY t2.call_id"""),
        "j10_callback_days": _q("""
SELECT t1.call_id AS later_call_id, f.d AS callback_day, f.first_call_id
FROM call_disp t1
JOIN (SELECT cuid, d, time_of_call_start AS p_ts, call_id AS first_call_id FROM (
        SELECT cuid, date_trunc('day', time_of_call_start) AS d, time_of_call_start, call_id,
               row_number() OVER (PARTITION BY cuid, date_trunc('day', time_of_call_start)
                                  ORDER BY time_of_call_start ASC NULLS FIRST, call_id ASC NULLS FIRST) AS rn
        FROM call_disp) x WHERE rn = 1) f
  ON t1.cuid = f.cuid AND t1.time_of_call_start > f.p_ts
 AND t1.time_of_call_start < f.d + INTERVAL 4 DAY"""),
        "j11_active_contracts": _q("""
SELECT call_id, count(contract_code) AS n_contracts FROM (
SELECT c.call_id, t.contract_code
FROM call_disp c LEFT JOIN (
  SELECT id_cuid, num_apl_contract AS contract_code,
         CASE WHEN dtime_apl_sign = TIMESTAMP '3000-01-01' THEN NULL ELSE dtime_apl_sign END AS s,
         coalesce(dtime_apl_close, TIMESTAMP '3000-01-01') AS c
  FROM crm_appl
  WHERE (CASE WHEN dtime_apl_sign = TIMESTAMP '3000-01-01' THEN NULL ELSE dtime_apl_sign END) IS NOT NULL) t
  ON TRY_CAST(c.cuid AS BIGINT) = t.id_cuid AND c.time_of_call_start < t.c AND c.time_of_call_start > t.s) x
GROUP BY call_id"""),
        "j12_withdrawal_counts": _q("""
SELECT b.contract_code, b.sign_date, count(DISTINCT t4.dtime_auth_transaction) AS total_transaction
FROM (SELECT DISTINCT contract_code, sign_date FROM card_bonus) b
LEFT JOIN contract_dim t2 ON b.contract_code = t2.text_contract_number
LEFT JOIN card_account t3 ON t3.skp_contract = t2.skp_contract
LEFT JOIN card_txn t4 ON t3.skp_card_account = t4.skp_card_account
 AND t4.code_card_transaction_group = 'WITHDRAWAL' AND t4.dtime_auth_transaction >= b.sign_date
GROUP BY b.contract_code, b.sign_date"""),
        "j12_card_withdrawals_left": _q("""
SELECT b.contract_code, b.sign_date, t4.dtime_auth_transaction, t4.amt_billing
FROM card_bonus b
LEFT JOIN contract_dim t2 ON b.contract_code = t2.text_contract_number
LEFT JOIN card_account t3 ON t3.skp_contract = t2.skp_contract
LEFT JOIN card_txn t4 ON t3.skp_card_account = t4.skp_card_account
 AND t4.code_card_transaction_group = 'WITHDRAWAL' AND t4.dtime_auth_transaction >= b.sign_date"""),
        "j13_laid_out_usage": _q(f"""
SELECT contract_code, sign_date, count(DISTINCT dtime_auth_transaction) AS n_times, sum(amt_billing)::DECIMAL(38, 2) AS amount
FROM (SELECT DISTINCT contract_code, sign_date FROM card_bonus) JOIN contract_dim ON text_contract_number = contract_code
JOIN card_account USING (skp_contract) JOIN card_txn USING (skp_card_account)
WHERE code_card_transaction_group = 'WITHDRAWAL' AND dtime_auth_transaction >= sign_date
  AND greatest(dtime_auth_transaction, date_transaction) >= {ts(rules.earliest_sign)}
GROUP BY ALL"""),
        "j15_next_calls": _q("""
SELECT card.contract_code, card.cuid, card.sign_date, min(called.time_of_call_start) AS time_of_call_start,
       arg_min(call_id, (called.time_of_call_start, call_id)) AS call_id
FROM (SELECT row_number() OVER () AS r, * FROM card_bonus) AS card
JOIN call_disp AS called ON try_cast(called.cuid AS BIGINT) = card.cuid AND called.time_of_call_start > card.sign_date
GROUP BY r, card.contract_code, card.cuid, card.sign_date"""),
        "j16_contracts_without_usage": _q("""
SELECT b.contract_code, b.cuid FROM card_bonus b
WHERE NOT EXISTS (SELECT 1 FROM contract_dim t2
                  JOIN card_account t3 ON t3.skp_contract = t2.skp_contract
                  JOIN card_txn t4 ON t3.skp_card_account = t4.skp_card_account
                  WHERE t2.text_contract_number = b.contract_code
                    AND t4.code_card_transaction_group = 'WITHDRAWAL')"""),
        "j17_roster_calls": _q("""
SELECT c.call_id, c.username FROM call_disp c
WHERE lower(c.username) IN (SELECT lower(username) FROM operator_roster WHERE team LIKE 'Ex%')"""),
        "w01_latest_call_per_client": _q("""
SELECT cuid, call_id, time_of_call_start, username FROM call_disp
QUALIFY row_number() OVER (PARTITION BY cuid ORDER BY time_of_call_start DESC NULLS FIRST,
                                                   call_id DESC NULLS LAST) = 1"""),
        "w04_earliest_call_per_client_day": _q("""
SELECT cuid, call_id, time_of_call_start, CAST(time_of_call_start AS DATE) AS call_day FROM call_disp
QUALIFY row_number() OVER (PARTITION BY cuid, CAST(time_of_call_start AS DATE)
                           ORDER BY time_of_call_start ASC NULLS LAST, call_id ASC NULLS LAST) = 1"""),
        "w06_first_and_last_per_contact": _q("""
SELECT il_communication_id, call_id, time_of_call_start, call_1st FROM (
  SELECT il_communication_id, call_id, time_of_call_start,
         row_number() OVER (PARTITION BY il_communication_id ORDER BY time_of_call_start DESC NULLS FIRST,
                                                                     call_id DESC NULLS LAST) AS rn,
         min(time_of_call_start) OVER (PARTITION BY il_communication_id) AS call_1st
  FROM call_disp) x WHERE rn = 1"""),
        "w07_contract_sequence": _q("""
SELECT contract_code, mth, n, sign_date, cuid, 'CARD_' || replace(mth, '-', '_') || '_' || CAST(n AS VARCHAR) AS camp_id FROM (
  SELECT contract_code, sign_date, cuid, strftime(sign_date, '%Y-%m') AS mth,
         CAST(row_number() OVER (PARTITION BY strftime(sign_date, '%Y-%m')
                                 ORDER BY sign_date ASC NULLS LAST, contract_code ASC NULLS LAST) AS INTEGER) AS n
  FROM card_bonus) x"""),
        "u01_applications": _q("""
SELECT contract_code, cuid, 'CCX' AS product FROM appl_card
UNION ALL
SELECT contract_code, cuid,
       CASE WHEN product_code LIKE '%CLXMCB%' THEN 'CLXCB' WHEN product_code LIKE '%CLW%' THEN 'CLW'
            WHEN product_code LIKE '%CLXSA%' THEN 'CLW' WHEN product_code LIKE '%CLX%' THEN 'CLX' END AS product
FROM appl_loan"""),
        "u02_client_outcomes": _q(f"""
SELECT cuid, {DISP} AS outcome FROM call_disp
UNION
SELECT cuid, lower(coalesce(code_disposition, response_result_2)) AS outcome FROM call_disp"""),
        "a01_calls_per_agent_month": _q("""
SELECT strftime(time_of_call_start, '%Y-%m') AS month, resource_name, count(*) AS calls,
       count(DISTINCT cuid) AS clients, sum(durations) AS seconds
FROM call_log GROUP BY strftime(time_of_call_start, '%Y-%m'), resource_name"""),
        "a03_account_usage": _q(f"""
SELECT skp_card_account, CAST(sum(amt_billing) AS DECIMAL(38,2)) AS total_amount,
       count(CASE WHEN date_transaction < {ts(rules.usage_cutover)} THEN date_transaction
                  WHEN date_transaction >= {ts(rules.usage_cutover)} AND {listed('name_card_acceptor')}
                  THEN date_transaction END) AS num_transaction,
       min(date_transaction) AS first_usage_date, count(date_transaction) AS total_transaction
FROM (SELECT DISTINCT skp_card_account, name_card_acceptor, amt_billing, date_transaction
      FROM card_txn WHERE code_card_transaction_group = 'WITHDRAWAL') t
GROUP BY skp_card_account""", MERCHANTS),
        "f13_call_rules": _q(f"""
SELECT call_id, {DISP} AS disposition, lower(coalesce(code_disposition, response_result_2)) AS signed,
       CASE WHEN call_list_gen = 'SAS_TLS_OUTBOUND_CCX_USAGE_PUSH' THEN '1st call' END AS first_label,
       CASE WHEN il_communication_id IS NOT NULL
                 AND call_list_gen = 'SAS_RTDM_TLS_OUTBOUND_CCX_USAGE_PUSH_CALLBACK' THEN 'Call back RTDM'
            WHEN il_communication_id IS NULL THEN 'Call back Personal' END AS callback_label,
       (interaction_type_key <> 3 AND {DISP} IS NOT NULL AND username IS NOT NULL AND channel = 'CCXP'
        AND call_type = 'Outbound') AS outbound_push,
       {DISP} IN ('Push Use - Client Agrees', 'Use Agree', 'Client agrees') AS use_agreed,
       {DISP} IN ('Push Sign - Client Agrees', 'Sign Agree', 'Client agrees') AS sign_agreed,
       (time_of_call_start < TIMESTAMP '2024-01-16' OR time_of_call_start >= TIMESTAMP '2024-01-21') AS outside_gap
FROM call_disp"""),
        "f11_log_rules": _q(f"""
SELECT time_of_call_start, resource_name, cuid,
       ((durations >= 15 OR (off_by = 'Agent' OR off_by = 'Client')) AND durations > 0) AS qualified,
       ((time_of_call_start BETWEEN {ts(rules.call_rule_start)} AND {ts(rules.call_rule_switch)}
         AND (call_type = 'Inbound' OR (custom_data_4 LIKE '%ProAct%' OR custom_data_4 LIKE '%TLS%'
              OR custom_data_4 LIKE '%Pred%')))
        OR (time_of_call_start >= {ts(rules.call_rule_switch)} AND (call_type = 'Inbound' OR name LIKE '%SAS%')))
         AS counted,
       CAST(time_of_call_start AS DATE) NOT IN ({", ".join(f"DATE '{d}'" for d in rules.excluded_days)})
         AS not_excluded
FROM call_log"""),
        "x15_campaign_rules": _q("""
SELECT skp_client,
       CASE WHEN instr(id_source, '.') > 1 THEN substr(id_source, 1, instr(id_source, '.') - 1) END
         AS il_communication_id,
       coalesce(code_call_list_type, 'xxx') != 'GAMI_TRX_LESS500K' AS type_ok,
       (code_output_load_type = 'TLS'
        AND (text_name_call_list LIKE '%USAGE%PUSH' OR text_name_call_list LIKE '%ACTIVATE%PUSH')
        AND coalesce(code_call_list_type, 'xxx') != 'GAMI_TRX_LESS500K'
        AND text_name_call_list != 'ATM USAGE PUSH') AS usage_list,
       (code_output_load_type = 'TLS' AND text_name_call_list LIKE '%TLS_HPL_USAGE%'
        AND coalesce(code_call_list_type, 'xxx') != 'GAMI_TRX_LESS500K'
        AND text_name_call_list != 'ATM USAGE PUSH') AS bnpl_list
FROM campaign_load"""),
        "f16_contract_rules": _q("""
SELECT num_apl_contract,
       CASE WHEN dtime_apl_sign = TIMESTAMP '3000-01-01' THEN NULL ELSE dtime_apl_sign END AS apl_sign_dtm,
       coalesce(dtime_apl_close, TIMESTAMP '3000-01-01') AS apl_close_dtm,
       CASE WHEN code_apl_prod_gr = 'CCX' THEN 'CCX' WHEN code_apl_prod_gr LIKE '%VC%' THEN 'VCC'
            ELSE 'OTHER' END AS card_type,
       CASE WHEN code_apl_prod_gr LIKE 'BNPL%' THEN 'BNPL' ELSE 'OTHER' END AS bnpl_type
FROM crm_appl"""),
        "f19_merchant_rules": _q(f"""
SELECT skp_card_account, date_transaction, name_card_acceptor, amt_billing,
       {listed('name_card_acceptor')} AS whitelisted,
       CASE WHEN date_transaction < {cut} THEN date_transaction
            WHEN date_transaction >= {cut} AND {listed('name_card_acceptor')} THEN date_transaction
       END AS counted_at,
       (code_card_transaction_group = 'WITHDRAWAL' AND skp_card_transaction_type = '1711699'
        AND code_status != 'n') AS bnpl_withdrawal
FROM card_txn""", MERCHANTS),
        "f20_flag_rules": _q(f"""
SELECT contract_code,
       CASE WHEN product_code LIKE '%VC%' AND sign_date BETWEEN {ts(rules.promo_start)} AND {ts(rules.promo_end)}
                 AND t_amount_usage_bonus >= {rules.promo_amount} THEN 1
            WHEN t_amount_usage_bonus >= {rules.usage_amount}
                 OR (sign_date >= {ts(rules.usage_cutover)} AND number_trans_bonus >= {rules.usage_count}) THEN 1
       END AS flag_usage,
       CASE WHEN t_amount_usage_bonus >= {rules.usage_amount} THEN 1
            WHEN number_trans_bonus >= {rules.usage_count} THEN 1 END AS flag_bnpl,
       name_credit_status NOT IN ('Cancelled') AS not_cancelled
FROM card_bonus"""),
        "x01_date_rules": _q("""
SELECT call_id, date_trunc('day', time_of_call_start) AS day, date_trunc('month', time_of_call_start) AS month_start,
       strftime(time_of_call_start, '%Y-%m') AS month, time_of_call_start + INTERVAL 8 DAY AS plus8,
       date_trunc('day', time_of_call_start) + INTERVAL 4 DAY AS next4,
       time_of_call_start - INTERVAL 1 MINUTE AS minus1m
FROM call_disp"""),
    }
