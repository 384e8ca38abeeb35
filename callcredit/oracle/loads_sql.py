"""Oracle SQL of the load modes and the resumed refresh: what must be in the tables afterwards."""

from __future__ import annotations

from . import attribution_sql as A
from . import bonus_sql as B
from . import usage_sql as U
from .fixtures_sql import with_fixtures
from .sql_base import day


def loads_sql(earlier, as_of, rules) -> dict[str, str]:
    bound = day(as_of, rules.attribution_days)

    def reloaded(mart: str, sql) -> str:
        return f"""
SELECT '{mart}' AS mart, contract_code, sign_date, strftime(sign_date, '%Y-%m-%d') AS sign_day
FROM (SELECT contract_code, sign_date FROM ({sql(earlier, rules)}) WHERE sign_date < {bound}
      UNION ALL SELECT contract_code, sign_date FROM ({sql(as_of, rules)}))"""

    tables = {
        "connect": A.connect_sql(as_of, rules), "connect_client": A.connect_sql(as_of, rules, clients=True),
        "mobile_app": A.mobile_sql(as_of, rules), "sending_lead": A.sending_lead_sql(as_of, rules), "pushing_sign": A.pushing_sign_sql(as_of, rules),
        "call_task": U.call_task_sql(as_of, rules), "push_usage_call": U.push_usage_call_sql(as_of, rules), "push_usage": B.push_usage_sql(as_of, rules),
        "usage_before_first_push": B.before_push_sql(as_of, rules), "no_push_usage": B.no_push_sql(as_of, rules),
        "bonus_push_usage": B.usage_bonus_sql(as_of, rules), "mc_contract": A.mc_contract_sql(as_of, rules),
        "bnpl_usage_calls": U.push_usage_call_sql(as_of, rules, bnpl=True), "bnpl_usage_bonus": B.bnpl_bonus_sql(as_of, rules),
        "camp_bonus": B.campaign_bonus_sql(as_of, rules)}
    return {
        "a06_state_merged": with_fixtures() + """
SELECT contract_code, sign_date, count(DISTINCT dtime_auth_transaction) AS total_transaction
FROM (SELECT DISTINCT contract_code, sign_date FROM card_bonus) JOIN contract_dim ON text_contract_number = contract_code
JOIN card_account USING (skp_contract) JOIN card_txn USING (skp_card_account)
WHERE code_card_transaction_group = 'WITHDRAWAL' AND dtime_auth_transaction >= sign_date GROUP BY ALL""",
        "k01_window_reloaded": reloaded("sending_lead", A.sending_lead_sql) + "\nUNION ALL" + reloaded("pushing_sign", A.pushing_sign_sql),
        "k02_table_refreshed": f"""
SELECT *, 1 AS version FROM ({U.call_task_sql(earlier, rules)})
UNION ALL BY NAME SELECT *, 2 AS version FROM ({U.call_task_sql(as_of, rules)})""",
        "k03_batch_retried": f"SELECT *, strftime(sign_up_date, '%Y-%m-%d') AS sign_up_day FROM ({A.mobile_sql(as_of, rules)})",
        # A mart without rows has no group.
        "p01_refresh_resumed": "\nUNION ALL\n".join(
            f"SELECT '{mart}' AS mart, count(*) AS n_rows FROM ({sql}) HAVING count(*) > 0" for mart, sql in tables.items()),
    }
