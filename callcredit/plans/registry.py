"""Registered queries: each mart and operator check, run on the test inputs.

Every query reads the whole test tables through the fixture projections and
runs with the pinned ``as_of`` and the shifted test parameters, so that the
DuckDB oracle in ``callcredit.oracle`` can compute the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.rules import TEST_AS_OF, TEST_BACKFILL_RULES, TEST_CUTOVER_RULES, TEST_RULES
from ..session import apply_session_conf, ensure_checkpoint_dir
from ..sources.fixtures import load_inputs
from . import campaign, checks, connect, contract, lead, loads, mobile, usage_bonus, usage_calls

Query = Callable[[SparkSession, str], DataFrame]


def _mart(fn, rules=TEST_RULES, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_session_conf(spark)
        ensure_checkpoint_dir(spark)
        return fn(load_inputs(spark, sf_dir), TEST_AS_OF, rules, **kw)
    run.__name__ = fn.__name__
    return run


def _cut(df: DataFrame) -> DataFrame:
    """Materialise a step reused downstream into the shared checkpoint folder
    (``spark.checkpoint.dir``), cutting its lineage like the refresh's tables."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _chain(spark: SparkSession, sf_dir: str, want: str, as_of=TEST_AS_OF, rules=TEST_RULES) -> DataFrame:
    """One step of the usage chain (M7 -> M8 -> M9 -> M10 -> M11, M14 -> M15,
    M11 + M15 -> M12), building only the steps it depends on."""
    apply_session_conf(spark)
    inputs = load_inputs(spark, sf_dir)
    memo: dict[str, DataFrame] = {}

    def get(name: str) -> DataFrame:
        if name in memo:
            return memo[name]
        if name == "m07":
            df = usage_calls.push_usage_calls(inputs, as_of, rules)
        elif name == "m14":
            df = usage_calls.push_usage_calls(inputs, as_of, rules, bnpl=True)
        elif name == "m08":
            df = usage_bonus.push_usage(inputs, get("m07"), as_of, rules)
        elif name == "m09":
            df = usage_bonus.usage_before_first_push(inputs, get("m08"), as_of, rules)
        elif name == "m10":
            df = usage_bonus.unrewarded_contracts(inputs, get("m08"), get("m09"), as_of, rules)
        elif name == "m11":
            df = usage_bonus.usage_bonus(get("m08"), get("m09"), get("m10"), as_of, rules)
        elif name == "m15":
            df = usage_bonus.bnpl_usage_bonus(inputs, get("m14"), as_of, rules)
        elif name == "m12":
            df = campaign.campaign_bonus(get("m11"), get("m15"), as_of, rules)
        else:
            raise KeyError(name)
        if name != want:  # upstream steps are read as materialised tables, as in the refresh
            df = _cut(df)
        memo[name] = df
        return df

    return get(want)


def _step(name: str, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _chain(spark, sf_dir, name, **kw)
    run.__name__ = name
    return run


def queries() -> dict[str, Query]:
    return {
        "m01_connected_calls": _mart(connect.connected_calls),
        "m02_connected_clients": _mart(connect.connected_clients),
        "m03_mobile_signups": _mart(mobile.mobile_signups),
        "m04_sending_lead": _mart(lead.sending_lead),
        "m05_pushing_sign": _mart(lead.pushing_sign),
        "m06_call_tasks": _mart(usage_calls.call_tasks),
        "m07_push_usage_calls": _mart(usage_calls.push_usage_calls),
        "m08_push_usage": _step("m08"),
        "m09_usage_before_first_push": _step("m09"),
        "m10_unrewarded_contracts": _step("m10"),
        "m11_usage_bonus": _step("m11"),
        "m12_campaign_bonus": _step("m12"),
        "m13_mc_contracts": _mart(contract.mc_contracts),
        "m14_bnpl_usage_calls": _mart(usage_calls.push_usage_calls, bnpl=True),
        "m15_bnpl_usage_bonus": _step("m15"),
        # parameter variants of FIXTURES.md
        "m07_push_usage_calls_backfill": _mart(usage_calls.push_usage_calls, rules=TEST_BACKFILL_RULES),
        "m08_push_usage_cutover": _step("m08", rules=TEST_CUTOVER_RULES),
        "m11_usage_bonus_cutover": _step("m11", rules=TEST_CUTOVER_RULES),
        "m04_sending_lead_14_days": _mart(lead.sending_lead, days=14),
        # operator-level checks over whole tables
        "j01_validity_join": _mart(checks.validity_calls),
        "j02_validity_left_join": _mart(checks.validity_left),
        "j05_signup_band": _mart(checks.signup_band),
        "j07_appointment_band": _mart(checks.appointment_band),
        "j09_approval_band": _mart(checks.approval_band),
        "j10_callback_pairs": _mart(checks.callback_pairs),
        "j10_callback_days": _mart(checks.callback_days),
        "j11_active_contracts": _mart(checks.active_contracts),
        "j12_withdrawal_counts": _mart(checks.withdrawal_counts),
        "j12_card_withdrawals_left": _mart(checks.card_withdrawals_left),
        "j13_laid_out_usage": _mart(checks.laid_out_usage),
        "j15_next_calls": _mart(checks.next_calls),
        "j16_contracts_without_usage": _mart(checks.contracts_without_usage),
        "j17_roster_calls": _mart(checks.roster_calls),
        "w01_latest_call_per_client": _mart(checks.latest_call_per_client),
        "w04_earliest_call_per_client_day": _mart(checks.earliest_call_per_client_day),
        "w06_first_and_last_per_contact": _mart(checks.first_and_last_per_contact),
        "w07_contract_sequence": _mart(checks.contract_sequence),
        "u01_applications": _mart(checks.applications),
        "u02_client_outcomes": _mart(checks.client_outcomes),
        "a01_calls_per_agent_month": _mart(checks.calls_per_agent_month),
        "a03_account_usage": _mart(checks.account_usage),
        "f11_log_rules": _mart(checks.log_rules),
        "f13_call_rules": _mart(checks.call_rules),
        "f16_contract_rules": _mart(checks.contract_rules),
        "f19_merchant_rules": _mart(checks.merchant_rules),
        "f20_flag_rules": _mart(checks.flag_rules),
        "x01_date_rules": _mart(checks.date_rules),
        "x15_campaign_rules": _mart(checks.campaign_rules),
        "q06_validity_overlaps": _mart(checks.agent_validity_overlaps),
        # load modes and the refresh
        **loads.QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    from ..oracle import attribution_sql as A
    from ..functions.rules import TEST_BACKFILL_RULES, TEST_CUTOVER_RULES
    from ..oracle import bonus_sql as B
    from ..oracle import checks_sql as C
    from ..oracle import loads_sql as L
    from ..oracle import usage_sql as U
    a, r = TEST_AS_OF, TEST_RULES
    return {
        "m01_connected_calls": A.connect_sql(a, r),
        "m02_connected_clients": A.connect_sql(a, r, clients=True),
        "m03_mobile_signups": A.mobile_sql(a, r),
        "m04_sending_lead": A.sending_lead_sql(a, r),
        "m05_pushing_sign": A.pushing_sign_sql(a, r),
        "m06_call_tasks": U.call_task_sql(a, r),
        "m07_push_usage_calls": U.push_usage_call_sql(a, r),
        "m08_push_usage": B.push_usage_sql(a, r),
        "m09_usage_before_first_push": B.before_push_sql(a, r),
        "m10_unrewarded_contracts": B.no_push_sql(a, r),
        "m11_usage_bonus": B.usage_bonus_sql(a, r),
        "m12_campaign_bonus": B.campaign_bonus_sql(a, r),
        "m13_mc_contracts": A.mc_contract_sql(a, r),
        "m14_bnpl_usage_calls": U.push_usage_call_sql(a, r, bnpl=True),
        "m15_bnpl_usage_bonus": B.bnpl_bonus_sql(a, r),
        "m07_push_usage_calls_backfill": U.push_usage_call_sql(a, TEST_BACKFILL_RULES),
        "m08_push_usage_cutover": B.push_usage_sql(a, TEST_CUTOVER_RULES),
        "m11_usage_bonus_cutover": B.usage_bonus_sql(a, TEST_CUTOVER_RULES),
        "m04_sending_lead_14_days": A.sending_lead_sql(a, r, days=14),
        **C.checks_sql(a, r),
        **L.loads_sql(loads.EARLIER, a, r),
    }
