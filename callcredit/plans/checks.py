"""Operator-level queries: each runs one operator of the library over whole
test tables (through the fixture projections), so every operator of the
inventory is checked against SQL on its own, not only inside a mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import rules as R
from ..functions.dates import day_start, minus_minutes, month_key, month_start, plus_days
from ..operators.aggregates import usage_summary
from ..operators.joins import (band_join, card_chain, card_transactions, contract_accounts, exclude_flagged,
                               restrict_to,
                               validity_join, validity_overlaps)
from ..operators.sets import union_all, union_distinct
from ..operators.windows import earliest_per, later_within_days, latest_per, next_event, sequence_ids
from .usage_bonus import laid_out_withdrawals


def validity_calls(inputs, as_of, rules) -> DataFrame:
    """Every logged call matched to the agent version valid at call time."""
    calls = inputs["call_log"].select("time_of_call_start", "resource_name", "cuid",
                                      F.lower("resource_name").alias("_agent"))
    emp = inputs["employee"].select("username", "team", "channel", "date_valid_from", "date_valid_to")
    j = validity_join(calls, emp, F.col("_agent") == F.col("username"), F.col("time_of_call_start"),
                      F.col("date_valid_from"), F.col("date_valid_to"), as_of)
    return j.select("time_of_call_start", "resource_name", "cuid", "username", "team", "channel")


def validity_left(inputs, as_of, rules) -> DataFrame:
    """Every disposition call with its push agent's team (left, NULL if none)."""
    calls = inputs["call_disp"].select("call_id", "time_of_call_start", F.col("username").alias("agent"))
    emp = (inputs["employee"].where(F.col("channel").isin(*R.USAGE_CHANNELS))
           .select("username", "team", "date_valid_from", "date_valid_to"))
    j = validity_join(calls, emp, F.col("agent") == F.col("username"), F.col("time_of_call_start"),
                      F.col("date_valid_from"), F.col("date_valid_to"), as_of, how="left")
    return j.select("call_id", "agent", "team")


def signup_band(inputs, as_of, rules) -> DataFrame:
    """J3 + J5: calls in the week up to each online sign-up (bucketed band join)."""
    su = inputs["online_user"].join(inputs["client_dim"], "skp_client").select("id_cuid", "date_effective")
    calls = inputs["call_log"].select("cuid", "time_of_call_start", "resource_name")
    eff, ts = F.col("date_effective"), F.col("time_of_call_start")
    low = plus_days(eff, -7)
    j = band_join(calls, su, (F.col("cuid") == F.col("id_cuid")) & ts.between(low, eff),
                  point=ts, low=low, high=eff)
    return j.select("cuid", "date_effective", "time_of_call_start", "resource_name")


def appointment_band(inputs, as_of, rules) -> DataFrame:
    """J4 + J7: loans signed after a call and before the call's day + 8."""
    loans = inputs["appl_loan"].select("contract_code", F.col("cuid").cast("string").alias("ct_cuid"), "sign_date")
    calls = inputs["call_disp"].select("call_id", "cuid", "time_of_call_start")
    ts, sign = F.col("time_of_call_start"), F.col("sign_date")
    cond = (F.col("cuid") == F.col("ct_cuid")) & (ts < sign) & (sign < P.next_days(ts, 8))
    j = band_join(calls, loans, cond, point=ts, low=plus_days(sign, -8), high=sign)
    return j.select("contract_code", "call_id")


def approval_band(inputs, as_of, rules) -> DataFrame:
    """Calls between approval (minus one minute) and signature."""
    loans = inputs["appl_loan"].select("contract_code", F.col("cuid").cast("string").alias("ct_cuid"),
                                       "approve_date", "sign_date")
    calls = inputs["call_disp"].select("call_id", "cuid", "time_of_call_start")
    ts = F.col("time_of_call_start")
    j = calls.join(loans, (F.col("cuid") == F.col("ct_cuid")) & (ts > minus_minutes(F.col("approve_date"), 1))
                   & (ts < F.col("sign_date")))
    return j.groupBy("contract_code").agg(F.count("call_id").alias("n_calls"))


def callback_pairs(inputs, as_of, rules) -> DataFrame:
    """Number of later calls of the same client before the 4th day after a call."""
    c = inputs["call_disp"].select("call_id", "cuid", "time_of_call_start")
    counts = later_within_days(c, "cuid", "time_of_call_start", 4, "n_later").where("n_later > 0")
    return (c.join(counts, ["cuid", "time_of_call_start"])
            .groupBy(F.col("call_id").alias("first_call_id")).agg(F.sum("n_later").alias("n_later")))


def next_calls(inputs, as_of, rules) -> DataFrame:
    """J15 + W4: every card contract with its client's first call after the signature."""
    cards = inputs["card_bonus"].select("contract_code", "cuid", "sign_date")
    calls = inputs["call_disp"].select(F.col("cuid").try_cast("bigint").alias("_cuid"), "time_of_call_start", "call_id")
    return next_event(cards, calls, [("cuid", "_cuid")], "sign_date", "time_of_call_start", ["call_id"])


def laid_out_usage(inputs, as_of, rules) -> DataFrame:
    """J13 over the laid-out withdrawals: times and money since each signature."""
    spent = laid_out_withdrawals(inputs, rules)
    cards = inputs["card_bonus"].select("contract_code", "sign_date").distinct()
    met = spent.match(cards, "contract_code", F.col("dtime_auth_transaction") >= F.col("sign_date"))
    found = met.groupBy("contract_code", "sign_date").agg(
        F.count_distinct("dtime_auth_transaction").alias("n_times"), F.sum("amt_billing").cast("decimal(38,2)").alias("amount")).checkpoint()
    spent.discard()
    return found


def active_contracts(inputs, as_of, rules) -> DataFrame:
    """Every call with the card contracts active at call time (left)."""
    sign = P.null_if_sentinel(F.col("dtime_apl_sign"))
    ct = (inputs["crm_appl"].where(sign.isNotNull())
          .select("id_cuid", F.col("num_apl_contract").alias("contract_code"), sign.alias("s"),
                  P.sentinel_if_null(F.col("dtime_apl_close")).alias("c")))
    calls = inputs["call_disp"].select("call_id", "cuid", "time_of_call_start")
    ts = F.col("time_of_call_start")
    j = calls.join(ct, (F.col("cuid").try_cast("bigint") == F.col("id_cuid")) & (ts < F.col("c")) & (ts > F.col("s")),
                   "left")
    return j.groupBy("call_id").agg(F.count("contract_code").alias("n_contracts"))


def withdrawal_counts(inputs, as_of, rules) -> DataFrame:
    """J12 + A6: distinct withdrawal times after signing per card contract (0 when none)."""
    cards = inputs["card_bonus"].select("contract_code", "sign_date").distinct()
    acc = contract_accounts(cards, "contract_code", inputs["contract_dim"], inputs["card_account"])
    t = F.col("dtime_auth_transaction")
    txn = inputs["card_txn"].where(F.col("code_card_transaction_group") == R.WITHDRAWAL)
    m = card_transactions(acc, txn, t >= F.col("sign_date"))
    counts = m.groupBy("contract_code", "sign_date").agg(F.count_distinct(t).alias("n"))
    counts = counts.select(F.col("contract_code").alias("_c"), F.col("sign_date").alias("_s"), "n")
    out = cards.join(counts, (F.col("contract_code") == F.col("_c")) & (F.col("sign_date") == F.col("_s")), "left")
    return out.select("contract_code", "sign_date", F.coalesce("n", F.lit(0)).alias("total_transaction"))


def contracts_without_usage(inputs, as_of, rules) -> DataFrame:
    """J13 + J16: card contracts with no withdrawal at all (NOT EXISTS)."""
    cards = inputs["card_bonus"].select("contract_code", "cuid")
    acc = contract_accounts(cards.select("contract_code"), "contract_code", inputs["contract_dim"],
                            inputs["card_account"])
    txn = inputs["card_txn"].where(F.col("code_card_transaction_group") == R.WITHDRAWAL)
    used = card_transactions(acc, txn, F.lit(True)).select("contract_code")
    return exclude_flagged(cards, used, "contract_code")


def roster_calls(inputs, as_of, rules) -> DataFrame:
    """Disposition calls of agents on the (distinct, lower-cased) roster."""
    ops = inputs["operator_roster"].where(F.col("team").like(R.ROSTER_TEAM_PATTERN)) \
        .select(F.lower("username").alias("username"))
    c = inputs["call_disp"].select("call_id", "username")
    return restrict_to(c, ops, F.lower(F.col("username")), "username")


def latest_call_per_client(inputs, as_of, rules) -> DataFrame:
    """Latest disposition call per client (ties by call id)."""
    c = inputs["call_disp"].select("cuid", "call_id", "time_of_call_start", "username")
    return latest_per(c, ["cuid"], "time_of_call_start", ties=["call_id"])


def earliest_call_per_client_day(inputs, as_of, rules) -> DataFrame:
    """Earliest call per client and day."""
    c = inputs["call_disp"].select("cuid", "call_id", "time_of_call_start",
                                   F.to_date("time_of_call_start").alias("call_day"))
    return earliest_per(c, ["cuid", "call_day"], "time_of_call_start", ties=["call_id"])


def first_and_last_per_contact(inputs, as_of, rules) -> DataFrame:
    """W3 + W6: latest call per campaign contact with the contact's first call."""
    c = inputs["call_disp"].select("il_communication_id", "call_id", "time_of_call_start")
    return latest_per(c, ["il_communication_id"], "time_of_call_start", ties=["call_id"], first="call_1st")


def contract_sequence(inputs, as_of, rules) -> DataFrame:
    """W7 + X17 + X18: per-month sequence ids of card contracts by signing time."""
    c = inputs["card_bonus"].select("*", month_key(F.col("sign_date")).alias("mth"))
    seq = sequence_ids(c, ["mth"], [F.col("sign_date").asc_nulls_last(), F.col("contract_code").asc_nulls_last()],
                       "n")
    cid = P.oracle_concat(F.lit("CARD_"), F.regexp_replace("mth", "-", "_"), F.lit("_"), F.col("n").cast("string"))
    return seq.select("contract_code", "mth", "n", cid.alias("camp_id"), "sign_date", "cuid")


def applications(inputs, as_of, rules) -> DataFrame:
    """U1 + F17: all applications with the mapped product."""
    cards = inputs["appl_card"].select("contract_code", "cuid", F.lit(R.CARD_PRODUCT).alias("product"))
    loans = inputs["appl_loan"].select("contract_code", "cuid",
                                       P.map_loan_product(F.col("product_code")).alias("product"))
    return union_all(cards, loans)


def client_outcomes(inputs, as_of, rules) -> DataFrame:
    """Distinct (client, outcome) pairs from both disposition precedences."""
    c = inputs["call_disp"]
    a = c.select("cuid", P.effective_disposition(F.col("response_result_2"), F.col("code_disposition"))
                 .alias("outcome"))
    b = c.select("cuid", P.signed_disposition(F.col("response_result_2"), F.col("code_disposition"))
                 .alias("outcome"))
    return union_distinct(a, b)


def calls_per_agent_month(inputs, as_of, rules) -> DataFrame:
    """A1 + A2: calls and distinct clients per agent and month, whole log."""
    g = inputs["call_log"]
    return (g.groupBy(month_key(F.col("time_of_call_start")).alias("month"), "resource_name")
             .agg(F.count(F.lit(1)).alias("calls"), F.count_distinct("cuid").alias("clients"),
                  F.sum("durations").alias("seconds")))


def account_usage(inputs, as_of, rules) -> DataFrame:
    """A3-A5, A7, A9 + F19: usage summary per card account over all withdrawals."""
    t = inputs["card_txn"].where(F.col("code_card_transaction_group") == R.WITHDRAWAL)
    return usage_summary(t, ["skp_card_account"], "amt_billing", "date_transaction", "name_card_acceptor",
                         rules.usage_cutover, total="count")


def call_rules(inputs, as_of, rules) -> DataFrame:
    """per-call rule values over the whole logs."""
    d = inputs["call_disp"]
    disp = P.effective_disposition(F.col("response_result_2"), F.col("code_disposition"))
    return d.select(
        "call_id", disp.alias("disposition"),
        P.signed_disposition(F.col("response_result_2"), F.col("code_disposition")).alias("signed"),
        P.first_call_label(F.col("call_list_gen")).alias("first_label"),
        P.callback_label(F.col("il_communication_id"), F.col("call_list_gen")).alias("callback_label"),
        P.outbound_push_call(F.col("interaction_type_key"), disp, F.col("username"), F.col("channel"),
                             F.col("call_type")).alias("outbound_push"),
        disp.isin(*R.USE_AGREED).alias("use_agreed"), disp.isin(*R.SIGN_AGREED).alias("sign_agreed"),
        P.outside(F.col("time_of_call_start"), T_GAP[0], T_GAP[1]).alias("outside_gap"))


T_GAP = ("2024-01-16", "2024-01-21")


def log_rules(inputs, as_of, rules) -> DataFrame:
    """F9, F11, F12 on the raw call log."""
    g = inputs["call_log"]
    ts = F.col("time_of_call_start")
    return g.select("time_of_call_start", "resource_name", "cuid",
                    P.qualified_call(F.col("durations"), F.col("off_by")).alias("qualified"),
                    P.counted_call(ts, F.col("call_type"), F.col("custom_data_4"), F.col("name"), rules)
                    .alias("counted"),
                    P.not_on_days(ts, rules.excluded_days).alias("not_excluded"))


def campaign_rules(inputs, as_of, rules) -> DataFrame:
    """Contact ids and list filters over the whole campaign load."""
    c = inputs["campaign_load"]
    return c.select("skp_client", P.id_prefix(F.col("id_source")).alias("il_communication_id"),
                    P.ne_or_null(F.col("code_call_list_type"), R.EXCLUDED_LIST_TYPE).alias("type_ok"),
                    P.listed_task(F.col("code_output_load_type"), F.col("code_call_list_type"),
                                  F.col("text_name_call_list"), R.USAGE_LIST_PATTERNS).alias("usage_list"),
                    P.listed_task(F.col("code_output_load_type"), F.col("code_call_list_type"),
                                  F.col("text_name_call_list"), [R.BNPL_LIST_PATTERN]).alias("bnpl_list"))


def contract_rules(inputs, as_of, rules) -> DataFrame:
    """Sentinel handling and product types over all CRM applications."""
    c = inputs["crm_appl"]
    return c.select("num_apl_contract", P.null_if_sentinel(F.col("dtime_apl_sign")).alias("apl_sign_dtm"),
                    P.sentinel_if_null(F.col("dtime_apl_close")).alias("apl_close_dtm"),
                    P.card_product_type(F.col("code_apl_prod_gr")).alias("card_type"),
                    P.bnpl_product_type(F.col("code_apl_prod_gr")).alias("bnpl_type"))


def merchant_rules(inputs, as_of, rules) -> DataFrame:
    """whitelist and counted usage time on every transaction (test cut-over)."""
    t = inputs["card_txn"]
    cut = R.TEST_CUTOVER
    return t.select("skp_card_account", "date_transaction", "name_card_acceptor", "amt_billing",
                    P.whitelisted_merchant(F.col("name_card_acceptor")).alias("whitelisted"),
                    P.counted_usage_time(F.col("date_transaction"), F.col("name_card_acceptor"), cut)
                    .alias("counted_at"),
                    ((F.col("code_card_transaction_group") == R.WITHDRAWAL)
                     & (F.col("skp_card_transaction_type") == R.BNPL_TXN_TYPE)
                     & (F.col("code_status") != R.BNPL_REJECTED_STATUS)).alias("bnpl_withdrawal"))


def flag_rules(inputs, as_of, rules) -> DataFrame:
    """usage flags over all card contracts."""
    c = inputs["card_bonus"]
    amt, n = F.col("t_amount_usage_bonus"), F.col("number_trans_bonus")
    return c.select("contract_code",
                    P.usage_flag(F.col("product_code").like("%VC%"), F.col("sign_date"), amt, n, rules)
                    .alias("flag_usage"),
                    P.bnpl_usage_flag(amt, n, rules).alias("flag_bnpl"),
                    (~F.col("name_credit_status").isin(R.CANCELLED)).alias("not_cancelled"))


def date_rules(inputs, as_of, rules) -> DataFrame:
    """Truncation, month keys and interval arithmetic on every event time."""
    g = inputs["call_disp"]
    ts = F.col("time_of_call_start")
    return g.select("call_id", day_start(ts).alias("day"), month_start(ts).alias("month_start"),
                    month_key(ts).alias("month"), plus_days(ts, 8).alias("plus8"),
                    P.next_days(ts, 4).alias("next4"), minus_minutes(ts, 1).alias("minus1m"))


def agent_validity_overlaps(inputs, as_of, rules) -> DataFrame:
    """Q6: agent versions whose validity overlaps an earlier version."""
    return validity_overlaps(inputs["employee"], "username", "date_valid_from", "date_valid_to", as_of)


def card_withdrawals_left(inputs, as_of, rules) -> DataFrame:
    """J12 literal left chain: every card contract with each withdrawal after
    signing (NULL when it has none)."""
    cards = inputs["card_bonus"].select("contract_code", "sign_date")
    t = F.col("dtime_auth_transaction")
    txn = inputs["card_txn"].where(F.col("code_card_transaction_group") == R.WITHDRAWAL) \
        .select("skp_card_account", "dtime_auth_transaction", "amt_billing")
    j = card_chain(cards, "contract_code", inputs["contract_dim"], inputs["card_account"], txn,
                   t >= F.col("sign_date"), how="left")
    return j.select("contract_code", "sign_date", "dtime_auth_transaction", "amt_billing")


def callback_days(inputs, as_of, rules) -> DataFrame:
    """J10 in the bounded form used by M7: for each call, every earlier day of
    the same client (within the 4-day band) with the first call of that day.

    The earlier side is one row per (client, day), so the output is at most
    four rows per call however busy a client is.
    """
    c = inputs["call_disp"]
    ts = F.col("time_of_call_start")
    first = (c.groupBy(F.col("cuid").alias("p_cuid"), day_start(ts).alias("p_day"))
              .agg(F.min(F.struct("time_of_call_start", "call_id")).alias("_f")))
    first = first.select("p_cuid", "p_day", F.col("_f.time_of_call_start").alias("p_ts"),
                         F.col("_f.call_id").alias("first_call_id"))
    later = c.select(F.col("call_id").alias("later_call_id"), "cuid", "time_of_call_start")
    p_day = F.col("p_day")
    cond = (F.col("cuid") == F.col("p_cuid")) & (ts > F.col("p_ts")) & (ts < plus_days(p_day, 4))
    j = band_join(later, first, cond, point=ts, low=p_day, high=plus_days(p_day, 3))
    return j.select("later_call_id", p_day.alias("callback_day"), "first_call_id")
