"""Usage bonus chain: M8 push usage, M9 usage before the first push,
M10 unrewarded contracts, M11 usage bonus, M15 BNPL usage bonus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import rules as R
from ..functions.dates import day_start, month_key, plus_days, ts_lit
from ..operators.aggregates import MONEY_SUM, usage_summary
from ..operators.joins import card_transactions, contract_accounts, exclude_flagged, validity_join
from ..operators.layout import LaidOut, lay_out
from ..operators.sets import union_distinct
from ..operators.windows import earliest_per, latest_per, next_event
from .usage_state import times_since

PUSH_KEYS = ["product_type", "date_campaign_start", "end_apt_push_usage", "text_name_call_list",
             "code_call_list_type", "time_of_call_start", "durations", "call_type", "cuid",
             "il_communication_id", "call_id", "username", "contract_code", "apl_sign_dtm"]
# Tie-breakers of the latest call per contact (a call can carry several contracts).
PUSH_TIES = ["call_id", "contract_code", "apl_sign_dtm", "product_type", "date_campaign_start",
             "date_campaign_end", "text_name_call_list", "code_call_list_type", "durations",
             "call_type", "cuid", "username", "time_of_call_end", "record_type", "skp_client"]


def _push_rows(calls: DataFrame, rules: R.Rules) -> DataFrame:
    """Latest call per campaign contact with the contact's first call time."""
    push = latest_per(calls, ["il_communication_id"], "time_of_call_start", ties=PUSH_TIES,
                      first="call_1st")
    return push.withColumn("end_apt_push_usage", plus_days(F.col("date_campaign_start"), rules.campaign_days))


SPENT = ["name_card_acceptor", "amt_billing", "dtime_auth_transaction", "date_transaction", "skp_card_transaction_type", "code_status"]


def laid_out_withdrawals(inputs, rules: R.Rules = R.DEFAULT_RULES, buckets: int | None = None) -> LaidOut:
    """All withdrawals since the earliest signature with their contracts, laid out
    by contract. M8, M9, M10 and M15 match them there instead of going through
    contract, account and transactions each for itself (J12, J13).

    M8's and M15's windows start after a call, so they need nothing before the
    earliest signature either, as long as calls are later than that.
    """
    since = ts_lit(rules.earliest_sign)
    recent = (F.col("dtime_auth_transaction") >= since) | (F.col("date_transaction") >= since)
    txn = (inputs["card_txn"].where((F.col("code_card_transaction_group") == R.WITHDRAWAL) & recent)
           .select(F.col("skp_card_account").alias("_txn_account"), *SPENT))
    accounts = contract_accounts(inputs["contract_dim"].select(F.col("text_contract_number").alias("contract_code")),
                                 "contract_code", inputs["contract_dim"], inputs["card_account"])
    found = accounts.join(txn, F.col("skp_card_account") == F.col("_txn_account"))
    return lay_out(found.select(F.col("contract_code").alias("spent_contract"), *SPENT), "spent_contract", buckets)


def _spent(inputs, spent: LaidOut | None, left: DataFrame, cond: F.Column, txn_filter: F.Column, columns: list[str], **bucket) -> DataFrame:
    """Withdrawals of the contracts of ``left`` that satisfy ``cond``: from the
    laid-out table, or through the accounts."""
    if spent is not None:
        return spent.match(left, "contract_code", cond & txn_filter)
    txn = inputs["card_txn"].where((F.col("code_card_transaction_group") == R.WITHDRAWAL) & txn_filter).select("skp_card_account", *columns)
    return card_transactions(contract_accounts(left, "contract_code", inputs["contract_dim"], inputs["card_account"]), txn, cond, **bucket)


def _push_usage(inputs, calls: DataFrame, as_of, rules: R.Rules, bnpl: bool, spent: LaidOut | None = None) -> DataFrame:
    push = _push_rows(calls, rules)
    if bnpl:
        t = "date_transaction"
        kept = (F.col("skp_card_transaction_type") == R.BNPL_TXN_TYPE) & (F.col("code_status") != R.BNPL_REJECTED_STATUS)
    else:
        t = "dtime_auth_transaction"
        kept = F.lit(True)
    # Exact bounds for the scan, implied by the join condition: every window
    # starts after a call of the table and ends at most 9 days (BNPL: 8 days)
    # after the latest campaign start (first call). They are lazy scalar
    # subqueries and reach the Parquet reader as pushed filters.
    low = calls.select(F.min("time_of_call_start")).scalar()
    if bnpl:
        high = calls.select(F.max(plus_days(F.col("time_of_call_start"), rules.bnpl_window_days))).scalar()
    else:
        high = calls.select(F.max(plus_days(F.col("date_campaign_start"), rules.campaign_days + 1))).scalar()
    kept = kept & (F.col(t) > low) & (F.col(t) <= high)

    # 1) withdrawals of each contact's contract in its window, collapsed and summed
    keyed = push.where(F.col("contract_code").isNotNull()).select(
        F.col("il_communication_id").alias("_k"), "contract_code", "call_1st", "end_apt_push_usage",
        "apl_sign_dtm")
    columns = ["name_card_acceptor", "amt_billing", t]
    tc, first = F.col(t), F.col("call_1st")
    if bnpl:
        upper = plus_days(first, rules.bnpl_window_days)
        cond = (tc > first) & (tc <= upper) & (tc >= F.col("apl_sign_dtm"))
        # fixed-width window: bucket by day so a busy account is split by day
        matched = _spent(inputs, spent, keyed, cond, kept, columns, point=tc, low=first, high=upper, point_side="right")
    else:
        cond = ((tc > first) & (tc <= plus_days(F.col("end_apt_push_usage"), 1))
                & (tc >= F.col("apl_sign_dtm")))
        matched = _spent(inputs, spent, keyed, cond, kept, columns)
    count_name = "num_transaction_18" if bnpl else "num_transaction"
    summary = usage_summary(matched, ["_k"], "amt_billing", t, "name_card_acceptor", rules.usage_cutover,
                            total="count" if bnpl else "distinct", count_name=count_name)

    # 2) agent team at call time; overlapping validity rows multiply the sums as in the source
    emp = (inputs["employee"].where(F.col("channel").isin(*R.USAGE_CHANNELS))
           .select(F.col("username").alias("_emp_user"), "team", "date_valid_from", "date_valid_to"))
    pe = validity_join(push.select(*PUSH_KEYS), emp, F.col("username") == F.col("_emp_user"),
                       F.col("time_of_call_start"), F.col("date_valid_from"), F.col("date_valid_to"),
                       as_of, how="left")
    j = pe.join(summary, F.col("il_communication_id").eqNullSafe(F.col("_k")), "left")
    total = (F.sum(F.coalesce("total_transaction", F.lit(0))) if bnpl
             else F.max(F.coalesce("total_transaction", F.lit(0))))
    return j.groupBy(*PUSH_KEYS, "team").agg(
        F.sum("total_amount").cast(MONEY_SUM).alias("total_amount"),
        F.sum(F.coalesce(count_name, F.lit(0))).alias(count_name),
        F.min("first_usage_date").alias("first_usage_date"),
        total.cast("bigint").alias("total_transaction"))


def push_usage(inputs, push_calls: DataFrame, as_of, rules: R.Rules = R.DEFAULT_RULES, spent: LaidOut | None = None) -> DataFrame:
    """M8: usage after the push per campaign contact (reads the M7 table)."""
    out = _push_usage(inputs, push_calls, as_of, rules, False, spent)
    return out.select("product_type", "date_campaign_start", "end_apt_push_usage", "text_name_call_list",
                      "code_call_list_type", "time_of_call_start", "durations", "call_type", "cuid",
                      "il_communication_id", "call_id", "username", "total_amount", "num_transaction",
                      "first_usage_date", "contract_code", "apl_sign_dtm", "team", "total_transaction")


def bnpl_usage_bonus(inputs, bnpl_calls: DataFrame, as_of, rules: R.Rules = R.DEFAULT_RULES, spent: LaidOut | None = None) -> DataFrame:
    """BNPL usage in the 8 days after the first call, with the BNPL flag."""
    u = _push_usage(inputs, bnpl_calls, as_of, rules, True, spent)
    return u.select(
        "date_campaign_start", "end_apt_push_usage", "text_name_call_list", "time_of_call_start",
        "durations", "call_type", F.col("cuid").cast("string").alias("cuid"), "contract_code",
        "il_communication_id", "call_id", "username", "code_call_list_type", "total_amount",
        P.bnpl_usage_flag(F.col("total_amount"), F.col("total_transaction"), rules).alias("flag_usage"),
        "num_transaction_18", "first_usage_date", "product_type", "apl_sign_dtm",
        month_key(F.col("end_apt_push_usage")).alias("bonus_mth"), "team", "total_transaction")


def _signed_cards(inputs, rules: R.Rules) -> DataFrame:
    return inputs["card_bonus"].where((F.col("sign_date") >= ts_lit(rules.earliest_sign))
                                      & ~F.col("name_credit_status").isin(R.CANCELLED))


BF_KEYS = ["contract_code", "name_credit_status", "cuid", "apt_date", "apt_user", "apt_team", "sign_date",
           "product_code", "time_of_call_start", "total_transaction"]


def usage_before_first_push(inputs, push_usage_df: DataFrame, as_of,
                            rules: R.Rules = R.DEFAULT_RULES, spent: LaidOut | None = None) -> DataFrame:
    """M9: withdrawals between signing and the client's first later push."""
    c = _signed_cards(inputs, rules).select("contract_code", "name_credit_status", "cuid", "apt_date",
                                            "apt_user", "apt_team", "sign_date", "product_code")
    p = push_usage_df.select(F.col("cuid").try_cast("bigint").alias("_p_cuid"), "time_of_call_start",
                             "total_transaction")
    # A client's cards of one signature share the push: the least card stands for them.
    card = earliest_per(c, ["cuid", "sign_date"], "contract_code",
                        ties=["name_credit_status", "apt_date", "apt_user", "apt_team", "product_code"])
    first = next_event(card, p, [("cuid", "_p_cuid")], "sign_date", "time_of_call_start", ["total_transaction"])
    t = "dtime_auth_transaction"
    tc = F.col(t)
    # every window ends before a push of the table: an exact upper bound for the scan
    latest_push = push_usage_df.select(F.max("time_of_call_start")).scalar()
    matched = _spent(inputs, spent, first, (tc >= F.col("sign_date")) & (tc < F.col("time_of_call_start")),
                     (tc >= ts_lit(rules.earliest_sign)) & (tc < latest_push), ["name_card_acceptor", "amt_billing", t])
    agg = usage_summary(matched, BF_KEYS, "amt_billing", t, "name_card_acceptor", rules.usage_cutover,
                        total=None)
    return agg.select("contract_code", "name_credit_status", "cuid", "apt_date", "apt_user", "apt_team",
                      "sign_date", "product_code", "time_of_call_start", "total_amount", "num_transaction",
                      "first_usage_date", "total_transaction")


NP_KEYS = ["contract_code", "sign_date", "cuid", "apt_user", "t_amount_usage_bonus", "number_trans_bonus",
           "f_use", "apt_team", "product_gr"]


def unrewarded_contracts(inputs, push_usage_df: DataFrame, before_push: DataFrame, as_of,
                         rules: R.Rules = R.DEFAULT_RULES, spent: LaidOut | None = None, times: DataFrame | None = None) -> DataFrame:
    """Signed card contracts with no flagged push, with their withdrawal count:
    from the state of withdrawal ``times``, or by counting the withdrawals."""
    having_push = union_distinct(
        push_usage_df.select("contract_code",
                             P.usage_flag(F.col("product_type").like("%VC%"), F.col("date_campaign_start"),
                                          F.col("total_amount"), F.col("num_transaction"), rules)
                             .alias("flag_bonus_use"), "total_transaction"),
        before_push.select("contract_code",
                           P.usage_flag(F.col("product_code").like("%VC%"), F.col("sign_date"),
                                        F.col("total_amount"), F.col("num_transaction"), rules)
                           .alias("flag_bonus_use"), "total_transaction"))
    flagged = having_push.where(F.col("flag_bonus_use") == 1)
    base = exclude_flagged(_signed_cards(inputs, rules), flagged, "contract_code").select(*NP_KEYS).distinct()
    # count(distinct withdrawal time) depends only on (contract, sign date): count per pair, attach.
    pairs = base.select("contract_code", "sign_date").distinct()
    if times is not None:
        counts = times_since(pairs, times, inputs)
    else:
        t = "dtime_auth_transaction"
        matched = _spent(inputs, spent, pairs, F.col(t) >= F.col("sign_date"), F.col(t) >= ts_lit(rules.earliest_sign), [t])
        counts = matched.groupBy("contract_code", "sign_date").agg(F.count_distinct(t).alias("total_transaction"))
    counts = counts.select(F.col("contract_code").alias("_c"), F.col("sign_date").alias("_s"), "total_transaction")
    out = base.join(counts, F.col("contract_code").eqNullSafe(F.col("_c"))
                    & F.col("sign_date").eqNullSafe(F.col("_s")), "left")
    return out.select("contract_code", "sign_date", "cuid", "apt_user",
                      F.col("t_amount_usage_bonus").alias("total_amount"),
                      F.col("number_trans_bonus").alias("num_transaction"),
                      F.col("f_use").alias("first_usage_date"), "apt_team", "product_gr",
                      F.coalesce("total_transaction", F.lit(0)).cast("bigint").alias("total_transaction"))


def usage_bonus(push_usage_df: DataFrame, before_push: DataFrame, no_push: DataFrame, as_of,
                rules: R.Rules = R.DEFAULT_RULES) -> DataFrame:
    """The three usage sources in one layout with flag and bonus month."""
    null_s, null_l = P.null_string(), F.lit(None).cast("bigint")
    money = F.col("total_amount").cast(MONEY_SUM)
    pushed = push_usage_df.select(
        "date_campaign_start", "end_apt_push_usage", "text_name_call_list", "time_of_call_start",
        "durations", "call_type", F.col("cuid").cast("string").alias("cuid"), "contract_code",
        "il_communication_id", F.col("call_id").cast("string").alias("call_id"), "username",
        "code_call_list_type", money.alias("total_amount"),
        P.usage_flag(F.col("product_type").like("%VC%"), F.col("date_campaign_start"), F.col("total_amount"),
                     F.col("num_transaction"), rules).alias("flag_usage"),
        "num_transaction", "first_usage_date", "product_type", "apl_sign_dtm",
        month_key(F.col("end_apt_push_usage")).alias("bonus_mth"), "team", "total_transaction")

    def _signed(df: DataFrame, label: str, end, promo_product) -> DataFrame:
        sd = F.col("sign_date")
        return df.select(
            sd.alias("date_campaign_start"), end.alias("end_apt_push_usage"),
            F.lit(label).alias("text_name_call_list"), sd.alias("time_of_call_start"),
            F.lit(0).alias("durations"), F.lit(label).alias("call_type"),
            F.col("cuid").cast("string").alias("cuid"), "contract_code", null_l.alias("il_communication_id"),
            null_s.alias("call_id"), F.col("apt_user").alias("username"), null_s.alias("code_call_list_type"),
            money.alias("total_amount"),
            P.usage_flag(promo_product, sd, F.col("total_amount"), F.col("num_transaction"), rules)
            .alias("flag_usage"),
            "num_transaction", "first_usage_date", F.lit(R.CARD_PRODUCT).alias("product_type"),
            sd.alias("apl_sign_dtm"), month_key(sd).alias("bonus_mth"), F.col("apt_team").alias("team"),
            "total_transaction")

    before = _signed(before_push, R.BEFORE_FIRST_PUSH, F.col("time_of_call_start"),
                     F.col("product_code").like("%VC%"))
    none = _signed(no_push, R.NO_PUSH, plus_days(day_start(F.col("sign_date")), rules.no_push_bonus_days),
                   F.col("product_gr").like("%Virtual%"))
    return union_distinct(pushed, before, none)
