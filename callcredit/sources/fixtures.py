"""Test inputs derived from the shared test tables.

The source job's inputs are not public, so each input S1-S15 is a
deterministic projection of the driver's TPC-H-like tables (see FIXTURES.md).
The same projections are written in DuckDB SQL in ``callcredit.oracle``; both
sides must build identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import plus_days, plus_hours, plus_seconds, ts_lit

ORIGIN = "2024-01-01"


def D(n) -> Column:
    """``2024-01-01 + n days``."""
    return plus_days(ts_lit(ORIGIN), n.cast("int") if isinstance(n, Column) else n)


def H(ts: Column, n: Column) -> Column:
    return plus_hours(ts, n.cast("int"))


def _case(key: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == k, v) if expr is None else expr.when(key == k, v)
    return expr.otherwise(default) if default is not None else expr


def _tables(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def load_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = _tables(spark, sf_dir, ["supplier", "events", "orders", "customer", "lineitem"])
    sup, ev, orders, cust, li = t["supplier"], t["events"], t["orders"], t["customer"], t["lineitem"]
    c = F.col
    out: dict[str, DataFrame] = {}

    # S1 employee: two validity versions per agent.
    k = c("s_suppkey")
    even = (k % 2) == 0
    out["employee"] = sup.select(
        F.concat(F.lit("agent"), F.expr("s_suppkey div 2").cast("string")).alias("username"),
        _case(k % 3, {0: "CCX_A", 1: "QS_Internal", 2: "External Service"}).alias("team"),
        F.when(even, ts_lit("2023-01-01")).otherwise(ts_lit("2024-01-15")).alias("date_valid_from"),
        F.when(even, ts_lit("2024-01-14")).alias("date_valid_to"),
        _case(k % 5, {0: "CLX", 1: "ACLX", 2: "CCX", 3: "CCXP", 4: "TSA"}).alias("channel"),
    )

    e = c("event_id")
    dur = F.floor(c("value")).cast("int")
    # S2 raw call log.
    out["call_log"] = ev.select(
        c("ts").alias("time_of_call_start"),
        F.concat(F.lit("AGENT"), (e % 50).cast("string")).alias("resource_name"),
        c("user_id").alias("cuid"),
        dur.alias("durations"),
        _case(e % 4, {0: "Agent", 1: "Client"}, "System").alias("off_by"),
        F.when(c("event_type").isin("view", "click"), "Inbound").otherwise("Outbound").alias("call_type"),
        F.when((e % 3) == 0, "LIST_SAS").otherwise("LIST_OTHER").alias("name"),
        _case(e % 4, {0: "x ProAct", 1: "x TLS", 2: "x Pred", 3: "x"}).alias("custom_data_4"),
    )

    # S3 call dispositions.
    et = c("event_type")
    out["call_disp"] = ev.select(
        e.alias("call_id"),
        c("ts").alias("time_of_call_start"),
        plus_seconds(c("ts"), dur).alias("time_of_call_end"),
        dur.alias("durations"),
        F.when((e % 7) == 0, "Campaign Callback").otherwise("General").alias("record_type"),
        c("user_id").cast("string").alias("cuid"),
        F.when((e % 5) != 0, c("user_id")).alias("il_communication_id"),
        F.concat(F.lit("agent"), (e % 50).cast("string")).alias("username"),
        _case(et, {"purchase": "Client agrees", "click": "Sending Lead",
                   "view": "Schedule_Appointment_with_SA", "error": "Sign successful",
                   "signup": "none"}).alias("response_result_2"),
        F.when((et == "signup") & ((e % 3) == 0), "Use Agree")
         .when((et == "signup") & ((e % 3) == 1), "Sign Agree")
         .when((et == "error") & ((e % 2) == 0), "Sign successful").alias("code_disposition"),
        F.when((e % 6) == 0, "SAS_RTDM_TLS_OUTBOUND_CCX_USAGE_PUSH_CALLBACK")
         .otherwise("SAS_TLS_OUTBOUND_CCX_USAGE_PUSH").alias("call_list_gen"),
        _case(e % 3, {0: "CLX", 1: "CCX", 2: "CCXP"}).alias("channel"),
        F.when((e % 4) == 3, "Inbound").otherwise("Outbound").alias("call_type"),
        (e % 10).cast("int").alias("interaction_type_key"),
        _case(e % 3, {0: "QS_Internal", 1: "External Service", 2: "CCX_A"}).alias("team"),
        c("user_id").alias("orig_offer_id"),
    )

    # S4 backfill of the lost call days.
    out["call_backfill"] = ev.where(((e % 2) == 0) & (c("ts") >= ts_lit("2024-01-16"))
                                    & (c("ts") < ts_lit("2024-01-21"))).select(
        e.alias("call_id"),
        _case(e % 6, {0: "campaign", 2: "personal"}).alias("call_back_type"),
        F.when((e % 10) != 0, c("user_id").cast("string")).alias("il_communication_id"),
        F.when((e % 4) != 0, F.lit("BACKFILL_LIST")).alias("call_back_call_list"),
    )

    # S5 / S6 applications: loans are even order keys, cards odd.
    o = c("o_orderkey")
    day = o % 31
    status = (F.when(c("o_orderstatus") == "F", "Finished")
              .when(c("o_orderstatus") == "O", "Active")
              .when((c("o_orderstatus") == "P") & ((o % 4) < 2), "Signed")
              .when(c("o_orderstatus") == "P", "Cancelled"))
    appl_cols = [
        F.concat(F.lit("C"), o.cast("string")).alias("contract_code"),
        c("o_custkey").alias("cuid"),
        H(D(day), o % 24).alias("sign_date"),
        D(day - 2).alias("preprocess_date"),
        D(day - 5).alias("approve_date"),
        F.when((o % 10) == 9, D(40)).alias("cancel_date"),
    ]
    prio = F.substring(c("o_orderpriority"), 1, 1)
    product_code = _case(prio, {"1": "CLXMCB1", "2": "CLWND", "3": "CLXSA1", "4": "CLWAD", "5": "CLX01"})
    out["appl_loan"] = orders.where((o % 2) == 0).select(
        *appl_cols, product_code.alias("product_code"), F.lit("CLX").alias("product_gr"),
        status.alias("name_credit_status"), c("o_custkey").alias("orig_offer_id"))
    card_base = orders.where((o % 2) == 1)
    out["appl_card"] = card_base.select(
        *appl_cols, F.lit("CCX").alias("product_gr"), status.alias("name_credit_status"),
        c("o_custkey").alias("orig_offer_id"))

    # S7 card contracts with activation data.
    vc = (o % 5) == 0
    out["card_bonus"] = card_base.select(
        F.concat(F.lit("C"), o.cast("string")).alias("contract_code"),
        status.alias("name_credit_status"),
        c("o_custkey").alias("cuid"),
        D(day - 5).alias("apt_date"),
        F.concat(F.lit("agent"), (o % 50).cast("string")).alias("apt_user"),
        F.lit("CCX_A").alias("apt_team"),
        H(D(day), o % 24).alias("sign_date"),
        F.when(vc, "VC1").otherwise("CC1").alias("product_code"),
        F.when(vc, "Virtual Card").otherwise("Card").alias("product_gr"),
        ((o % 9) * 100000).cast("decimal(18,2)").alias("t_amount_usage_bonus"),
        (o % 5).cast("bigint").alias("number_trans_bonus"),
        plus_days(H(D(day), o % 24), 1).alias("f_use"),
    )

    # S8 operator roster (all agent rows, duplicates kept).
    out["operator_roster"] = out["employee"].select(
        F.upper("username").alias("username"), F.lit("CCX").alias("product"),
        F.lit("2023-12").alias("bonus_term"), F.lit("Ex_1").alias("team"))

    # S9 / S10 online sign-ups and the client dimension.
    ck = c("c_custkey")
    out["online_user"] = cust.select(ck.alias("skp_client"), D(5 + ck % 25).alias("date_effective"))
    out["client_dim"] = cust.select(ck.alias("skp_client"), ck.alias("id_cuid"))

    # S11 campaign contact list.
    out["campaign_load"] = cust.select(
        F.when((ck % 17) == 0, ck.cast("string"))
         .otherwise(F.concat(ck.cast("string"), F.lit(".1"))).alias("id_source"),
        (ck + 500).alias("skp_client"),
        D(12 + ck % 14).alias("date_campaign_start"),
        D(28 + ck % 10).alias("date_campaign_end"),
        F.when((ck % 9) == 1, "GAMI_TRX_LESS500K").when((ck % 9) != 0, "STD").alias("code_call_list_type"),
        _case(ck % 4, {0: "CCX_USAGE_X_PUSH", 1: "CCX_ACTIVATE_PUSH", 2: "ATM USAGE PUSH",
                       3: "Q_TLS_HPL_USAGE_1"}).alias("text_name_call_list"),
        F.when((ck % 10) == 0, "SMS").otherwise("TLS").alias("code_output_load_type"),
        D(5 + ck % 20).alias("date_communication_start"),
        D(ck % 20).alias("dtime_created"),
    )

    # S12 CRM applications (odd order keys).
    out["crm_appl"] = card_base.select(
        c("o_custkey").alias("id_cuid"),
        F.concat(F.lit("C"), o.cast("string")).alias("num_apl_contract"),
        _case(F.expr("(o_orderkey div 2) % 5"), {0: "CCX", 1: "CC_VCC", 2: "CC_BHX"}, "BNPL1")
         .alias("code_apl_prod_gr"),
        F.when((o % 13) == 0, ts_lit("3000-01-01")).otherwise(D(day - 15)).alias("dtime_apl_sign"),
        F.when((o % 3) == 0, D(25)).alias("dtime_apl_close"),
        F.when((o % 11) == 0, D(10)).otherwise(ts_lit("3000-01-01")).alias("dtime_apl_cancel"),
    )

    # S13 / S14 contract and card-account dimensions.
    out["contract_dim"] = orders.select(
        o.alias("skp_contract"), F.concat(F.lit("C"), o.cast("string")).alias("text_contract_number"))
    out["card_account"] = card_base.select(
        (o + 1000000).alias("skp_card_account"), o.alias("skp_contract"))

    # S15 card transactions.
    when_ = H(D((c("l_orderkey") * 7 + c("l_partkey") + c("l_linenumber") * 5) % 40), c("l_suppkey") % 24)
    out["card_txn"] = li.select(
        (c("l_orderkey") + 1000000).alias("skp_card_account"),
        _case(c("l_partkey") % 8, {0: "Foody HN", 1: "SENDONGA SHOP", 2: "Sendo VN",
                                   3: "CNBENTRECTYKAYGROUP", 4: "Be Group JSC", 5: "BAEMIN",
                                   6: "BOOKING.COM", 7: "ATM 01"}).alias("name_card_acceptor"),
        (c("l_extendedprice") * 10).cast("decimal(18,2)").alias("amt_billing"),
        when_.alias("dtime_auth_transaction"),
        when_.alias("date_transaction"),
        F.when(c("l_returnflag") == "N", "PAYMENT").otherwise("WITHDRAWAL").alias("code_card_transaction_group"),
        F.when(c("l_linenumber") <= 5, "1711699").otherwise("1").alias("skp_card_transaction_type"),
        F.when(c("l_linestatus") == "O", "a").otherwise("n").alias("code_status"),
    )
    return out
