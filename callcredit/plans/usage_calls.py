"""M6 campaign task list, M7 push-usage calls and M14 BNPL push-usage calls.

M7 and M14 are one function; ``bnpl=True`` switches the window, roster,
campaign lists, contract family and product labels.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import rules as R
from ..functions.dates import day_floor, month_text, months_back_start, plus_days, shift_months, ts_lit
from ..operators.joins import band_join, restrict_to
from ..operators.sets import union_all, union_distinct

OUTPUT = ["date_campaign_start", "date_campaign_end", "text_name_call_list", "time_of_call_start",
          "time_of_call_end", "durations", "call_type", "record_type", "cuid", "il_communication_id",
          "call_id", "username", "skp_client", "code_call_list_type", "contract_code", "product_type",
          "apl_sign_dtm"]
CALL_COLS = ["time_of_call_start", "time_of_call_end", "durations", "record_type", "cuid",
             "il_communication_id", "call_id", "username", "response_result_2", "call_list_gen"]
TASK_COLS = ["date_campaign_start", "date_campaign_end", "text_name_call_list", "skp_client",
             "code_call_list_type"]


def call_tasks(inputs, as_of, rules: R.Rules = R.DEFAULT_RULES, bnpl: bool = False) -> DataFrame:
    """M6 (and the BNPL task list of M14): campaign contacts to push."""
    cl = inputs["campaign_load"]
    if bnpl:
        cond = (P.listed_task(F.col("code_output_load_type"), F.col("code_call_list_type"),
                              F.col("text_name_call_list"), [R.BNPL_LIST_PATTERN])
                & (F.col("date_communication_start") >= ts_lit(months_back_start(as_of, 2))))
    else:
        a = ts_lit(as_of)
        cond = (P.listed_task(F.col("code_output_load_type"), F.col("code_call_list_type"),
                              F.col("text_name_call_list"), R.USAGE_LIST_PATTERNS)
                & (F.col("date_communication_start") >= plus_days(a, -rules.task_comm_days))
                & (F.col("dtime_created") >= plus_days(a, -rules.task_created_days)))
    return cl.where(cond).select(P.id_prefix(F.col("id_source")).alias("il_communication_id"),
                                 "skp_client", "date_campaign_end", "date_campaign_start",
                                 "code_call_list_type", "text_name_call_list")


def _dispositioned(inputs) -> DataFrame:
    c = inputs["call_disp"]
    disp = P.effective_disposition(F.col("response_result_2"), F.col("code_disposition"))
    return c.where(P.outbound_push_call(F.col("interaction_type_key"), disp, F.col("username"),
                                        F.col("channel"), F.col("call_type"))) \
            .withColumn("response_result_2", disp)


def outbound_calls(inputs, as_of, rules: R.Rules = R.DEFAULT_RULES, bnpl: bool = False) -> DataFrame:
    """Outbound push calls of the window (``call_v_num_days``)."""
    calls = _dispositioned(inputs)
    ts = F.col("time_of_call_start")
    gap = P.outside(ts, rules.gap_start, rules.gap_end)
    if bnpl:
        since = months_back_start(as_of, 2) - dt.timedelta(days=8)
        term = month_text(shift_months(as_of, -1))
        ops = (inputs["operator_roster"]
               .where((F.col("product") == R.ROSTER_PRODUCT) & (F.col("bonus_term") == term)
                      & F.col("team").like(R.ROSTER_TEAM_PATTERN))
               .select(F.lower("username").alias("username")))
        cvd = restrict_to(calls.where((ts >= ts_lit(since)) & gap), ops, F.lower(F.col("username")), "username")
        return cvd.select(*CALL_COLS)
    since = day_floor(as_of) - dt.timedelta(days=rules.usage_lookback_days)
    regular = calls.where((ts >= ts_lit(since)) & gap).select(*CALL_COLS)
    # Calls of the lost days, relabelled from the manually re-sent table.
    bf = inputs["call_backfill"].where(F.col("il_communication_id").isNotNull()).select(
        F.col("call_id").alias("_bf_call_id"), "call_back_type",
        F.col("il_communication_id").alias("_bf_comm_id"), "call_back_call_list")
    lost = calls.where(P.inside(ts, rules.gap_start, rules.gap_end)).drop("il_communication_id", "record_type")
    backfill = lost.join(bf, F.col("call_id") == F.col("_bf_call_id")).select(
        "time_of_call_start", "time_of_call_end", "durations",
        P.backfill_record_type(F.col("call_back_type")).alias("record_type"), "cuid",
        F.col("_bf_comm_id").cast("bigint").alias("il_communication_id"), "call_id", "username",
        "response_result_2", P.backfill_call_list(F.col("call_back_call_list")).alias("call_list_gen"))
    # The source unions these with UNION (distinct). Identical call rows can only
    # produce identical output rows, and the agreed/callback union and the final
    # grouping remove those, so the result is the same without shuffling every
    # call of the window once more.
    return union_all(regular, backfill)


def push_usage_calls(inputs, as_of, rules: R.Rules = R.DEFAULT_RULES, bnpl: bool = False,
                     tasks: DataFrame | None = None, calls: DataFrame | None = None) -> DataFrame:
    """M7 (``bnpl=False``) / M14 (``bnpl=True``).

    ``calls`` may pass ``outbound_calls(...)`` already computed (persisted by
    the refresh): it is read three times below (task match, later calls and
    earlier calls of the callback join).
    """
    cvd = outbound_calls(inputs, as_of, rules, bnpl) if calls is None else calls
    if tasks is None:
        tasks = call_tasks(inputs, as_of, rules, bnpl)
    tasks = tasks.select(F.col("il_communication_id").try_cast("bigint").alias("_task_id"), *TASK_COLS)
    call_push = cvd.join(tasks, F.col("il_communication_id") == F.col("_task_id")).drop("_task_id")

    agreed = F.col("response_result_2").isin(*R.USE_AGREED) & (F.col("durations") >= R.MIN_CALL_SECONDS)
    first = call_push.where(agreed & F.col("il_communication_id").isNotNull()).select(
        *TASK_COLS[:3], "time_of_call_start", "time_of_call_end", "durations",
        P.first_call_label(F.col("call_list_gen")).alias("call_type"), "record_type", "cuid",
        "il_communication_id", "call_id", "username", "skp_client", "code_call_list_type")

    # Callbacks: later agreed calls of the client before the 4th day after a task call.
    # Only the earliest task call per (client, campaign, day) matters: a later call
    # qualifies for that day exactly when it follows that call (the day's calls share
    # the same 4-day limit). Pre-aggregating it bounds the join by campaigns, not calls.
    prev = (call_push.groupBy(F.col("cuid").alias("p_cuid"),
                              P.day_start(F.col("time_of_call_start")).alias("p_day"),
                              F.col("il_communication_id").alias("p_comm_id"), *TASK_COLS)
            .agg(F.min("time_of_call_start").alias("p_ts")))
    later = cvd.where(agreed)
    ts, p_day = F.col("time_of_call_start"), F.col("p_day")
    cond = ((F.col("cuid") == F.col("p_cuid")) & (ts > F.col("p_ts"))
            & (ts < plus_days(p_day, rules.callback_days)))
    cb = band_join(later, prev, cond, point=ts, low=p_day, high=plus_days(p_day, rules.callback_days - 1))
    callbacks = cb.select(
        *TASK_COLS[:3], "time_of_call_start", "time_of_call_end", "durations",
        P.callback_label(F.col("il_communication_id"), F.col("call_list_gen")).alias("call_type"),
        "record_type", "cuid", F.col("p_comm_id").alias("il_communication_id"), "call_id", "username",
        "skp_client", "code_call_list_type")
    agree = union_distinct(first, callbacks)

    crm = inputs["crm_appl"]
    sign = P.null_if_sentinel(F.col("dtime_apl_sign"))
    family = R.BNPL_CONTRACT_PATTERN if bnpl else R.CARD_CONTRACT_PATTERN
    contract = (crm.where(F.col("code_apl_prod_gr").like(family) & sign.isNotNull()
                          & (F.col("dtime_apl_cancel") == ts_lit(R.SENTINEL_DATE)))
                .select("id_cuid", F.col("num_apl_contract").alias("contract_code"), "code_apl_prod_gr",
                        sign.alias("apl_sign_dtm"),
                        P.sentinel_if_null(F.col("dtime_apl_close")).alias("apl_close_dtm")))
    ts = F.col("time_of_call_start")
    j = agree.join(contract, (F.col("cuid").try_cast("bigint") == F.col("id_cuid"))
                   & (ts < F.col("apl_close_dtm")) & (ts > F.col("apl_sign_dtm")), "left")
    ptype = (P.bnpl_product_type if bnpl else P.card_product_type)(F.col("code_apl_prod_gr"))
    return j.select(*OUTPUT[:14], "contract_code", ptype.alias("product_type"), "apl_sign_dtm").distinct()
