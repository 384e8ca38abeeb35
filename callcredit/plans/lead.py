"""M4 lead attribution and M5 push-to-sign attribution."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import rules as R
from ..functions.dates import day_floor, plus_days, ts_lit
from ..operators.joins import band_join
from ..operators.sets import union_all
from ..operators.windows import latest_per


def _dispositions(inputs) -> DataFrame:
    c = inputs["call_disp"]
    return c.select("cuid", "time_of_call_start", "username", "channel", "orig_offer_id", "durations",
                    P.effective_disposition(F.col("response_result_2"), F.col("code_disposition"))
                    .alias("disposition"))


def _appointments(inputs, as_of, rules: R.Rules, days: int, preprocess_bound) -> DataFrame:
    """Loan signed within 8 days of an appointment call; last call per contract."""
    b = day_floor(as_of) - dt.timedelta(days=days)
    clw = (inputs["appl_loan"]
           .where(F.col("product_code").isin(*R.APPOINTMENT_PRODUCTS)
                  & (F.col("preprocess_date") >= ts_lit(preprocess_bound))
                  & (F.col("sign_date") >= ts_lit(b)))
           .select("contract_code", F.col("cuid").cast("string").alias("ct_cuid"),
                   F.col("cuid").alias("ct_cuid_num"), "sign_date"))
    calls = (_dispositions(inputs)
             .where((F.col("time_of_call_start") >= plus_days(ts_lit(b), -30))
                    & (F.col("durations") >= R.MIN_CALL_SECONDS)
                    & (F.col("disposition") == R.APPOINTMENT))
             .select("cuid", "time_of_call_start", "username"))
    ts, sign = F.col("time_of_call_start"), F.col("sign_date")
    cond = ((F.col("cuid") == F.col("ct_cuid")) & (ts < sign)
            & (sign < P.next_days(ts, rules.appointment_days)))
    j = band_join(calls, clw, cond, point=ts, low=plus_days(sign, -rules.appointment_days), high=sign)
    return latest_per(j, ["contract_code"], "time_of_call_start", ties=["username"])


def sending_lead(inputs, as_of, rules: R.Rules = R.DEFAULT_RULES, days: int | None = None) -> DataFrame:
    """M4 (``days`` is the look-back, 7 by default)."""
    days = rules.attribution_days if days is None else days
    b = day_floor(as_of) - dt.timedelta(days=days)
    cards = (inputs["appl_card"].where(F.col("sign_date") >= ts_lit(b))
             .select("contract_code", "cuid", "sign_date", "preprocess_date",
                     F.lit(R.CARD_PRODUCT).alias("product"), "orig_offer_id"))
    loans = (inputs["appl_loan"].where(F.col("sign_date") >= ts_lit(b))
             .select("contract_code", "cuid", "sign_date", "preprocess_date",
                     P.map_loan_product(F.col("product_code")).alias("product"), "orig_offer_id"))
    ct = (union_all(cards, loans).where(F.col("product").isin(*R.LEAD_PRODUCTS))
          .select("contract_code", F.col("cuid").alias("ct_cuid"), "sign_date", "preprocess_date",
                  "product", F.col("orig_offer_id").alias("ct_offer")))
    lead_from = day_floor(as_of) - dt.timedelta(days=rules.lead_lookback_days)
    calls = (_dispositions(inputs)
             .where((F.col("disposition") == R.SENDING_LEAD)
                    & (F.col("time_of_call_start") >= ts_lit(lead_from))
                    & (F.col("durations") >= R.MIN_CALL_SECONDS)))
    cond = ((F.col("cuid") == F.col("ct_cuid").cast("string"))
            & (F.col("ct_offer") == F.col("orig_offer_id"))
            & (F.col("time_of_call_start") < F.col("preprocess_date"))
            & (F.col("product") != F.col("channel")))
    a = latest_per(calls.join(ct, cond), ["cuid"], "time_of_call_start",
                   ties=["contract_code", "sign_date", "product", "username"])
    a = a.select("contract_code", F.col("ct_cuid").alias("cuid"), "sign_date", "product", "username",
                 "time_of_call_start")
    bpart = _appointments(inputs, as_of, rules, days, b - dt.timedelta(days=15))
    bpart = bpart.select("contract_code", F.col("ct_cuid_num").alias("cuid"), "sign_date",
                         F.lit(R.APPOINTMENT_PRODUCT).alias("product"), "username", "time_of_call_start")
    return union_all(a, bpart)


def pushing_sign(inputs, as_of, rules: R.Rules = R.DEFAULT_RULES, days: int | None = None) -> DataFrame:
    """M5: last agreeing call between approval and signature, plus appointments."""
    days = rules.attribution_days if days is None else days
    b = day_floor(as_of) - dt.timedelta(days=days)
    ct = (inputs["appl_loan"]
          .where((F.col("sign_date") >= ts_lit(b))
                 & (F.col("preprocess_date") >= ts_lit(b - dt.timedelta(days=15)))
                 & ~F.col("product_code").isin(*R.APPOINTMENT_PRODUCTS))
          .select("contract_code", F.col("cuid").cast("string").alias("ct_cuid"),
                  "approve_date", "sign_date"))
    calls = (_dispositions(inputs)
             .where((F.col("durations") >= R.MIN_CALL_SECONDS)
                    & (F.col("time_of_call_start") >= ts_lit(b - dt.timedelta(days=30)))
                    & F.col("disposition").isin(*R.SIGN_AGREED))
             .select("cuid", "time_of_call_start", "username"))
    ts = F.col("time_of_call_start")
    cond = (F.col("cuid") == F.col("ct_cuid")) & (ts > F.col("approve_date")) & (ts < F.col("sign_date"))
    a = latest_per(calls.join(ct, cond), ["cuid"], "time_of_call_start",
                   ties=["contract_code", "sign_date", "username"])
    a = a.select("contract_code", "sign_date", F.col("username").alias("pushing_user"),
                 F.col("time_of_call_start").alias("pushing_date"))
    bpart = _appointments(inputs, as_of, rules, days, day_floor(as_of) - dt.timedelta(days=15))
    bpart = bpart.select("contract_code", "sign_date", F.col("username").alias("pushing_user"),
                         F.col("time_of_call_start").alias("pushing_date"))
    return union_all(a, bpart)
