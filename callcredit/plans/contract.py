"""Signed contracts credited to the last successful sign call."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import rules as R
from ..functions.dates import minus_minutes, month_start, months_back_start, ts_lit
from ..operators.sets import union_all

PICK = ["time_of_call_end", "time_of_call_start", "username", "sign_date", "approve_date",
        "name_credit_status", "product_gr", "ct_cuid"]


def mc_contracts(inputs, as_of, rules: R.Rules = R.DEFAULT_RULES) -> DataFrame:
    """Contracts signed in the last two months whose calls between approval
    (minus one minute) and signature from the two sign teams total at least
    15 seconds; credited to the latest ``sign successful`` call by call end.

    The latest call and the duration total share their grouping key
    (client, contract, sign month), so both come out of one aggregate: one
    shuffle, partial aggregation before it, no join back.
    """
    b3, b2 = months_back_start(as_of, 3), months_back_start(as_of, 2)
    live = ((F.col("preprocess_date") >= ts_lit(b3 - dt.timedelta(days=15)))
            & (F.col("sign_date") >= ts_lit(b2))
            & F.col("name_credit_status").isin(*R.LIVE_STATUSES)
            & F.col("cancel_date").isNull())
    cols = ["contract_code", F.col("cuid").alias("ct_cuid"), "approve_date", "sign_date",
            "name_credit_status", "product_gr"]
    ct = union_all(inputs["appl_loan"].where(live).select(*cols),
                   inputs["appl_card"].where(live & (F.col("sign_date") > ts_lit(rules.card_sign_after)))
                   .select(*cols))
    calls = (inputs["call_disp"]
             .where((F.col("time_of_call_start") >= ts_lit(b3)) & F.col("team").isin(*R.SIGN_TEAMS))
             .select("cuid", "time_of_call_start", "time_of_call_end", "durations", "username",
                     (P.signed_disposition(F.col("response_result_2"), F.col("code_disposition"))
                      == R.SIGN_SUCCESSFUL).alias("signed")))
    ts = F.col("time_of_call_start")
    j = calls.join(ct, (F.col("cuid") == F.col("ct_cuid").cast("string"))
                   & (ts > minus_minutes(F.col("approve_date"), 1)) & (ts < F.col("sign_date")))
    pick = F.struct(F.col("time_of_call_end").isNull().alias("_end_null"), *PICK)
    agg = (j.groupBy("cuid", "contract_code", month_start(F.col("sign_date")).alias("sign_month"))
            .agg(F.sum("durations").alias("sum_durations"),
                 F.max(F.when(F.col("signed"), pick)).alias("p")))
    return (agg.where((F.col("sum_durations") >= R.MIN_CALL_SECONDS) & F.col("p").isNotNull())
               .select(F.col("p.time_of_call_start").alias("time_of_call_start"),
                       F.col("p.time_of_call_end").alias("time_of_call_end"),
                       F.col("p.sign_date").alias("signed_date"),
                       F.col("p.ct_cuid").alias("cuid"),
                       "contract_code",
                       F.col("p.username").alias("user_name"),
                       F.col("p.name_credit_status").alias("name_credit_status"),
                       ts_lit(as_of).alias("inserted_date"),
                       F.col("p.approve_date").alias("approve_date"),
                       F.col("p.product_gr").alias("product_gr")))
