"""Column rules on hand-built edge rows."""

import decimal

from pyspark.sql import functions as F

from callcredit.functions import predicates as P
from callcredit.functions import rules as R
from callcredit.functions.dates import (day_start, month_key, month_start, months_back_start,
                                        shift_months, ts_lit)
from tests.helpers import T


def one(spark, expr, schema, *values):
    df = spark.createDataFrame([values], schema)
    return df.select(expr.alias("x")).collect()[0]["x"]


def test_effective_disposition(spark):
    df = spark.createDataFrame([("none", None), ("none", "Use Agree"), (None, "Use Agree"), ("Client agrees", None)],
                               "r string, c string")
    got = [r[0] for r in df.select(P.effective_disposition(F.col("r"), F.col("c"))).collect()]
    assert got == [None, "Use Agree", None, "Client agrees"]
    got2 = [r[0] for r in df.select(P.signed_disposition(F.col("r"), F.col("c"))).collect()]
    assert got2 == ["none", "use agree", "use agree", "client agrees"]


def test_id_prefix(spark):
    df = spark.createDataFrame([("12.3",), ("12",), (".3",), (None,), ("7.1.2",)], "s string")
    assert [r[0] for r in df.select(P.id_prefix(F.col("s"))).collect()] == ["12", None, None, None, "7"]


def test_merchant_whitelist(spark):
    names = ["SENDO", "SENDONGA", "CNBENTRECTYKAYGROUP", "BE GROUP X", "bae min", None, "Foody", "booking.com",
             "BOOKINGXCOM", "ATM 01", "apple.com/bill"]
    df = spark.createDataFrame([(n,) for n in names], "m string")
    got = [r[0] for r in df.select(P.whitelisted_merchant(F.col("m"))).collect()]
    assert got == [True, False, False, True, True, None, True, True, True, False, True]


def test_counted_usage_time(spark):
    cut = T("2022-10-01")
    df = spark.createDataFrame([(T("2022-09-30 23:59:59"), "ATM"), (T("2022-10-01"), "ATM"),
                                (T("2022-10-01"), "GRAB x"), (None, "GRAB")], "t timestamp_ntz, m string")
    got = [r[0] for r in df.select(P.counted_usage_time(F.col("t"), F.col("m"), cut)).collect()]
    assert got == [T("2022-09-30 23:59:59"), None, T("2022-10-01"), None]


def test_usage_flag_thresholds(spark):
    rules = R.DEFAULT_RULES
    rows = [("VC1", T("2022-01-05"), 199999, 0), ("VC1", T("2022-01-05"), 200000, 0),
            ("CC1", T("2022-01-05"), 200000, 0), ("CC1", T("2021-01-05"), 499999, 5),
            ("CC1", T("2021-01-05"), 500000, 0), ("CC1", T("2022-10-01"), 0, 2), ("CC1", T("2022-10-01"), 0, 3),
            ("VC1", T("2022-02-28 00:00:01"), 300000, 0)]
    df = spark.createDataFrame([(p, s, decimal.Decimal(a), n) for p, s, a, n in rows],
                               "p string, s timestamp_ntz, a decimal(18,2), n long")
    got = [r[0] for r in df.select(P.usage_flag(F.col("p").like("%VC%"), F.col("s"), F.col("a"), F.col("n"),
                                                rules)).collect()]
    # the promo window ends at midnight of 2022-02-28 (BETWEEN with a date bound)
    assert got == [None, 1, None, None, 1, None, 1, None]
    got_b = [r[0] for r in df.select(P.bnpl_usage_flag(F.col("a"), F.col("n"), rules)).collect()]
    assert got_b == [None, None, None, 1, 1, None, 1, None]


def test_loan_product_mapping_order(spark):
    df = spark.createDataFrame([("CLXMCB1",), ("CLWND",), ("CLXSA1",), ("CLX01",), ("ZZZ",), (None,)], "c string")
    got = [r[0] for r in df.select(P.map_loan_product(F.col("c"))).collect()]
    assert got == ["CLXCB", "CLW", "CLW", "CLX", None, None]


def test_product_types(spark):
    df = spark.createDataFrame([("CCX",), ("CC_VCC",), ("CC_BHX",), ("BNPL1",), (None,)], "c string")
    assert [r[0] for r in df.select(P.card_product_type(F.col("c"))).collect()] == \
        ["CCX", "VCC", "OTHER", "OTHER", "OTHER"]
    assert [r[0] for r in df.select(P.bnpl_product_type(F.col("c"))).collect()] == \
        ["OTHER", "OTHER", "OTHER", "BNPL", "OTHER"]


def test_excluded_days_and_call_rule(spark):
    rules = R.TEST_RULES
    df = spark.createDataFrame([(T("2024-01-06 10:00"), "Outbound", "x", "LIST_SAS"),
                                (T("2024-01-08 10:00"), "Outbound", "x ProAct", "LIST_OTHER"),
                                (T("2024-01-12 00:00"), "Outbound", "x TLS", "LIST_OTHER"),
                                (T("2024-01-12 00:00:01"), "Outbound", "x TLS", "LIST_OTHER"),
                                (T("2024-01-13 00:00"), "Inbound", "x", "LIST_OTHER"),
                                (T("2024-01-04 00:00"), "Inbound", "x", "LIST_SAS")],
                               "t timestamp_ntz, ct string, cd string, n string")
    days = [r[0] for r in df.select(P.not_on_days(F.col("t"), rules.excluded_days)).collect()]
    assert days == [False, True, True, True, True, True]
    cat = [r[0] for r in df.select(P.counted_call(F.col("t"), F.col("ct"), F.col("cd"), F.col("n"), rules)).collect()]
    assert cat == [False, True, True, False, True, False]


def test_date_helpers(spark):
    assert shift_months(T("2024-02-29"), 1) == T("2024-03-31")  # month end sticks, like the source database
    assert shift_months(T("2024-01-31 12:00"), -2) == T("2023-11-30 12:00")
    assert months_back_start(T("2024-01-31 12:00"), 1) == T("2023-12-01")
    df = spark.createDataFrame([(T("2024-01-31 12:34:56"),)], "t timestamp_ntz")
    r = df.select(day_start(F.col("t")).alias("d"), month_start(F.col("t")).alias("m"),
                  month_key(F.col("t")).alias("k"), ts_lit("2024-01-02").alias("l")).collect()[0]
    assert (r.d, r.m, r.k, r.l) == (T("2024-01-31"), T("2024-01-01"), "2024-01", T("2024-01-02"))
    assert dict(df.select(day_start(F.col("t")).alias("d")).dtypes)["d"] == "timestamp_ntz"


def test_null_safe_inequality_and_sentinel(spark):
    df = spark.createDataFrame([(None, T("3000-01-01")), ("GAMI_TRX_LESS500K", None), ("STD", T("2024-01-01"))],
                               "s string, d timestamp_ntz")
    r = df.select(P.ne_or_null(F.col("s"), R.EXCLUDED_LIST_TYPE).alias("a"),
                  P.null_if_sentinel(F.col("d")).alias("b"), P.sentinel_if_null(F.col("d")).alias("c")).collect()
    assert [x.a for x in r] == [True, False, True]
    assert [x.b for x in r] == [None, None, T("2024-01-01")]
    assert [x.c for x in r] == [T("3000-01-01"), T("3000-01-01"), T("2024-01-01")]
