"""Operators: bucketed joins equal plain joins, distributed numbering equals
row_number, top-1 picks are stable under input reordering."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from callcredit.functions.dates import day_start, plus_days
from callcredit.operators.aggregates import usage_summary
from callcredit.operators.joins import band_join, exclude_flagged, restrict_to, validity_join, validity_overlaps
from callcredit.operators.sets import union_all, union_distinct
from callcredit.operators.windows import earliest_per, first_in_group, latest_per, sequence_ids
from tests.helpers import T, rows, srt

BASE = dt.datetime(2024, 1, 1)


def _events(n, keys, seed):
    rnd = random.Random(seed)
    return [(rnd.randrange(keys), BASE + dt.timedelta(seconds=rnd.randrange(20 * 86400)), i) for i in range(n)]


def test_bucketed_band_join_equals_plain(spark):
    pts = spark.createDataFrame(_events(400, 5, 1), "k int, t timestamp_ntz, id int")
    rng = spark.createDataFrame(_events(120, 5, 2), "rk int, rt timestamp_ntz, rid int")
    t, rt = F.col("t"), F.col("rt")
    cond = (F.col("k") == F.col("rk")) & (t > rt) & (t < plus_days(day_start(rt), 4))
    plain = band_join(pts, rng, cond)
    bucketed = band_join(pts, rng, cond, point=t, low=rt, high=plus_days(day_start(rt), 3))
    assert rows(plain, "id", "rid") == rows(bucketed, "id", "rid")
    assert plain.count() > 0
    # left join preserving the point side stays exact
    lp = band_join(pts, rng, cond, "left")
    lb = band_join(pts, rng, cond, "left", point=t, low=rt, high=plus_days(day_start(rt), 3))
    assert rows(lp, "id", "rid") == rows(lb, "id", "rid")


def test_bucketed_band_join_inclusive_bounds(spark):
    pts = spark.createDataFrame([(1, T("2024-01-03 00:00:00")), (1, T("2024-01-10 00:00:00")),
                                 (1, T("2024-01-02 23:59:59"))], "k int, t timestamp_ntz")
    rng = spark.createDataFrame([(1, T("2024-01-10 00:00:00"))], "rk int, e timestamp_ntz")
    low = plus_days(F.col("e"), -7)
    cond = (F.col("k") == F.col("rk")) & F.col("t").between(low, F.col("e"))
    got = band_join(pts, rng, cond, point=F.col("t"), low=low, high=F.col("e"))
    assert rows(got, "t") == [(T("2024-01-03"),), (T("2024-01-10"),)]


def test_sequence_ids_equal_row_number(spark):
    rnd = random.Random(7)
    data = [(rnd.choice(["2024-01", "2024-02", None]), rnd.randrange(30), i) for i in range(500)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    order = [F.col("v").asc_nulls_last(), F.col("id").asc_nulls_last()]
    got = sequence_ids(df, ["g"], order, "n", slices=7)
    exp = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert rows(got, "id", "n") == rows(exp, "id", "n")


def test_latest_and_earliest_are_order_independent(spark):
    data = [(1, T("2024-01-02"), "b"), (1, T("2024-01-02"), "a"), (1, None, "c"), (2, T("2024-01-01"), "x"),
            (2, T("2024-01-03"), "y"), (None, T("2024-01-01"), "n1"), (None, T("2024-01-05"), "n2")]
    schema = "k int, t timestamp_ntz, s string"
    a = spark.createDataFrame(data, schema)
    b = spark.createDataFrame(list(reversed(data)), schema).repartition(3)
    for df in (a, b):
        # descending puts NULL first (like the source database), ties broken by s descending
        assert rows(latest_per(df, ["k"], "t", ties=["s"]), "k", "s") == srt([(1, "c"), (2, "y"), (None, "n2")])
        assert rows(earliest_per(df, ["k"], "t", ties=["s"]), "k", "s") == srt([(1, "a"), (2, "x"), (None, "n1")])


def test_first_in_group_null_key(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), (2, 5)], "k int, v int")
    assert rows(first_in_group(df, ["k"], "v", "m"), "k", "v", "m") == srt([(None, 3, 1), (None, 1, 1), (2, 5, 5)])
    got = latest_per(df, ["k"], "v", first="m")
    assert rows(got, "k", "v", "m") == srt([(None, 3, 1), (2, 5, 5)])


def test_validity_join_inclusive_end_and_open_validity(spark):
    ev = spark.createDataFrame([("a", T("2024-01-14 23:59:59")), ("a", T("2024-01-15 00:00:00")),
                                ("a", T("2024-02-01 00:00:00"))], "u string, t timestamp_ntz")
    dim = spark.createDataFrame([("a", T("2024-01-01"), T("2024-01-14"), "old"),
                                 ("a", T("2024-01-15"), None, "new")],
                                "username string, f timestamp_ntz, e timestamp_ntz, v string")
    got = validity_join(ev, dim, F.col("u") == F.col("username"), F.col("t"), F.col("f"), F.col("e"),
                        T("2024-01-31 12:00"))
    # validity end is inclusive by day; an open end stops at as_of + 1 day
    assert rows(got, "t", "v") == [(T("2024-01-14 23:59:59"), "old"), (T("2024-01-15"), "new"),
                                   (T("2024-02-01"), "new")]


def test_anti_and_semi(spark):
    df = spark.createDataFrame([("C1",), ("C2",), (None,)], "contract_code string")
    flagged = spark.createDataFrame([("C1", 1), ("C2", None)], "contract_code string, f int").where("f = 1")
    assert rows(exclude_flagged(df, flagged, "contract_code")) == srt([("C2",), (None,)])
    roster = spark.createDataFrame([("agent1",), ("agent1",)], "username string")
    calls = spark.createDataFrame([("AGENT1", 1), ("agent2", 2)], "username string, id int")
    got = restrict_to(calls, roster, F.lower(F.col("username")), "username")
    assert rows(got, "id") == [(1,)]


def test_union_distinct_nulls_equal(spark):
    a = spark.createDataFrame([(1, None), (1, None)], "a int, b string")
    b = spark.createDataFrame([(None, 1)], "b string, a int")
    assert union_distinct(a, b).count() == 1
    assert union_all(a, b).count() == 3


def test_usage_summary_collapses_identical_rows(spark):
    from decimal import Decimal
    cut = T("2022-10-01")
    df = spark.createDataFrame([(1, "GRAB", Decimal("10.00"), T("2024-01-02")),
                                (1, "GRAB", Decimal("10.00"), T("2024-01-02")),
                                (1, "ATM", Decimal("5.00"), T("2024-01-03"))],
                               "k int, m string, a decimal(18,2), t timestamp_ntz")
    r = usage_summary(df, ["k"], "a", "t", "m", cut).collect()[0]
    assert (r.total_amount, r.num_transaction, r.first_usage_date, r.total_transaction) == \
        (Decimal("15.00"), 1, T("2024-01-02"), 2)


def test_validity_overlaps(spark):
    dim = spark.createDataFrame([("a", T("2024-01-01"), T("2024-01-14")), ("a", T("2024-01-15"), None),
                                 ("b", T("2024-01-01"), T("2024-01-14")), ("b", T("2024-01-14"), None),
                                 ("c", T("2024-01-01"), None), ("c", T("2024-01-10"), T("2024-01-11"))],
                                "username string, f timestamp_ntz, e timestamp_ntz")
    got = validity_overlaps(dim, "username", "f", "e", T("2024-01-31 12:00"))
    # the end is inclusive by day: b's second version starts inside the first one
    assert rows(got, "username", "f") == [("b", T("2024-01-14")), ("c", T("2024-01-10"))]


def test_sequence_ids_many_groups_without_broadcast(spark):
    rnd = random.Random(3)
    data = [(rnd.randrange(200), rnd.randrange(5), i) for i in range(2000)]
    df = spark.createDataFrame(data, "g int, v int, id int")
    order = [F.col("v").asc_nulls_last(), F.col("id").asc_nulls_last()]
    got = sequence_ids(df, ["g"], order, "n", slices=5)
    exp = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert rows(got, "id", "n") == rows(exp, "id", "n")


def test_bucketed_band_join_random_intervals(spark):
    """Bucketed == plain for arbitrary intervals: widths 0-10 days, midnight
    bounds, inverted and NULL intervals, inner and left (points preserved)."""
    rnd = random.Random(17)

    def ts():
        if rnd.random() < 0.15:
            return BASE + dt.timedelta(days=rnd.randrange(15))          # exactly midnight
        return BASE + dt.timedelta(seconds=rnd.randrange(15 * 86400))

    pts = [(rnd.randrange(4), ts(), i) for i in range(300)]
    rngs = []
    for j in range(80):
        lo = ts()
        hi = lo + dt.timedelta(seconds=rnd.randrange(-86400, 10 * 86400))
        rngs.append((rnd.randrange(4), None if j % 17 == 0 else lo, hi, j))
    p = spark.createDataFrame(pts, "k int, t timestamp_ntz, id int")
    r = spark.createDataFrame(rngs, "rk int, lo timestamp_ntz, hi timestamp_ntz, rid int")
    t, lo, hi = F.col("t"), F.col("lo"), F.col("hi")
    cond = (F.col("k") == F.col("rk")) & (t >= lo) & (t <= hi)
    for how in ("inner", "left"):
        plain = band_join(p, r, cond, how)
        bucketed = band_join(p, r, cond, how, point=t, low=lo, high=hi)
        assert rows(plain, "id", "rid") == rows(bucketed, "id", "rid"), how


def test_sequence_ids_with_one_hot_group(spark):
    rnd = random.Random(5)
    data = [("2024-01" if rnd.random() < 0.9 else rnd.choice(["2023-12", "2024-02"]), rnd.randrange(50), i)
            for i in range(3000)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    order = [F.col("v").asc_nulls_last(), F.col("id").asc_nulls_last()]
    got = sequence_ids(df, ["g"], order, "n", slices=8)
    exp = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert rows(got, "id", "n") == rows(exp, "id", "n")


def test_sequence_ids_of_many_rows_with_payload(spark):
    """200,000 rows over several files; also when the optimiser reuses no exchange."""
    import tempfile
    path = tempfile.mkdtemp(prefix="cc-seq-") + "/t"
    (spark.range(200_000).selectExpr("id", "CAST(hash(id) % 3 AS STRING) AS g", "hash(id, 7) % 1000 AS v", "md5(CAST(id AS STRING)) AS payload")
     .repartition(9).write.parquet(path))
    df = spark.read.parquet(path)
    order = [F.col("v").asc_nulls_last(), F.col("id").asc_nulls_last()]
    exp = df.withColumn("m", F.row_number().over(Window.partitionBy("g").orderBy(*order))).select(F.col("id").alias("i"), "m")
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got = sequence_ids(df, ["g"], order, "n")
            assert got.join(exp, F.col("id") == F.col("i")).where("n = m AND payload IS NOT NULL").count() == 200_000
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
