"""Facts laid out once by key, next events and counts by ranks: against brute
force, on hot keys, and what their plans read and shuffle."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from callcredit.functions.rules import TEST_AS_OF, TEST_RULES
from callcredit.operators.layout import SALT, lay_out
from callcredit.operators.windows import later_within_days, next_event
from callcredit.plans import registry, usage_bonus, usage_state
from callcredit.sources import versions
from callcredit.sources.fixtures import load_inputs
from tests.conftest import SF_SMALL
from tests.helpers import rows

DAY = dt.datetime(2024, 1, 1)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def above_scans(plan: str, table: str) -> list[list[str]]:
    """The nodes above each scan of a table, from the scan up, but for those that
    only make a bloom filter."""
    lines = plan.split("\n")
    found = [nodes_above(lines, i) for i, line in enumerate(lines) if "FileScan" in line and table in line]
    return [nodes for nodes in found if not any("bloom_filter_agg" in n for n in nodes)]


def nodes_above(lines: list[str], at: int) -> list[str]:
    nodes, depth = [], len(lines[at]) - len(lines[at].lstrip(" :+-"))
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            nodes.append(line.strip(" :+-"))
            depth = indent
    return nodes


@pytest.fixture(scope="module")
def hot(spark):
    """30,000 facts, a third of them of key 0; every seventh without a key."""
    facts = spark.range(30_000).select(F.expr("CASE WHEN id % 7 = 6 THEN NULL WHEN id % 3 = 0 THEN 0 ELSE id % 500 END").alias("k"), F.col("id").alias("v"))
    laid = lay_out(facts, "k", buckets=16)
    yield facts, laid
    laid.discard()


def test_laid_out_facts_match_like_a_join(spark, hot):
    facts, laid = hot
    left = spark.range(0, 600).select((F.col("id") % 505).alias("key"), F.col("id").alias("x")).unionByName(
        spark.createDataFrame([(None, 9), (0, 7)], "key long, x long"))
    cond = F.col("v") % 11 <= F.col("x") % 11
    plain = left.join(facts, (F.col("key") == F.col("k")) & cond).select("key", "x", "v")
    assert rows(laid.match(left, "key", cond), "key", "x", "v") == rows(plain)
    assert laid.match(left, "key", cond).columns == ["key", "x", "v"]


def test_a_hot_key_is_split_over_buckets(spark, hot):
    facts, laid = hot
    heavy = {r["_heavy_key"]: r["_salts"] for r in laid.heavy.collect()}
    assert heavy[0] > 3 and len(heavy) <= laid.buckets
    assert laid.rows.where("k = 0").select(SALT).distinct().count() == heavy[0]
    sizes = [r["count"] for r in laid.rows.groupBy("_metadata.file_path").count().collect()]
    total = laid.rows.count()
    assert total == facts.where("k is not null").count()
    assert max(sizes) <= 3 * total / laid.buckets


def test_laid_out_facts_are_not_shuffled(spark, hot):
    _, laid = hot
    left = spark.range(0, 600).select(F.col("id").alias("key"))
    plan = plan_of(laid.match(left, "key", F.lit(True)))
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1  # the other side's
    shuffled = plan[plan.index("Exchange hashpartitioning"):]
    assert "hashpartitioning(key" in shuffled.split("\n")[0]


def test_laid_out_tables_leave_nothing(spark):
    laid = lay_out(spark.createDataFrame([], "k long, v long"), "k")
    assert laid.match(spark.range(3).withColumnRenamed("id", "key"), "key", F.lit(True)).collect() == []
    laid.discard()
    laid.discard()
    assert laid.name not in {t.name for t in spark.catalog.listTables()}


@pytest.fixture(scope="module")
def chain(spark):
    """Inputs, the withdrawals laid out, and M7, M8, M9, M14 as tables."""
    inputs = load_inputs(spark, SF_SMALL)
    spent = usage_bonus.laid_out_withdrawals(inputs, TEST_RULES, buckets=5)
    made = {m: registry._chain(spark, SF_SMALL, m).checkpoint() for m in ("m07", "m08", "m09", "m14")}
    yield inputs, spent, made
    spent.discard()


def test_marts_read_the_laid_out_withdrawals(spark, chain):
    """M8, M9, M10 and M15 give the same rows from the one laid-out table, without
    the transactions and without shuffling what replaces them."""
    inputs, spent, made = chain

    def build(from_laid):
        return {
            "m08": usage_bonus.push_usage(inputs, made["m07"], TEST_AS_OF, TEST_RULES, from_laid),
            "m09": usage_bonus.usage_before_first_push(inputs, made["m08"], TEST_AS_OF, TEST_RULES, from_laid),
            "m10": usage_bonus.unrewarded_contracts(inputs, made["m08"], made["m09"], TEST_AS_OF, TEST_RULES, from_laid),
            "m15": usage_bonus.bnpl_usage_bonus(inputs, made["m14"], TEST_AS_OF, TEST_RULES, from_laid)}

    through, laid = build(None), build(spent)
    for mart, df in laid.items():
        plan = plan_of(df)
        assert spent.name in plan and "Bucketed: true" in plan and "l_extendedprice" not in plan, mart
        assert "l_extendedprice" in plan_of(through[mart]) or mart == "m10", mart
        scans = above_scans(plan, spent.name)
        assert len(scans) == 1, (mart, scans)
        join = next(i for i, node in enumerate(scans[0]) if "Join" in node)
        assert not any("Exchange" in node for node in scans[0][:join]), (mart, scans)
        assert rows(df) == rows(through[mart]), mart


def test_m10_from_the_state_of_withdrawal_times(spark, chain, tmp_path):
    """Equal to M10 after every step; later runs read new days only; state older
    than the look-back isn't touched."""
    inputs, _, made = chain
    path, late = str(tmp_path / "times"), 3
    expected = rows(usage_bonus.unrewarded_contracts(inputs, made["m08"], made["m09"], TEST_AS_OF, TEST_RULES))
    early = TEST_AS_OF - dt.timedelta(days=12)
    known = inputs | {"card_txn": inputs["card_txn"].where(F.col("dtime_auth_transaction") < F.lit(str(early)).cast("timestamp_ntz"))}
    usage_state.refresh_times(spark, known, path, early, TEST_RULES, late)
    before = versions.current(spark, path)
    times = usage_state.refresh_times(spark, inputs, path, TEST_AS_OF, TEST_RULES, late)
    assert rows(usage_bonus.unrewarded_contracts(inputs, made["m08"], made["m09"], TEST_AS_OF, TEST_RULES, times=times)) == expected
    bound = (early - dt.timedelta(days=late)).date().isoformat()
    after = versions.current(spark, path)
    assert {v: f for v, f in after.folders.items() if v < bound} == {v: f for v, f in before.folders.items() if v < bound}
    assert any(v < bound for v in after.folders) and all(before.folders.get(v) != f for v, f in after.folders.items() if v >= bound)
    plan = plan_of(usage_state.withdrawal_times({"card_txn": inputs["card_txn"]}, dt.datetime(2024, 1, 16)))
    assert "2024-01-16" in plan
    # another start of time, or an earlier run: made anew
    older = usage_state.refresh_times(spark, known, path, early, TEST_RULES, late)
    assert older.where(F.col("day") > str(early)).count() == 0
    usage_state.refresh_times(spark, inputs, path, TEST_AS_OF, TEST_RULES.replace(earliest_sign=dt.datetime(2024, 1, 20)), late)
    assert min(versions.current(spark, path).folders) >= "2024-01-20"


def test_times_of_several_accounts_of_a_contract_count_once(spark):
    from callcredit.plans.usage_state import times_since, withdrawal_times
    from tests.helpers import T, make_inputs
    hour = [T(f"2024-01-{d:02d} {h:02d}:00:00") for d in (1, 2, 3) for h in (1, 5)]
    txns = [(1, hour[0]), (1, hour[1]), (1, hour[3]), (2, hour[3]), (2, hour[4]), (1, hour[1]), (3, hour[5])]
    inputs = make_inputs(spark, contract_dim=[{"skp_contract": 10, "text_contract_number": "C1"}, {"skp_contract": 11, "text_contract_number": "C2"}],
                         card_account=[{"skp_card_account": 1, "skp_contract": 10}, {"skp_card_account": 2, "skp_contract": 10},
                                       {"skp_card_account": 3, "skp_contract": 11}],
                         card_txn=[{"skp_card_account": a, "dtime_auth_transaction": t, "code_card_transaction_group": "WITHDRAWAL"} for a, t in txns])
    pairs = spark.createDataFrame([("C1", hour[1]), ("C1", hour[4]), ("C2", hour[0]), ("C2", T("2024-02-01 00:00:00")), ("C9", hour[0])],
                                  "contract_code string, sign_date timestamp_ntz")
    found = times_since(pairs, withdrawal_times(inputs, dt.datetime(2024, 1, 1)), inputs)
    assert rows(found, "contract_code", "sign_date", "total_transaction") == [("C1", hour[1], 3), ("C1", hour[4], 1), ("C2", hour[0], 1)]


def moment(n):
    return DAY + dt.timedelta(hours=n)


def test_next_event_against_brute_force(spark):
    draw = random.Random(3)
    left = [(draw.choice([1, 2, 3, None]), draw.choice([None, *map(moment, range(20))]), draw.randrange(4)) for _ in range(120)]
    right = [(draw.choice([1, 2, 4, None]), draw.choice([None, *map(moment, range(20))]), draw.choice([None, 1, 2, 3])) for _ in range(60)]
    found = next_event(spark.createDataFrame(left, "k int, at timestamp_ntz, v int"),
                       spark.createDataFrame(right, "q int, then timestamp_ntz, w int"), [("k", "q")], "at", "then", ["w"])
    expected = []
    for k, at, v in left:
        later = [(then, w is None, w) for q, then, w in right if None not in (k, at, q, then) and q == k and then > at]
        if later:
            then, _, w = min(later, key=lambda x: (x[0], x[1], x[2] or 0))
            expected.append((k, at, v, then, w))
    assert rows(found, "k", "at", "v", "then", "w") == sorted(expected, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))
    assert expected


def test_later_within_days_against_brute_force(spark):
    draw = random.Random(4)
    calls = [(draw.choice(["a", "b", None]), draw.choice([None, *map(moment, range(0, 300, 5))])) for _ in range(200)]
    df = spark.createDataFrame(calls, "k string, at timestamp_ntz")
    for days in (1, 4):
        known = {(r["k"], r["at"]): r["n"] for r in later_within_days(df, "k", "at", days, "n").collect()}
        whole = {c for c in calls if None not in c}
        assert set(known) == whole
        for k, at in whole:
            limit = dt.datetime.combine(at.date(), dt.time()) + dt.timedelta(days=days)
            assert known[k, at] == sum(1 for q, t in calls if q == k and t is not None and at < t < limit), (k, at, days)


def test_a_busy_client_costs_its_events_not_its_pairs(spark):
    """100,000 events of one client within four days: 5e9 pairs, if any were formed."""
    busy = spark.range(100_000).select(F.lit(1).alias("k"), F.timestamp_add("SECOND", (F.col("id") * 3).cast("int"), F.lit(DAY).cast("timestamp_ntz")).alias("at"))
    start = time.time()
    assert later_within_days(busy, "k", "at", 4, "n").agg(F.sum("n")).first()[0] == 100_000 * 99_999 // 2
    other = busy.select(F.col("k").alias("q"), F.timestamp_add("SECOND", F.lit(1), F.col("at")).alias("then"))
    met = next_event(busy, other, [("k", "q")], "at", "then")
    assert met.where("then = timestampadd(SECOND, 1, at)").count() == 100_000
    assert time.time() - start < 60
