"""Load modes: reruns are idempotent, rows outside the window never change,
an emptied window is emptied, kept partitions survive."""

import tempfile

from callcredit.functions.rules import TEST_AS_OF, TEST_RULES
from callcredit.plans.refresh import refresh_all
from callcredit.sources import sinks
from callcredit.sources.fixtures import load_inputs
from tests.conftest import SF_SMALL
from tests.helpers import rows


def _df(spark, data):
    return spark.createDataFrame(data, "month string, v int")


def test_replace_window(spark):
    path = tempfile.mkdtemp(prefix="cc-sink-") + "/t"
    in_window = lambda m: m >= "2024-01"
    sinks.replace_window(_df(spark, [("2023-11", 1), ("2023-12", 2), ("2024-01", 3), ("2024-02", 4)]),
                         path, "month", lambda m: True)
    # new window rows replace the window; 2023-12 and older stay; 2024-02 got no rows -> removed
    stale = sinks.replace_window(_df(spark, [("2024-01", 30)]), path, "month", in_window)
    assert stale == ["2024-02"] or sorted(stale) == ["2024-02"]
    t = sinks.read_table(spark, path)
    assert rows(t, "month", "v") == [("2023-11", 1), ("2023-12", 2), ("2024-01", 30)]
    # rerun: same table
    sinks.replace_window(_df(spark, [("2024-01", 30)]), path, "month", in_window)
    assert rows(sinks.read_table(spark, path), "month", "v") == [("2023-11", 1), ("2023-12", 2), ("2024-01", 30)]
    # empty window clears it; kept month survives
    sinks.replace_window(_df(spark, [("2099-01", 1)]).limit(0), path, "month", lambda m: m >= "2023-11",
                         keep=("2023-11",))
    assert rows(sinks.read_table(spark, path), "month", "v") == [("2023-11", 1)]


def test_full_refresh_and_append(spark):
    path = tempfile.mkdtemp(prefix="cc-sink-") + "/t"
    sinks.full_refresh(_df(spark, [("a", 1)]), path)
    assert sinks.append_rows(_df(spark, [("b", 2)]), path, "b") == 1
    assert rows(sinks.read_table(spark, path), "month", "v") == [("a", 1), ("b", 2)]
    sinks.full_refresh(_df(spark, [("c", 3)]), path)
    assert rows(sinks.read_table(spark, path), "month", "v") == [("c", 3)]


def test_refresh_rerun_is_idempotent(spark):
    target = tempfile.mkdtemp(prefix="cc-refresh-")
    inputs = load_inputs(spark, SF_SMALL)
    paths = refresh_all(spark, inputs, TEST_AS_OF, target, TEST_RULES)
    first = {n: rows(sinks.read_table(spark, p)) for n, p in paths.items()}
    refresh_all(spark, inputs, TEST_AS_OF, target, TEST_RULES)
    second = {n: rows(sinks.read_table(spark, p)) for n, p in paths.items()}
    assert first == second
    assert len(paths) == 15
    assert sum(len(v) for v in first.values()) > 0


def test_refresh_with_empty_windows(spark):
    """A run whose windows hold no data writes empty marts that downstream reads accept."""
    from callcredit.functions.dates import as_datetime
    target = tempfile.mkdtemp(prefix="cc-empty-")
    paths = refresh_all(spark, load_inputs(spark, SF_SMALL), as_datetime("2031-06-15 08:00:00"), target, TEST_RULES)
    assert len(paths) == 15


def test_refresh_later_keeps_rows_before_the_window(spark):
    """Rows of K1 partitions before a later run's window never change."""
    import datetime as dt
    from pyspark.sql import functions as F
    target = tempfile.mkdtemp(prefix="cc-later-")
    inputs = load_inputs(spark, SF_SMALL)
    paths = refresh_all(spark, inputs, TEST_AS_OF, target, TEST_RULES)
    later = TEST_AS_OF + dt.timedelta(days=7)
    kept = {}
    for name, part, bound in (("sending_lead", "sign_day", "2024-01-31"), ("push_usage_call", "call_day", "2024-01-08")):
        kept[name] = rows(sinks.read_table(spark, paths[name]).where(F.col(part).cast("string") < bound))
    refresh_all(spark, inputs, later, target, TEST_RULES)
    for name, part, bound in (("sending_lead", "sign_day", "2024-01-31"), ("push_usage_call", "call_day", "2024-01-08")):
        assert rows(sinks.read_table(spark, paths[name]).where(F.col(part).cast("string") < bound)) == kept[name]
    assert sum(len(v) for v in kept.values()) > 0


def test_a_failed_full_refresh_keeps_the_old_table(spark):
    import pytest
    path = tempfile.mkdtemp(prefix="cc-sink-") + "/t"
    sinks.full_refresh(_df(spark, [("a", i) for i in range(5)]), path)
    with pytest.raises(Exception, match="USER_RAISED|mid-write"):
        sinks.full_refresh(_df(spark, [("b", i) for i in range(9)]).selectExpr(
            "month", "CASE WHEN v = 7 THEN CAST(raise_error('mid-write') AS INT) ELSE v END AS v"), path)
    assert sinks.read_table(spark, path).count() == 5
    sinks.full_refresh(sinks.read_table(spark, path).where("v < 2"), path)  # may read what it replaces
    assert sinks.read_table(spark, path).count() == 2


def test_refresh_keeps_resent_days_that_age_out(spark):
    """Days before the look-back stay, with and without a backfill run."""
    import datetime as dt
    from callcredit.functions.rules import TEST_BACKFILL_RULES
    target = tempfile.mkdtemp(prefix="cc-gap-")
    inputs = load_inputs(spark, SF_SMALL)
    paths = refresh_all(spark, inputs, TEST_AS_OF, target, TEST_BACKFILL_RULES, backfill=True)
    before = rows(sinks.read_table(spark, paths["push_usage_call"]))
    refresh_all(spark, inputs, TEST_AS_OF + dt.timedelta(days=60), target, TEST_BACKFILL_RULES)
    assert set(before) <= set(rows(sinks.read_table(spark, paths["push_usage_call"]))) and before
