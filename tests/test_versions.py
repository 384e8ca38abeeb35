"""Versioned tables: crashes at every step, readers in between, two writers,
retried batches, odd partition values, and refreshes that go on where they stopped."""

import datetime as dt
import inspect
import os
import tempfile

import pytest

from callcredit.functions.rules import TEST_AS_OF, TEST_RULES
from callcredit.plans import refresh, usage_bonus
from callcredit.plans.loads import BEFORE_STOP
from callcredit.plans.refresh import MARTS, refresh_all, run_ledger
from callcredit.sources import sinks, versions
from callcredit.sources.fixtures import load_inputs
from tests.conftest import SF_SMALL
from tests.helpers import rows

IN_WINDOW = lambda m: m >= "2024-01"


def df_of(spark, data):
    return spark.createDataFrame(data, "month string, v int")


def new_table(name="t"):
    return f"{tempfile.mkdtemp(prefix='cc-versions-')}/{name}"


def seen(spark, path):
    return rows(sinks.read_table(spark, path), "month", "v")


def files_of(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith((".parquet", ".json")))


OLD = [("2023-12", 1), ("2024-01", 2), ("2024-02", 3)]
WRITES = {
    "window": (lambda df, path: sinks.replace_window(df, path, "month", IN_WINDOW), [("2023-12", 1), ("2024-01", 9), ("2024-03", 9)]),
    "refresh": (sinks.full_refresh, [("2024-01", 9), ("2024-03", 9)]),
    "append": (lambda df, path: sinks.append_rows(df, path, "b1", "month"), [*OLD[:2], ("2024-01", 9), OLD[2], ("2024-03", 9)]),
}


def loaded(spark, mode):
    path = new_table()
    if mode == "refresh":
        sinks.full_refresh(df_of(spark, OLD), path)
    else:
        sinks.replace_window(df_of(spark, OLD), path, "month", lambda m: True)
    return path


class Crash(RuntimeError):
    pass


def _crash(*args, **kw):
    raise Crash


@pytest.mark.parametrize("mode", WRITES)
@pytest.mark.parametrize("step", ["write_rows", "commit", "torn", "after commit"])
def test_a_crash_at_any_step_leaves_one_version(spark, monkeypatch, mode, step):
    write, after = WRITES[mode]
    path, new = loaded(spark, mode), df_of(spark, [("2024-01", 9), ("2024-03", 9)])
    held = sinks.read_table(spark, path)
    with monkeypatch.context() as patch, pytest.raises(Crash):
        if step == "torn":
            whole = versions.Files.create

            def half(self, text, *parts):
                whole(self, text[:len(text) // 2], *parts)
                raise Crash
            patch.setattr(versions.Files, "create", half)
        elif step == "write_rows":
            real = versions.write_rows

            def died_after_writing(*args):
                real(*args)
                raise Crash
            patch.setattr(versions, "write_rows", died_after_writing)
        else:
            patch.setattr(versions, "commit" if step == "commit" else "vacuum", _crash)
        write(new, path)
    assert seen(spark, path) == (after if step == "after commit" else OLD)
    assert rows(held, "month", "v") == OLD  # the reader's frame is older than the crash
    added = write(new, path)  # the retry ends the work, whatever was left
    assert seen(spark, path) == after
    assert added == (0 if step == "after commit" else 2) or mode != "append"
    named = {f for m in versions.history(spark, path) for fs in m.folders.values() for f in fs}
    assert {f.split("/data/")[1].rsplit("/", 1)[0] for f in files_of(f"{path}/data")} == named  # no rows of dead writers


@pytest.mark.parametrize("mode", WRITES)
def test_readers_see_one_version_and_change_nothing(spark, monkeypatch, mode):
    """A reader right before and right after the manifest appears, with the data all there."""
    write, after = WRITES[mode]
    path, between = loaded(spark, mode), []
    real = versions.Files.create

    def watched(self, text, *parts):
        before = files_of(path)
        between.append(seen(spark, path))
        assert files_of(path) == before
        made = real(self, text, *parts)
        between.append(seen(spark, path))
        return made

    monkeypatch.setattr(versions.Files, "create", watched)
    write(df_of(spark, [("2024-01", 9), ("2024-03", 9)]), path)
    assert between == [OLD, after]


def test_no_version_needs_a_rename():
    """Object stores copy on rename: nothing of a table is renamed, moved or overwritten."""
    for module in (versions, sinks):
        source = inspect.getsource(module)
        assert ".rename(" not in source and ".moveTo" not in source and 'mode("overwrite")' not in source
    assert "create(p, False)" in inspect.getsource(versions.Files.create)


def test_the_slower_of_two_writers_fails(spark, monkeypatch):
    path = loaded(spark, "refresh")
    real = versions.write_rows

    def overtaken(df, where, part_col):
        folders = real(df, where, part_col)
        monkeypatch.setattr(versions, "write_rows", real)
        sinks.full_refresh(df_of(spark, [("2025-01", 5)]), path)
        return folders

    monkeypatch.setattr(versions, "write_rows", overtaken)
    with pytest.raises(versions.ConcurrentWrite):
        sinks.full_refresh(df_of(spark, [("2024-09", 7)]), path)
    assert seen(spark, path) == [("2025-01", 5)]
    # both ask for the same number: the file system gives it to one
    now = versions.current(spark, path)
    monkeypatch.setattr(versions.Files, "create", lambda self, text, *parts: False)
    with pytest.raises(versions.ConcurrentWrite):
        versions.commit(spark, path, now, now)


def test_window_moves_kept_partitions_by_name_only(spark):
    path = loaded(spark, "window")
    kept = versions.current(spark, path).folders["2023-12"]
    emptied = sinks.replace_window(df_of(spark, [("2024-03", 8)]), path, "month", IN_WINDOW, keep=("2024-01",))
    assert emptied == ["2024-02"] and seen(spark, path) == [("2023-12", 1), ("2024-01", 2), ("2024-03", 8)]
    assert versions.current(spark, path).folders["2023-12"] == kept
    assert versions.current(spark, path).rows == 1


def test_old_versions_stay_readable_until_vacuumed(spark):
    path = new_table()
    for n in range(4):
        sinks.full_refresh(df_of(spark, [("2024-01", n)]), path)
    assert [m.number for m in versions.history(spark, path)] == [3, 4]
    assert rows(sinks.read_table(spark, path, version=3), "v") == [(2,)]
    with pytest.raises(FileNotFoundError):
        sinks.read_table(spark, path, version=1)
    with pytest.raises(FileNotFoundError):
        sinks.read_table(spark, new_table())
    assert len(os.listdir(f"{path}/data")) == 2


def test_batches_add_their_rows_once(spark):
    path = new_table()
    twice = [("2024-01", 1), ("2024-01", 1), ("2024-02", None), (None, 4)]
    assert sinks.append_rows(df_of(spark, twice), path, "a", "month") == 4
    assert sinks.append_rows(df_of(spark, twice[::-1]).repartition(3), path, "a", "month") == 0  # order doesn't matter
    assert seen(spark, path) == rows(df_of(spark, twice), "month", "v")
    for other in (twice[1:], [*twice, ("2024-02", 7)], [("2024-01", 1), ("2024-01", 2), *twice[2:]], twice[:3], []):
        with pytest.raises(sinks.BatchMismatch):
            sinks.append_rows(df_of(spark, other), path, "a", "month")
    assert seen(spark, path) == rows(df_of(spark, twice), "month", "v")
    assert sinks.append_rows(df_of(spark, twice), path, "b", "month") == 4  # another batch with equal rows counts
    assert sinks.read_table(spark, path).count() == 8
    # a window that replaces what batches had added forgets them there, and only there
    sinks.replace_window(df_of(spark, [("2024-02", 5)]), path, "month", lambda m: m == "2024-02")
    assert sinks.append_rows(df_of(spark, twice), path, "a", "month") == 1
    assert rows(sinks.read_table(spark, path).where("month = '2024-02'"), "v") == [(None,), (5,)]
    # an empty batch makes a table, or changes nothing
    empty = new_table()
    assert sinks.append_rows(df_of(spark, []), empty, "a") == 0 and seen(spark, empty) == []
    assert sinks.append_rows(df_of(spark, []), path, "none", "month") == 0


def test_schema_and_partitioning_cannot_change_unnoticed(spark):
    path = loaded(spark, "window")
    with pytest.raises(ValueError, match="columns"):
        sinks.append_rows(spark.createDataFrame([("2024-01", "x")], "month string, v string"), path, "a", "month")
    with pytest.raises(ValueError, match="partitioned"):
        sinks.append_rows(df_of(spark, OLD), path, "a")
    with pytest.raises(ValueError, match="commit_id"):
        sinks.full_refresh(spark.createDataFrame([(1,)], "commit_id int"), new_table())


def test_odd_partition_values(spark):
    path = new_table()
    odd = [(None, 1), ("a b", 2), ("x=y/z", 3), ("50%", 4), ("é:1", 5)]
    sinks.replace_window(df_of(spark, odd), path, "month", lambda m: True)
    assert seen(spark, path) == rows(df_of(spark, odd), "month", "v")
    sinks.replace_window(df_of(spark, [("a b", 9)]), path, "month", lambda m: m in ("a b", "x=y/z"))
    assert seen(spark, path) == rows(df_of(spark, [odd[0], ("a b", 9), *odd[3:]]), "month", "v")


def test_a_stopped_refresh_goes_on(spark, monkeypatch):
    """Killed in M10: the rerun skips M1-M9, does the rest, and gives the tables of an undisturbed run."""
    inputs, target, whole = load_inputs(spark, SF_SMALL), tempfile.mkdtemp(prefix="cc-resume-"), tempfile.mkdtemp(prefix="cc-whole-")
    with monkeypatch.context() as patch, pytest.raises(Crash):
        patch.setattr(usage_bonus, "unrewarded_contracts", _crash)
        refresh_all(spark, inputs, TEST_AS_OF, target, TEST_RULES, run="night")
    assert [m for m in MARTS if versions.current(spark, f"{target}/{m}")] == list(BEFORE_STOP)
    timings = {}
    paths = refresh_all(spark, inputs, TEST_AS_OF, target, TEST_RULES, run="night", timings=timings)
    assert not set(timings) & set(BEFORE_STOP) and set(timings) == set(MARTS) - set(BEFORE_STOP)
    undisturbed = refresh_all(spark, inputs, TEST_AS_OF, whole, TEST_RULES)
    for mart in MARTS:
        assert rows(sinks.read_table(spark, paths[mart])) == rows(sinks.read_table(spark, undisturbed[mart])), mart
    ledger = {(r["mart"], r["version"]): r for r in run_ledger(spark, target).collect()}
    assert {m for m, _ in ledger} == set(MARTS) and {r["run"] for r in ledger.values()} == {"night"}
    assert ledger["no_push_usage", 1]["reads"] == {"push_usage": 1, "usage_before_first_push": 1}
    for (mart, version), r in ledger.items():
        if version == 1 and (mart, 2) not in ledger:
            assert r["rows"] == sinks.read_table(spark, paths[mart]).count()
    # once more: nothing to do
    timings = {}
    refresh_all(spark, inputs, TEST_AS_OF, target, TEST_RULES, run="night", timings=timings)
    assert set(timings) <= {"camp_bonus"}  # a batch without rows leaves no version
    # a table changed by someone else is made anew, and what reads it
    chain = ("push_usage", "usage_before_first_push", "no_push_usage")
    sinks.full_refresh(sinks.read_table(spark, paths["push_usage"]), paths["push_usage"])
    timings = {}
    refresh_all(spark, inputs, TEST_AS_OF, target, TEST_RULES, run="night", timings=timings, only=chain)
    assert set(timings) == set(chain)
    with pytest.raises(ValueError, match="other parameters"):
        refresh_all(spark, inputs, TEST_AS_OF + dt.timedelta(days=1), target, TEST_RULES, run="night", only=("connect",))


def test_bnpl_rows_are_added_once_after_a_crash(spark, monkeypatch):
    """M12 stopped between its card rows and its BNPL rows, and after both."""
    path = new_table("marts")
    card = spark.createDataFrame([("2024-01", "CCX", 1), ("2024-02", "CCX", 2)], "bonus_mth string, product_gr string, n int")
    bnpl = spark.createDataFrame([("2024-01", "BNPL", 1)], "bonus_mth string, product_gr string, n int")
    monkeypatch.setattr(refresh.campaign, "card_bonus", lambda df, as_of: card)
    monkeypatch.setattr(refresh.campaign, "bnpl_bonus", _crash)
    for mart in ("bonus_push_usage", "bnpl_usage_bonus"):
        sinks.full_refresh(card, f"{path}/{mart}")
    again = dict(spark=spark, inputs={}, as_of=TEST_AS_OF, target=path, rules=TEST_RULES, run="r", only=("camp_bonus",))
    with pytest.raises(Crash):
        refresh_all(**again)
    monkeypatch.setattr(refresh.campaign, "bnpl_bonus", lambda df, as_of: bnpl)
    table = sorted([("2024-01", "BNPL", 1), ("2024-01", "CCX", 1), ("2024-02", "CCX", 2)])
    for _ in range(2):
        refresh_all(**again)
        assert rows(sinks.read_table(spark, f"{path}/camp_bonus"), "bonus_mth", "product_gr", "n") == table
    assert [(m.mode, m.rows, m.note["steps"]) for m in versions.history(spark, f"{path}/camp_bonus")] == [
        (sinks.REPLACE, 2, ["camp_bonus"]), (sinks.APPEND, 1, ["camp_bonus", "camp_bonus_bnpl"])]
    refresh_all(**again | {"run": None})  # a new run replaces the window, BNPL rows and their ledger with it
    assert rows(sinks.read_table(spark, f"{path}/camp_bonus"), "bonus_mth", "product_gr", "n") == table
