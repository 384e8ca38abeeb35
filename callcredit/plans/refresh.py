"""The whole bonus refresh, marts in dependency order, resumable.

State passes only through tables, as in the source job: each mart is written
with its load mode and downstream marts read the written table (which also cuts
the lineage, so a lost executor only recomputes one mart).

Every version that a refresh commits carries a note: the run, its parameters,
the steps of the run that the version holds, and the versions of the tables
that were read. The notes are the run's ledger (``run_ledger``); as they are
part of the commit, a step is done exactly when its version is there. A run that
is started again under its name skips steps whose version it has committed
already and whose inputs have not changed since, and does all others.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
import uuid
from collections.abc import Collection
from functools import cache

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.dates import day_floor, month_key, month_text, months_back_start
from ..operators.layout import LaidOut
from ..sources import sinks, versions
from . import campaign, connect, contract, lead, mobile, usage_bonus, usage_calls, usage_state

# Day-partitioned K1 marts store the day as text in this format.
DAY = "yyyy-MM-dd"
MARTS = ("connect", "connect_client", "mobile_app", "sending_lead", "pushing_sign", "call_task", "push_usage_call", "push_usage",
         "usage_before_first_push", "no_push_usage", "bonus_push_usage", "mc_contract", "bnpl_usage_calls", "bnpl_usage_bonus", "camp_bonus")
STATE = "withdrawal_times"
LEDGER = "mart string, version long, mode string, rows long, run string, steps array<string>, reads map<string,long>"


class Run:
    """The steps of one refresh over the tables under ``target``."""

    def __init__(self, spark: SparkSession, target: str, run: str | None, params: str, timings: dict, only: Collection[str] | None):
        self.spark, self.target, self.timings, self.only = spark, target.rstrip("/"), timings, only
        self.resumes, self.name = run is not None, run or uuid.uuid4().hex
        self.params = hashlib.sha256(params.encode()).hexdigest()
        self.reads: dict[str, int] = {}

    def path(self, mart: str) -> str:
        return f"{self.target}/{mart}"

    def table(self, mart: str, part: str | None = None) -> DataFrame:
        """The current version of a mart, without its partition column."""
        now = versions.current(self.spark, self.path(mart))
        if now is None:
            raise FileNotFoundError(f"no table {self.path(mart)}")
        self.reads[mart] = now.number
        df = versions.read(self.spark, self.path(mart), now)
        return df.drop(part) if part else df

    def _done(self, mart: str, step: str) -> bool:
        now = versions.current(self.spark, self.path(mart)) if self.resumes else None
        if now is None or now.note.get("run") != self.name or step not in now.note["steps"]:
            return False
        if now.note["params"] != self.params:
            raise ValueError(f"run {self.name} was started with other parameters")
        seen = {t: versions.current(self.spark, self.path(t)) for t in now.note["reads"]}
        return all(v is not None and v.number == now.note["reads"][t] for t, v in seen.items())

    def step(self, mart: str, write, step: str | None = None, after: bool = False) -> None:
        """Does ``write(note)`` unless this run has done it; ``after`` keeps the
        steps that the table's current version holds."""
        step = step or mart
        if (self.only is not None and mart not in self.only) or self._done(mart, step):
            return
        start = time.time()
        self.reads = {}
        now = versions.current(self.spark, self.path(mart)) if after else None
        held = now.note if now and now.note.get("run") == self.name else {"steps": [], "reads": {}}

        def note() -> dict:
            # Made after the mart's plan, which is when the tables are read.
            return {"run": self.name, "params": self.params, "steps": [*held["steps"], step], "reads": held["reads"] | self.reads}

        write(note)
        self.timings[mart] = round(self.timings.get(mart, 0) + time.time() - start, 3)

    def k1(self, mart: str, build, part: str, expr, in_window, keep=()) -> None:
        def write(note):
            df = build().withColumn(part, expr)
            sinks.replace_window(df, self.path(mart), part, in_window, keep, note())
        self.step(mart, write)

    def k2(self, mart: str, build) -> None:
        def write(note):
            df = build()
            sinks.full_refresh(df, self.path(mart), note())
        self.step(mart, write)

    def k3(self, mart: str, step: str, batch: str, build, part: str, expr) -> None:
        def write(note):
            df = build().withColumn(part, expr)
            sinks.append_rows(df, self.path(mart), batch, part, note())
        self.step(mart, write, step, after=True)


def refresh_all(spark: SparkSession, inputs: dict[str, DataFrame], as_of, target: str,
                rules: R.Rules = R.DEFAULT_RULES, days: int | None = None,
                timings: dict | None = None, backfill: bool = False, run: str | None = None,
                only: Collection[str] | None = None) -> dict[str, str]:
    """Run M1-M15 and write them under ``target``; returns mart -> path.

    M7 replaces the days of its look-back only. With ``backfill`` the re-sent
    calls of the lost days are loaded too: days that receive rows are replaced,
    all other earlier days stay as they are.

    A refresh that failed goes on where it stopped if it is started again with
    the same ``run`` name and parameters; without a name everything is done.
    ``only`` names the marts to do; the tables that they read must be there.
    """
    days = rules.attribution_days if days is None else days
    params = repr((str(as_of), rules, days, backfill))
    job = Run(spark, target, run, params, {} if timings is None else timings, only)
    laid: list[LaidOut] = []
    try:
        _steps(spark, inputs, as_of, rules, days, backfill, job, laid)
    finally:
        for spent in laid:
            spent.discard()
    return {mart: job.path(mart) for mart in MARTS}


def _steps(spark: SparkSession, inputs: dict[str, DataFrame], as_of, rules: R.Rules, days: int, backfill: bool, job: Run,
           laid: list[LaidOut]) -> None:
    month1 = month_text(months_back_start(as_of, 1))
    month2 = month_text(months_back_start(as_of, 2))
    attr_day = (day_floor(as_of) - dt.timedelta(days=days)).date().isoformat()
    usage_day = (day_floor(as_of) - dt.timedelta(days=rules.usage_lookback_days)).date().isoformat()
    shared: list[DataFrame] = []

    def spent() -> LaidOut:
        # One shuffle of the transactions for M8, M9 and M15, when the first of them runs.
        if not laid:
            laid.append(usage_bonus.laid_out_withdrawals(inputs, rules))
        return laid[0]

    def kept(df: DataFrame) -> DataFrame:
        shared.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return shared[-1]

    def let_go() -> None:
        while shared:
            shared.pop().unpersist()

    c = F.col
    # M1 and M2 share one scan and agent join of the month's calls.
    joined = cache(lambda: kept(connect.qualified_calls(inputs, as_of, rules)))
    job.k1("connect", lambda: connect.connected_calls(inputs, as_of, rules, joined=joined()), "month_part", c("month"),
           lambda v: v >= month1, keep=rules.keep_months)
    job.k1("connect_client", lambda: connect.connected_clients(inputs, as_of, rules, joined=joined()), "month_part",
           c("month"), lambda v: v >= month1)
    let_go()
    job.k1("mobile_app", lambda: mobile.mobile_signups(inputs, as_of, rules), "month_part", c("sign_up_month"),
           lambda v: v >= month1)
    job.k1("sending_lead", lambda: lead.sending_lead(inputs, as_of, rules, days), "sign_day",
           F.date_format("sign_date", DAY), lambda v: v >= attr_day)
    job.k1("pushing_sign", lambda: lead.pushing_sign(inputs, as_of, rules, days), "sign_day",
           F.date_format("sign_date", DAY), lambda v: v >= attr_day)
    job.k2("call_task", lambda: usage_calls.call_tasks(inputs, as_of, rules))

    def window_calls():
        # The window's outbound calls are read three times by M7: scan them once.
        calls = kept(usage_calls.outbound_calls(inputs, as_of, rules))
        found = usage_calls.push_usage_calls(inputs, as_of, rules, tasks=job.table("call_task"), calls=calls)
        return found if backfill else found.where(F.date_format("time_of_call_start", DAY) >= usage_day)

    job.k1("push_usage_call", window_calls, "call_day", F.date_format("time_of_call_start", DAY), lambda v: v >= usage_day)
    let_go()
    job.k2("push_usage", lambda: usage_bonus.push_usage(inputs, job.table("push_usage_call", "call_day"), as_of, rules, spent()))
    job.k2("usage_before_first_push",
           lambda: usage_bonus.usage_before_first_push(inputs, job.table("push_usage"), as_of, rules, spent()))

    def unrewarded():
        # Counts withdrawals since 2020 from the state, which reads only the days since the last run.
        times = usage_state.refresh_times(spark, inputs, job.path(STATE), as_of, rules)
        return usage_bonus.unrewarded_contracts(inputs, job.table("push_usage"), job.table("usage_before_first_push"), as_of, rules, times=times)

    job.k2("no_push_usage", unrewarded)
    job.k2("bonus_push_usage", lambda: usage_bonus.usage_bonus(job.table("push_usage"), job.table("usage_before_first_push"),
                                                               job.table("no_push_usage"), as_of, rules))
    job.k1("mc_contract", lambda: contract.mc_contracts(inputs, as_of, rules), "signed_month",
           month_key(c("signed_date")), lambda v: v >= month2)

    def bnpl_calls():
        calls = kept(usage_calls.outbound_calls(inputs, as_of, rules, bnpl=True))
        return usage_calls.push_usage_calls(inputs, as_of, rules, bnpl=True, calls=calls)

    job.k2("bnpl_usage_calls", bnpl_calls)
    let_go()
    job.k2("bnpl_usage_bonus", lambda: usage_bonus.bnpl_usage_bonus(inputs, job.table("bnpl_usage_calls"), as_of, rules, spent()))
    # Card rows replace the window, then the BNPL rows of the run are added once.
    job.k1("camp_bonus", lambda: campaign.card_bonus(job.table("bonus_push_usage"), as_of), "month_part", c("bonus_mth"),
           lambda v: v >= month2)
    job.k3("camp_bonus", "camp_bonus_bnpl", f"bnpl {as_of}", lambda: campaign.bnpl_bonus(job.table("bnpl_usage_bonus"), as_of),
           "month_part", c("bonus_mth"))


def run_ledger(spark: SparkSession, target: str, marts: Collection[str] = MARTS) -> DataFrame:
    """What is listed of the marts' versions: load mode, rows added, run, the
    run's steps that the version holds and the versions it has read."""
    found = [(mart, m.number, m.mode, m.rows, m.note.get("run"), m.note.get("steps"), m.note.get("reads"))
             for mart in marts for m in versions.history(spark, f"{target.rstrip('/')}/{mart}")]
    return spark.createDataFrame(found, LEDGER)
