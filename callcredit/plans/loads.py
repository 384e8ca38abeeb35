"""The load modes and the resumed refresh as queries over the test inputs.

Each query loads tables into a folder of its own below the shared checkpoint
folder, with ``EARLIER`` as the time of a first run, and returns what readers see.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import TEST_AS_OF, TEST_RULES
from ..session import apply_session_conf, ensure_checkpoint_dir
from ..sources import sinks
from ..sources.fixtures import load_inputs
from . import usage_state
from .refresh import MARTS, refresh_all

EARLIER = TEST_AS_OF - dt.timedelta(days=10)
BEFORE_STOP = MARTS[:MARTS.index("no_push_usage")]


def _start(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], str]:
    apply_session_conf(spark)
    return load_inputs(spark, sf_dir), f"{ensure_checkpoint_dir(spark)}/marts_{uuid.uuid4().hex}"


def window_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: M4 and M5 loaded ten days apart: the first run's days before the
    second run's window stay, all later days are the second run's."""
    inputs, target = _start(spark, sf_dir)
    only = ("sending_lead", "pushing_sign")
    for as_of in (EARLIER, TEST_AS_OF):
        paths = refresh_all(spark, inputs, as_of, target, TEST_RULES, only=only)
    marts = [sinks.read_table(spark, paths[m]).select(F.lit(m).alias("mart"), "contract_code", "sign_date", "sign_day") for m in only]
    return reduce(DataFrame.unionByName, marts)


def table_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: M6 loaded twice; a frame made after the first load still reads that
    version after the second."""
    inputs, target = _start(spark, sf_dir)
    seen = []
    for as_of in (EARLIER, TEST_AS_OF):
        paths = refresh_all(spark, inputs, as_of, target, TEST_RULES, only=("call_task",))
        seen.append(sinks.read_table(spark, paths["call_task"]).withColumn("version", F.lit(len(seen) + 1)))
    return reduce(DataFrame.unionByName, seen)


def batch_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the client outcomes of M3 added as two batches, the second of them
    three times, as retries of a job would."""
    from . import mobile

    inputs, target = _start(spark, sf_dir)
    signups = mobile.mobile_signups(inputs, TEST_AS_OF, TEST_RULES)
    day = F.date_format("sign_up_date", "yyyy-MM-dd")
    for batch, part in (("odd", "cuid % 2 = 1"), ("even", "cuid % 2 = 0"), ("even", "cuid % 2 = 0"), ("even", "cuid % 2 = 0")):
        sinks.append_rows(signups.where(part).withColumn("sign_up_day", day), f"{target}/mobile_app", batch, "sign_up_day")
    return sinks.read_table(spark, f"{target}/mobile_app")


def refresh_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh that stopped after M9, started again under its name; rows of every table."""
    inputs, target = _start(spark, sf_dir)
    refresh_all(spark, inputs, TEST_AS_OF, target, TEST_RULES, run="nightly", only=BEFORE_STOP)
    paths = refresh_all(spark, inputs, TEST_AS_OF, target, TEST_RULES, run="nightly")
    counts = [sinks.read_table(spark, path).select(F.lit(mart).alias("mart")).groupBy("mart").agg(F.count("*").alias("n_rows"))
              for mart, path in paths.items()]
    return reduce(DataFrame.unionByName, counts)


def state_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 in M10: withdrawal times since every signature, from a state that was
    brought up to date three times, each time with the transactions known by then."""
    inputs, target = _start(spark, sf_dir)
    path, t = f"{target}/times", F.col("dtime_auth_transaction")
    for as_of in (EARLIER - dt.timedelta(days=9), EARLIER, TEST_AS_OF + dt.timedelta(days=30)):
        known = inputs | {"card_txn": inputs["card_txn"].where(t < F.lit(str(as_of)).cast("timestamp_ntz"))}
        times = usage_state.refresh_times(spark, known, path, as_of, TEST_RULES)
    pairs = inputs["card_bonus"].select("contract_code", "sign_date").distinct()
    return usage_state.times_since(pairs, times, inputs)


QUERIES = {
    "a06_state_merged": state_merged,
    "k01_window_reloaded": window_reloaded,
    "k02_table_refreshed": table_refreshed,
    "k03_batch_retried": batch_retried,
    "p01_refresh_resumed": refresh_resumed,
}
