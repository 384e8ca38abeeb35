"""The production path: inputs stored as their own Parquet tables and read
with the declared schemas; filters and scalar bounds reach the scans."""

import contextlib
import io
import tempfile

from callcredit.functions.rules import TEST_AS_OF, TEST_RULES
from callcredit.plans import usage_bonus, usage_calls
from callcredit.plans.refresh import refresh_all
from callcredit.sources import sinks
from callcredit.sources.fixtures import load_inputs
from callcredit.sources.schemas import SCHEMAS
from callcredit.sources.tables import read_inputs
from tests.conftest import SF_SMALL
from tests.helpers import rows


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_stored_inputs_push_filters_and_refresh(spark):
    base = tempfile.mkdtemp(prefix="cc-inputs-")
    fixtures = load_inputs(spark, SF_SMALL)
    for name, df in fixtures.items():
        df.write.parquet(f"{base}/{name}")
    inputs = read_inputs(spark, base)
    assert {n: df.schema for n, df in inputs.items()} == SCHEMAS

    m7 = usage_calls.push_usage_calls(inputs, TEST_AS_OF, TEST_RULES)
    p = _plan(usage_bonus.push_usage(inputs, m7, TEST_AS_OF, TEST_RULES))
    txn_scan = [line for line in p.splitlines()
                if "PushedFilters" in line and "code_card_transaction_group" in line]
    assert txn_scan, p
    assert "EqualTo(code_card_transaction_group,WITHDRAWAL)" in txn_scan[0]
    assert "GreaterThan(dtime_auth_transaction,ScalarSubquery" in txn_scan[0]
    assert "LessThanOrEqual(dtime_auth_transaction,ScalarSubquery" in txn_scan[0]
    calls_scan = [line for line in p.splitlines() if "PushedFilters" in line and "channel" in line]
    assert calls_scan and "EqualTo(channel,CCXP)" in calls_scan[0]

    # the whole refresh gives the same marts from stored inputs as from the fixtures
    a = refresh_all(spark, inputs, TEST_AS_OF, tempfile.mkdtemp(prefix="cc-ref-a-"), TEST_RULES)
    b = refresh_all(spark, fixtures, TEST_AS_OF, tempfile.mkdtemp(prefix="cc-ref-b-"), TEST_RULES)
    for name in a:
        assert rows(sinks.read_table(spark, a[name])) == rows(sinks.read_table(spark, b[name])), name
