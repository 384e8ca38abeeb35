"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from callcredit.oracle.compare import compare
from callcredit.plans import registry
from tests.conftest import SF_ORACLE

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


def test_every_library_query_has_an_oracle():
    missing = sorted(set(registry.queries()) - set(registry.oracle_sql()))
    assert missing == [], f"queries without oracle SQL: {missing}"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, oracle_con, name):
    if name not in ORACLE:
        pytest.skip("no SQL form")
    df = QUERIES[name](spark, SF_ORACLE)
    res = compare(df, ORACLE[name], oracle_con)
    assert res["schema_match"], (res["spark_cols"], res["oracle_cols"])
    assert res["match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["cuid", "camp_id", "camp_start_date", "push_user", "push_date", "bonus_amt_trans",
                          "contract_code", "inserted_date", "bonus_mth", "product_gr", "num_transaction"]
