"""Every registered query against its SQL at sf 0.01."""

import pytest

import __spark_entry__ as contract

from . import oracle

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_its_sql(spark, connection, name):
    df = contract.queries()[name](spark, SF)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.columns and df.count() >= 0
    else:
        assert oracle.compare(df, connection, sql) is None


def test_flagship(spark):
    assert contract.entry(spark).count() > 0


def test_no_query_takes_anothers_name():
    from tierline.plans import checks

    assert {"snapshot_replaces", "snapshot_replaces_few_files_at_a_time"} <= set(checks.QUERIES)
    with pytest.raises(ValueError):
        checks.query()(checks.QUERIES["snapshot_replaces"])
