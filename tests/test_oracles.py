"""Every registered query against its SQL oracle, over whole tables."""

import pytest

import __spark_entry__ as entry
from tools.check import duck, norm, table


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_oracle(spark, con, data, name):
    df = entry.queries()[name](spark, data)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(entry.oracle_sql()[name])
    assert got == table([d[0] for d in res.description], res.fetchall())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["conv_id", "turn", "prompt"] and df.count() > 0


def test_norm():
    assert norm(float("nan")) == "nan"
