"""Driver contract: every registered query runs on the smallest tables."""
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "max_temperature"]
    assert df.count() > 0


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_runs(spark, name):
    df = E.queries()[name](spark, SF)
    assert len(df.columns) == len(set(df.columns))
    df.write.format("noop").mode("overwrite").save()
