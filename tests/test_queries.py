"""Every query of the plans against its SQL."""

import pytest

from tilewright.plans import files, files_oracle  # noqa: F401  register their queries
from tilewright.plans.oracle import ORACLE_SQL
from tilewright.plans.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


# the sample of 500 takes the whole shares only where each stage has enough rows, as it has here
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, same, name):
    same(QUERIES[name](spark, sf_dir).toPandas(), duck.sql(ORACLE_SQL[name]).df())


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["key", "text"]
    assert df.limit(1).count() == 1
