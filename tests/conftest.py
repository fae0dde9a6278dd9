import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.fixture(scope="session")
def same():
    """Compare two pandas tables: columns by name, rows in any order, numbers to 9 digits."""
    import pandas as pd

    def rows(df):
        df = df[sorted(df.columns)]
        return sorted(tuple("NULL" if v is None or (not isinstance(v, list) and pd.isna(v)) else f"{float(v):.9g}" if isinstance(v, int | float) and not isinstance(v, bool) else str(v) for v in r) for r in df.itertuples(index=False))

    def check(a, b):
        assert sorted(a.columns) == sorted(b.columns)
        assert rows(a) == rows(b)

    return check
