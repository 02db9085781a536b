import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tagloom.session import get_session

    active = SparkSession.getActiveSession()
    if active is None:
        os.environ.setdefault("TAGLOOM_DRIVER_MEMORY", "8g")
        builder_dir = tempfile.mkdtemp(prefix="tagloom-test-ckpt-")
        spark = get_session("local[4]", shuffle_partitions=8, app_name="tagloom-tests")
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(builder_dir)
    else:
        spark = active
    yield spark


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from tagloom.sources.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con
