import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from spendmatch.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="spendmatch-test-ckpt-")
    s = get_spark("local[4]", app="spendmatch-tests", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
              "pages", "benchmark", "labels", "conversations"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="spendmatch-test-")
