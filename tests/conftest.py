from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from storelens.session import _DEFAULTS, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[*]").appName("storelens-tests")
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="storelens-test-ckpt-"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from storelens.sources.retail import BASE_TABLES

    con = duckdb.connect()
    for t in BASE_TABLES:
        path = f"{SMOKE_DIR}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con
