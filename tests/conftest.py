import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
        .config("spark.checkpoint.dir", f"file://{shared}/checkpoints")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def same_rows(df, duck, sql):
    """A query's rows against its SQL's, by column name."""
    names = sorted(df.columns)
    got = sorted((tuple(normal(r[n]) for n in names) for r in df.collect()), key=repr)
    rel = duck.sql(sql)
    assert sorted(rel.columns) == names
    at = [rel.columns.index(n) for n in names]
    want = sorted((tuple(normal(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert got == want
    return len(got)
