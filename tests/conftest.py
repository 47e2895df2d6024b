import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = os.environ.get("MARGINALIS_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def values(rows):
    """Comparable forms of collected values."""
    import math

    def one(x):
        if isinstance(x, float):
            return None if math.isnan(x) else float(f"{x:.9g}")
        if isinstance(x, (list, tuple)):
            return tuple(one(y) for y in x)
        if isinstance(x, dict):
            return tuple(sorted((k, one(v)) for k, v in x.items()))
        return x

    return sorted((tuple(one(v) for v in r) for r in rows), key=repr)


def compare_with_oracle(spark, name, query, sql, folder=SMALL):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(folder):
        con.execute(f"create view {f.split('.')[0]} as select * from '{folder}/{f}'")
    df = query(spark, folder)
    columns = sorted(df.columns)
    got = values([r[c] for c in columns] for r in df.collect())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    expected = values([r[names.index(c)] for c in columns] for r in result.fetchall())
    assert got == expected, name
