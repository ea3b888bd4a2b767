"""Every registered query of the library on the smallest given tables, beside its SQL twin."""

import datetime
import math
import os

import duckdb
import pytest

from lakemill.plans import catalog, small  # noqa: F401  small adds to the catalog
from lakemill.plans.adapters import TABLES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the given tables are not here")


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return f"{float(value):.9g}"
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        value = value.date()
    return str(value)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    out = catalog.QUERIES[name](spark, DATA)
    columns = sorted(out.columns)
    got = sorted(tuple(map(plain, r)) for r in out.select(*columns).collect())
    assert got, "a query that compares no rows proves nothing"
    if name in catalog.SQL:
        twin = duck.execute(catalog.SQL[name])
        names = [d[0] for d in twin.description]
        order = [names.index(c) for c in columns]
        assert sorted(names) == columns
        assert got == sorted(tuple(plain(r[i]) for i in order) for r in twin.fetchall())


def test_gates_refuse_beyond_the_bound_of_small_tables(spark, tmp_path):
    """v3_v5_gates_refuse has the same rows over a table that validate_small does not take."""
    from pyspark.sql import functions as F

    for t in TABLES:
        if t != "orders":
            os.symlink(f"{DATA}/{t}.parquet", tmp_path / f"{t}.parquet")
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    n, most = orders.agg(F.count("*"), F.max("o_orderkey")).first()
    copies = spark.range(500_000 // n + 1).withColumnRenamed("id", "i")
    orders.crossJoin(copies).withColumn("o_orderkey", F.col("o_orderkey") + F.col("i") * (most + 1)).drop("i").write.parquet(str(tmp_path / "orders.parquet"))
    got = catalog.QUERIES["v3_v5_gates_refuse"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [("constant", True), ("empty", True), ("no decay", True)]
