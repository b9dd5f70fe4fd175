"""Every registered query of the library's own operators against its SQL, on the small tables."""

import math
import os

import duckdb
import pytest

from gradus import plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


def same(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    return str(v) if isinstance(v, list | tuple) else v


@pytest.mark.parametrize("name", [n for n in plans.QUERIES if n in plans.SQL])
def test_query_equals_sql(spark, con, name):
    df = plans.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    expected = con.sql(plans.SQL[name])
    names = [d[0] for d in expected.description]
    assert columns == sorted(names)
    order = [names.index(c) for c in columns]
    got = sorted((tuple(same(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == sorted((tuple(same(r[i]) for i in order) for r in expected.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_scan_is_pruned_and_pushed_down(spark):
    text = plans.QUERIES["a03_projected_scan"](spark, SF)._jdf.queryExecution().toString()
    assert "GreaterThan(l_quantity,45" in text
    read = text[text.index("ReadSchema: struct<") :].split(">")[0]
    assert {c.split(":")[0] for c in read.removeprefix("ReadSchema: struct<").split(",")} == {"l_suppkey", "l_linestatus", "l_quantity"}
