"""Every query of the core against its SQL, on the smallest tables."""

import os

import pytest
from compare import compare, duck

import __spark_entry__ as e
from taxaloom.plans import problems, reference

SF = "/root/testdata/sf0.001"
CORE = {**problems.QUERIES, **reference.QUERIES}
SQL = {**problems.SQL, **reference.SQL}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, con, name):
    said = compare(spark, con, SF, name, CORE[name], SQL.get(name))
    assert "DIFFERS" not in said, said


def test_entry(spark):
    df = e.entry(spark)
    assert df.columns == ["data_source_id", "taxon_id", "root_id", "depth", "state"] and df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_verification_plan(spark):
    plan = CORE["lookup_by_year"](spark, SF)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:string,year:smallint" in plan.replace("name:string,", "") and "CartesianProduct" not in plan
