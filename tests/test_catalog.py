import os

import duckdb
import pytest

import __spark_entry__
from pepweave.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in sorted(os.listdir(SF)):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_sql(spark, tables, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = tables.sql(catalog.ORACLES[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(repr(tuple(x[k] for k in at)) for x in want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries()) and set(catalog.ORACLES) <= set(__spark_entry__.oracle_sql())


def test_nothing_outside_imports_the_optional_part():
    top = os.path.dirname(os.path.abspath(catalog.__file__)) + "/.."
    for folder, _, files in os.walk(top):
        if "/llm" not in folder:
            for f in files:
                if f.endswith(".py"):
                    assert "llm" not in open(os.path.join(folder, f)).read(), f


def test_flagship_plan_reads_only_what_it_needs(spark):
    plan = catalog.QUERIES["peptide_mass_range"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan and "Python" not in plan


def test_set_differences_digest_the_documents_once(spark):
    plan = catalog.QUERIES["set_diff_equal_negative"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "documents" not in plan and plan.count("compared-") == 4
