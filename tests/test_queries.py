"""Every registered query of the library against its DuckDB SQL."""

import pytest
from spotlake.plans.queries import ORACLE_SQL, QUERIES

from oracle import SF, check


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    check(spark, QUERIES[name], ORACLE_SQL[name], SF)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


def test_filters_reach_the_scan(spark):
    from spotlake.functions.bands import band_predicate
    from pyspark.sql import functions as F

    df = spark.read.parquet(f"{SF}/orders.parquet").where(band_predicate(F.col("o_totalprice"), "20m")).select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan and "o_comment" not in plan
