"""Physical-plan properties that matter at scale."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns(spark):
    from barlake.plans import registry as R
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    p = plan(R.daily_sup(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," \
           "l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in p
    assert "l_discount" not in p.split("ReadSchema")[1]


def test_daily_rollup_is_partial_aggregate(spark):
    from barlake.plans import registry as R
    p = plan(R.daily_bars(spark, SF))
    assert "partial_min_by" in p and "partial_max_by" in p


def test_nation_broadcast_behind_check(spark):
    import __spark_entry__ as E
    df = E.queries()["broadcast_dim_join"](spark, SF)
    df.collect()
    assert "BroadcastHashJoin" in plan(df) or "BroadcastExchange" in plan(df)


def test_correlation_stays_in_the_jvm(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["q_correlation"](spark, SF))
    assert "Pandas" not in p and "Arrow" not in p and "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_top_k_is_take_ordered(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["q_top10"](spark, SF))
    assert "TakeOrderedAndProject" in p


def test_trailing_filter_uses_scalar_subquery(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["q_timeseries"](spark, SF))
    assert "Subquery" in p and "CartesianProduct" not in p
