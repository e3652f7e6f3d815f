"""Plan assertions over every registered query (SURVEY §5 (d))."""

from __future__ import annotations

import os
import re

import pytest

from arqueo.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_udf_no_cross_join(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


def test_filters_reach_the_scan(spark):
    plan = _plan(catalog.QUERIES["p_date_bound"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate,1997-07-01" in plan  # date bound rewritten on the raw timestamp
    plan = _plan(catalog.QUERIES["d_net4"](spark, SF))
    assert "EqualTo(l_linestatus,O)" in plan


def test_year_filters_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for name, column, bounds in (("p_years", "o_orderdate", ("1996-01-01", "1999-01-01")), ("p_up_to_year", "o_orderdate", ("1998-01-01",)),
                                 ("d_net4", "l_shipdate", ("1999-01-01", "2000-01-01")), ("d_rc12", "l_shipdate", ("1998-01-01", "1999-01-01"))):
        pushed = [x for x in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", _plan(catalog.QUERIES[name](spark, SF)), re.M) if column in x]
        assert pushed and all(b in pushed[0] for b in bounds), (name, pushed)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_column_pruning(spark):
    plan = _plan(catalog.QUERIES["a_totals"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_tax:double>" in plan


def test_hot_key_dedupe_aggregates_map_side(spark):
    """A key holding a third of the rows is reduced inside each map task."""
    from pyspark.sql import functions as F

    from arqueo import operators as op
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 97).alias("f"), F.col("id").alias("v"))
    out = op.dedupe(df, ["k"], ["f"], "first")
    plan = _plan(out)
    assert "partial_min" in plan and "Window" not in plan
    hot = out.filter(F.col("k") == "HOT").first()
    assert (hot.f, hot.v) == (0, 0)
    assert out.count() == 20001


def test_running_balance_window_sees_days_not_rows(spark):
    from pyspark.sql import functions as F

    from arqueo import operators as op
    df = spark.range(0, 20000).select(
        F.lit("2024").alias("ejercicio"), F.lit("01/2024").alias("mes"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 50).cast("string")).alias("cta_cte"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 31).cast("int")).alias("fecha"),
        F.lit(1).cast("decimal(18,2)").alias("importe"))
    out = op.running_balance(df, ["ejercicio", "mes", "cta_cte"])
    plan = _plan(out)
    # the window input is the (account, day) aggregate: an aggregate sits below the window
    assert plan.index("Window") < plan.rindex("HashAggregate")
    assert out.filter(F.col("cta_cte") == "HOT").first().saldo == 6667
