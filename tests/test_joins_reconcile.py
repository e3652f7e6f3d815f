from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from arqueo import operators as op
from conftest import D, rows

MAP = [("CTA-A", "10", "x"), ("CTA-B", "11", "y"), (None, "12", "z"), ("CTA-N", None, "w")]


def test_lookup_replaces_and_ignores_null_keys(spark):
    m = spark.createDataFrame(MAP, "map_to string, code string, other string")
    df = spark.createDataFrame([(1, "10"), (2, "99"), (3, None), (4, "12")], "id int, code string")
    out = op.lookup(df, m, "code", "code", "map_to")
    assert out.columns == ["id", "code"]
    assert rows(out) == [(1, "CTA-A"), (2, None), (3, None), (4, None)]


def test_lookup_rejects_repeated_keys(spark):
    m = spark.createDataFrame([("A", "10"), ("B", "10")], "map_to string, code string")
    df = spark.createDataFrame([(1, "10")], "id int, code string")
    with pytest.raises(Exception, match="not unique: 10 repeats 2 times"):  # raised by the job that reads it
        op.lookup(df, m, "code", "code", "map_to").collect()


def test_lookup_runs_no_job_and_hints_no_broadcast(spark):
    m = spark.createDataFrame(MAP, "map_to string, code string, other string")
    df = spark.range(100).select(F.col("id").cast("string").alias("code"))
    out = op.lookup(df, m, "code", "code", "map_to")
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()
    out.collect()
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()  # by its measured size


def _sides(spark):
    a = spark.createDataFrame([("2024", "01", "c1", D(10)), ("2024", "01", "c1", D(5)), ("2024", "02", "c1", D(7)),
                               ("2024", None, "c1", D(99))], "ejercicio string, mes string, cta_cte string, importe decimal(18,2)")
    b = spark.createDataFrame([("2024", "01", "c1", D(15)), ("2024", "03", "c2", D(4))],
                              "ejercicio string, mes string, cta_cte string, importe_bruto decimal(18,2)")
    return a, b


def test_reconcile_union_fill_and_diff(spark):
    a, b = _sides(spark)
    r = op.reconcile(a, b, ["ejercicio", "mes", "cta_cte"], {"x": "importe"}, {"y": "importe_bruto"})
    assert rows(r, "mes", "x", "y", "diferencia") == [
        ("01", D(15), D(15), D(0)), ("02", D(7), D(0), D(7)), ("03", D(0), D(4), D(-4))]  # NULL key dropped


def test_reconcile_properties(spark):
    a, b = _sides(spark)
    keys = ["ejercicio", "mes", "cta_cte"]
    same = op.reconcile(a, a, keys, {"x": "importe"}, {"y": "importe"})
    assert {r.diferencia for r in same.collect()} == {D(0)}
    ab = op.reconcile(a, b, keys, {"x": "importe"}, {"y": "importe_bruto"})
    ba = op.reconcile(b, a, keys, {"y": "importe_bruto"}, {"x": "importe"})
    assert rows(ab, "mes", "diferencia") == [(m, -d) for m, d in rows(ba, "mes", "diferencia")]
    tot = ab.agg(F.sum("diferencia")).first()[0]
    assert tot == D(10 + 5 + 7) - D(15 + 4)


def test_reconcile_left_only(spark):
    a, b = _sides(spark)
    r = op.reconcile(a, b, ["ejercicio", "mes", "cta_cte"], {"x": "importe"}, {"y": "importe_bruto"}, how="left")
    assert rows(r, "mes") == [("01",), ("02",)]


def test_subtract_left_only_modes(spark):
    a = spark.createDataFrame([("k1", 10.0, 3.0)], "k string, importe double, solo_a double")
    b = spark.createDataFrame([("k1", 4.0, 1.0), ("k2", 2.0, 5.0)], "k string, importe double, solo_b double")
    z = op.subtract(a, b, ["k"])
    assert z.columns == ["k", "importe", "solo_a", "solo_b"]
    assert rows(z) == [("k1", 6.0, 0.0, 0.0), ("k2", -2.0, 0.0, 0.0)]
    keep = op.subtract(a, b, ["k"], left_only="keep")
    assert rows(keep) == [("k1", 6.0, 3.0, -1.0), ("k2", -2.0, 0.0, -5.0)]
    nul = op.subtract(a, b, ["k"], left_only="null")
    assert rows(nul, "k", "solo_a") == [("k1", None), ("k2", None)]


def test_match_vouchers_both_null_keys(spark):
    a = spark.createDataFrame([("2024", "1/24", 5.0), ("2024", None, 1.0)], "a_ej string, a_nro string, a_imp double")
    b = spark.createDataFrame([("2024", "1/24", 5.0), ("2024", None, 2.0)], "b_ej string, b_nro string, b_imp double")
    strict = op.match_vouchers(a, b, [("a_ej", "b_ej"), ("a_nro", "b_nro")])
    assert strict.count() == 3
    safe = op.match_vouchers(a, b, [("a_ej", "b_ej"), ("a_nro", "b_nro")], null_safe=True)
    assert safe.count() == 2


def test_semi_anti_having(spark):
    df = spark.createDataFrame([("v1", 5.0), ("v1", -5.0), ("v2", 3.0), (None, 1.0)], "v string, x double")
    keys = spark.createDataFrame([("v2",), (None,)], "v string")
    assert rows(op.semi(df, keys, "v"), "v") == [("v2",)]
    assert rows(op.semi(df, keys, "v", null_safe=True), "v") == [(None,), ("v2",)]
    assert rows(op.anti(df, keys, "v"), "v") == [(None,), ("v1",), ("v1",)]
    assert rows(op.having_semi(df, ["v"], "x", lambda s: F.abs(s) > 0.1), "v") == [("v2",)]


def test_as_of_years(spark):
    df = spark.createDataFrame([("2020", 1), ("2022", 2)], "ejercicio string, v int")
    out = op.as_of_years(df, ["2021", "2022"])
    assert rows(out, "hasta", "v") == [("2021", 1), ("2022", 1), ("2022", 2)]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_full_detail_is_linear(spark):
    a = spark.createDataFrame([("k", "a1", 1.0), ("k", "a2", 2.0)], "g string, n string, importe double")
    b = spark.createDataFrame([("k", "b1", 4.0), ("k", "b2", 1.0), ("k", "b3", 1.0)], "g string, n string, x double")
    out = op.full_detail(a, b, ["g"], "importe", "x")
    assert out.count() == 5  # 2 + 3 lines, never 2 x 3 pairs
    assert {r.diferencia for r in out.collect()} == {-3.0}


def test_hierarchy_and_natural(spark):
    act = spark.createDataFrame([("01-00-00-03", "01-00-00", "act")], "actividad string, proyecto string, desc_act string")
    proy = spark.createDataFrame([("01-00-00", "01-00", "proy")], "proyecto string, subprograma string, desc_proy string")
    sub = spark.createDataFrame([("01-00", "01", None)], "subprograma string, programa string, desc_subprog string")
    h = op.hierarchy([(act, []), (proy, ["proyecto"]), (sub, ["subprograma"])])
    r = h.first()
    assert r.desc_proy == "proy" and r.programa == "01" and r.desc_subprog is None
    with pytest.raises(ValueError):
        op.natural_join(act.select("desc_act"), proy.select("desc_proy"))
