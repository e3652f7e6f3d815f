from __future__ import annotations

from pyspark.sql import functions as F

from arqueo import operators as op
from arqueo.functions import codes as K
from arqueo.functions import scalars as sc
from conftest import D, day, rows


def test_years_and_up_to(spark):
    df = spark.createDataFrame([("2022", 1), ("2023", 2), ("2024", 3), (None, 4)], "ejercicio string, v int")
    assert rows(op.years(df, "2023"), "v") == [(2,)]
    assert rows(op.years(df, ["2022", "2024"]), "v") == [(1,), (3,)]
    assert rows(op.up_to(df, "2023"), "v") == [(1,), (2,)]
    assert rows(op.up_to(df, 2023, op=">"), "v") == [(3,)]


def test_exclude_codes_keeps_null(spark):
    df = spark.createDataFrame([("001", 1), ("018", 2), (None, 3), ("142", 4)], "c string, v int")
    assert rows(op.codes(df, "c", exclude=["018", "142"]), "v") == [(1,), (3,)]
    assert rows(op.codes(df, "c", include=["018"]), "v") == [(2,)]


def test_pattern_null_text(spark):
    df = spark.createDataFrame([("PAGO GCIAS", 1), ("HABERES", 2), (None, 3)], "t string, v int")
    assert rows(op.matches(df, "t", K.INCOME_TAX_WORDS, keep=False), "v") == [(2,), (3,)]
    assert rows(op.matches(df, "t", K.INCOME_TAX_WORDS, keep=True), "v") == [(1,)]


def test_classify_first_match_and_parity_quirk(spark):
    df = spark.createDataFrame([("142",), ("143",), ("001",), ("999",), (None,)], "c string")
    fixed = op.classify(df, "c", K.cash_flow_classes(), K.CASH_FLOW_OTHER)
    got = dict((r.c, r.clase) for r in fixed.collect())
    assert got["142"] == got["143"] == "3 - Inversión Obras"
    assert got["001"] == "1 - Recursos" and got["999"] == K.CASH_FLOW_OTHER and got[None] == K.CASH_FLOW_OTHER
    parity = dict((r.c, r.clase) for r in op.classify(df, "c", K.cash_flow_classes(parity=True),
                                                         K.CASH_FLOW_OTHER).collect())
    assert parity["142"] == parity["143"] == K.CASH_FLOW_OTHER


def test_fill0_numeric_only(spark):
    df = spark.createDataFrame([("a", None, None)], "k string, x decimal(18,2), s string")
    r = op.fill0(df).first()
    assert r.x == D(0) and r.s is None


def test_only_diff_row_total_hides_cancelling(spark):
    df = spark.createDataFrame([("a", 5.0, -5.0), ("b", 1.0, 0.0), ("c", 0.0, 0.0)], "k string, x double, y double")
    assert rows(op.only_diff(df), "k") == [("b",)]
    assert rows(op.only_diff(df, mode="any"), "k") == [("a",), ("b",)]


def test_tolerance_boundary(spark):
    df = spark.createDataFrame([("a", D(0.1)), ("b", D(-0.11)), ("c", D(0.05))], "k string, d decimal(18,2)")
    assert rows(op.beyond(df, "d", 0.1, strict=True), "k") == [("b",)]
    assert rows(op.beyond(df, "d", 0.1, strict=False), "k") == [("a",), ("b",)]


def test_mismatch_flags_null_policies(spark):
    df = spark.createDataFrame([("v1", None, None), ("v2", "x", "x"), ("v3", "x", None)], "k string, a string, b string")
    differ = op.flag_mismatch(df, {"f": ("a", "b")})
    assert rows(differ, "k") == [("v1",), ("v3",)]  # NULL vs NULL differs
    equal = op.flag_mismatch(df, {"f": ("a", "b")}, null_policy="equal")
    assert rows(equal, "k") == [("v3",)]  # after a 0-fill two NULLs are equal


def test_scalars(spark):
    df = spark.createDataFrame([("2749", "2011", day("2024-01-31"), "03/2024", "123456")],
                               "n string, y string, d date, m string, long string")
    r = df.select(sc.voucher_number("n", "y").alias("v"), sc.zfill("long").alias("z"),
                  sc.add_one_month("d").alias("d1"), sc.month_start("m").alias("m0"),
                  sc.voucher_int_text(F.lit("02749/11")).alias("i"), sc.shift_year("y").alias("py"),
                  sc.strip_code_prefix(F.lit("29-12 OBRA X ")).alias("s"),
                  sc.is_numeric_prefix(F.lit("12A")).alias("num")).first()
    assert r.v == "02749/11" and r.z == "123456"          # zfill never shortens
    assert r.d1 == day("2024-02-29")                       # month-end clipping
    assert r.m0 == day("2024-03-01") and r.i == "2749" and r.py == "2010"
    assert r.s == "OBRA X" and r.num is False


def test_safe_percent_zero_divisor(spark):
    df = spark.createDataFrame([(D(5), D(0)), (D(5), D(10))], "a decimal(18,2), b decimal(18,2)")
    got = [r.p for r in op.percent(df, "a", "b", "p").orderBy("b").collect()]
    assert got == [None, 50.0]
