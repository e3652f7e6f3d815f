"""Mended window operators, voucher lines, severity ranks and the debt against accounting on small tables."""

from __future__ import annotations

import pytest
from conftest import D, rows
from pyspark.sql import functions as F

from arqueo import operators as op
from arqueo.operators import windows
from arqueo.plans import controls, debt


def exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange " in line and "Broadcast" not in line]


def test_null_and_empty_lines_are_two_lines(spark):
    schema = "ejercicio string, nro_comprobante string, partida string, importe decimal(18,2), tipo string"
    ledger = spark.createDataFrame([("2024", "1", None, D(10), "CYO"), ("2024", "1", "", D(20), "CYO"), ("2024", "2", None, D(5), "CYO"), ("2024", None, "421", D(7), "CYO")], schema)
    loads = spark.createDataFrame([("2024", "1", None, D(20), "CYO"), ("2024", "1", "", D(10), "CYO"), ("2024", "2", None, D(5), "CYO"), ("2024", None, "421", D(7), "CYO")], schema)
    out = controls.voucher_control(ledger, loads, attrs=("tipo",))
    # both lines of voucher 1 differ by 10; vouchers without a number never match by it
    assert rows(out, "siif_nro", "siif_importe", "icaro_importe", "err_importe") == [
        (None, D(7), D(7), False), ("1", D(10), D(20), True), ("1", D(20), D(10), True)]


def test_voucher_control_shuffles_summed_lines_once(spark):
    schema = "ejercicio string, nro_comprobante string, partida string, importe decimal(18,2), tipo string"
    df = spark.createDataFrame([("2024", "1", "421", D(10), "CYO")], schema)
    # the lines by (voucher, line), then their sums by voucher: numbering and pairing need no exchange of their own
    assert len(exchanges(controls.voucher_control(df, df, attrs=("tipo",)))) == 2


@pytest.mark.parametrize("n", [None, 1, 7])
def test_running_total_of_a_busy_day(spark, n):
    df = spark.createDataFrame([("a", 3, 1)] * 500 + [("a", i % 5, i) for i in range(60)] + [(None, 1, 2), (None, None, 4), ("b", None, None), ("b", 2, 9)], "p string, k int, v long")
    got = rows(op.cumulative(df, ["k"], "v", ["p"], partitions=n))
    assert got == rows(op.cumulative(df, ["k"], "v", ["p"], presummed=True)) and len(got) == 564
    # an existing column of the result's name is replaced
    again = op.cumulative(df.withColumn("acum", F.lit("old")), ["k"], "v", ["p"], partitions=n)
    assert rows(again.select("p", "k", "v", "acum")) == got


def test_running_total_ranges_hold_sums(spark, monkeypatch):
    """What is range-partitioned and written has a row per (part, key), whatever the day's rows."""
    seen = []
    monkeypatch.setattr(windows, "materialize", lambda df, name: seen.append(df.count()) or df)
    df = spark.range(5000).select(F.lit("a").alias("p"), (F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    op.cumulative(df, ["k"], "v", ["p"], partitions=2)
    assert seen == [3]


def test_ranges_follow_the_size_of_the_input(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x"), "id").write.parquet(path)
    df = spark.read.parquet(path)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert windows.range_count(df) == least
    monkeypatch.setattr(windows, "RANGE_BYTES", 50_000)
    assert windows.range_count(df.filter("id > 3").join(df.withColumnRenamed("x", "y"), "id")) > 20
    # a table whose size Spark does not know
    assert windows.range_count(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int")) >= least


def test_ranks_are_long(spark):
    df = spark.createDataFrame([("a", 5), ("a", -9), (None, 1)], "p string, v int")
    for method in ("range", "window"):
        out = op.rank_by(df, "v", ["p"], method=method)
        assert dict(out.dtypes)["ranking"] == "bigint"
        assert rows(out) == [(None, 1, 1), ("a", -9, 1), ("a", 5, 2)]


def test_severity_rank(spark):
    df = spark.createDataFrame([(1, True, False), (2, False, True), (3, True, True), (4, None, False), (5, False, True)], "id int, a boolean, b boolean")
    assert rows(op.severity_rank(df, ["a", "b"]), "id", "orden") == [(1, 2), (2, 3), (3, 1), (4, 5), (5, 3)]
    assert op.severity_rank(df.limit(0), ["a", "b"]).collect() == []
    with pytest.raises(ValueError):
        op.severity_rank(df, [f"f{i}" for i in range(21)])


def test_advances_without_fund_and_several_regularisations(spark):
    funds = spark.createDataFrame([("2024", "7", "01/2024", D(100), D(1)), ("2024", "8", "02/2024", D(50), D(0))], "ejercicio string, nro_fondo string, mes string, ingresos decimal(18,2), saldo decimal(18,2)")
    vouchers = spark.createDataFrame(
        [("2024", "7", "REG", "00071/24", D(60), "03/2024"), ("2024", "7", "REG", "00071/24", D(10), "03/2024"), ("2024", "7", "REG", "00072/24", D(30), "04/2024"), ("2024", None, "REG", "00073/24", D(9), "04/2024"),
         ("2024", "8", "CYO", "00081/24", D(50), "04/2024")], "ejercicio string, nro_fondo string, clase_reg string, nro_comprobante string, importe decimal(18,2), mes string")
    vouchers = vouchers.withColumns({"cta_cte": F.lit("c"), "cuit": F.lit("t"), "fuente": F.lit("11")})
    loads = spark.createDataFrame(
        [("2024", "00007/24", "PA6", D(100), "01/2024"), ("2024", "00009/24", "PA6", D(5), "01/2024"), ("2024", "00071/24", "REG", D(70), "03/2024"), ("2024", "00072/24", "REG", D(31), "04/2024")],
        "ejercicio string, nro_comprobante string, tipo string, importe decimal(18,2), mes string")
    loads = loads.withColumns({"cta_cte": F.lit("c"), "cuit": F.lit("t"), "fuente": F.lit("11")})
    out = controls.advances_control(funds, vouchers, loads, rank="orden")
    # fund 8 has no advance and no regularisation; advance 9 no fund; voucher 72 another amount; voucher 71 fits
    assert rows(out, "orden", "siif_nro_fondo", "icaro_nro_fondo", "siif_nro_reg", "err_nro_fondo", "err_importe_pa6", "err_importe_reg") == [
        (1, None, "00009/24", None, True, True, False), (1, "00008/24", None, None, True, True, False), (3, "00007/24", "00007/24", "00072/24", False, False, True)]


def test_debt_without_origin_stays_apart_and_adjustments_repeat(spark):
    snaps = spark.createDataFrame(
        [("2023", "12/2023", "00001/23", "1", D(10)), ("2023", "12/2023", "00002/23", None, D(20)), ("2023", "12/2023", "00003/23", None, D(30)), ("2023", "12/2023", "00001/23", "1", D(5)),
         ("2023", "11/2023", "00009/23", "9", D(99)), ("2024", "06/2024", "00004/24", "4", D(7)), ("2023", "06/2024", "00001/23", "1", D(10))],
        "ejercicio string, mes_hasta string, nro_comprobante string, nro_origen string, saldo decimal(18,2)")
    snaps = snaps.withColumns({c: F.lit(c) for c in ("fuente", "cta_cte", "cuit", "glosa", "nro_expte")})
    ledger = spark.createDataFrame(
        [("2023", "2111", "CAO", "1", "50", D(15)), ("2023", "2111", "AJU", "77", "51", D(-3)), ("2023", "2111", "AJU", "78", "52", D("0.05")), ("2024", "2111", "CAO", "4", "53", D(7)), ("2023", "1112", "CAO", "1", "54", D(1))],
        "ejercicio string, cta_contable string, tipo_comprobante string, nro_original string, nro_entrada string, saldo decimal(18,2)")
    out = debt.debt_with_accounting(snaps, ledger, ["2024", "2023"])["rdeu_cta_contable"]
    assert rows(out, "ejercicio_contable", "ejercicio", "nro_original", "saldo_rdeu", "saldo_contable") == [
        ("2023", "2023", None, D(20), None), ("2023", "2023", None, D(30), None), ("2023", "2023", "1", D(15), D(15)), ("2023", "2023", "77", D(3), D(-3)),
        ("2024", "2023", "1", D(10), D(15)), ("2024", "2023", "77", D(3), D(-3)), ("2024", "2024", "4", D(7), D(7))]


# ---------------------------------------------------------------- the registered queries cover their cases

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sf():
    import os

    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    return SF


def test_debt_query_has_matched_and_unmatched_sides(spark, sf):
    from arqueo.plans import ledger_queries as q

    parts = q._net8(spark, sf)
    joined = parts["rdeu_cta_contable"]
    r = joined.agg(F.count_if(F.expr("saldo_contable IS NULL")).alias("debt_only"), F.count_if(F.expr("nro_original IS NULL")).alias("no_origin"),
                   F.count_if(F.expr("tipo_comprobante = 'AJU'")).alias("adjustments")).first()
    assert r.debt_only > 0 and r.no_origin > 0 and r.adjustments > 0
    # an adjustment of the first year is there again in the later ones
    again = joined.filter("ejercicio = '2011' AND tipo_comprobante = 'AJU' AND fuente = '11' AND cuit IS NULL").select("ejercicio_contable").distinct()
    assert {x[0] for x in again.collect()} == {"2011", "2012", "2013"}


def test_advances_query_has_all_kinds(spark, sf):
    from arqueo.plans.ledger_queries import d_iv3

    r = d_iv3(spark, sf).agg(*[F.count_if(F.expr(c)).alias(f"n{i}") for i, c in enumerate((
        "icaro_nro_fondo IS NULL", "siif_nro_fondo IS NULL", "siif_nro_reg IS NOT NULL AND icaro_nro_reg IS NULL", "err_importe_reg AND icaro_nro_reg IS NOT NULL", "err_cta_cte", "err_tipo"))]).first()
    assert min(r) > 0


def test_gap_reads_each_source_once(spark, sf):
    from arqueo.plans import gap_queries as q

    s = q.gap_inputs(spark, sf)
    read = {f.rsplit("/", 1)[1] for f in q.whole_gap(s).inputFiles() if f.startswith(f"file://{sf}") or f.startswith(f"file:{sf}")}
    # beside the notaries' lines and the advances the controls read the written tables, not the joins of the views
    assert read == {"lineitem.parquet", "orders.parquet"}
    out = {(r.ejercicio, r.concepto): r.importe for r in q.whole_gap(s).collect()}
    assert out["1998", "pa6_reg"] is None and out["1998", "dif_sldo_ajustado"] is None
    parts = ["dif_sldo", *q.PARTS]
    assert out["1999", "dif_sldo_ajustado"] == sum(out["1999", p] for p in parts)


def test_written_sources_are_pruned_by_year(spark, sf):
    from arqueo.plans import year_queries as q
    from arqueo.sources import systems

    root = q.write_sources(spark, sf)
    df = systems.works_loads(spark, root, years=["1998"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [ejercicio" in plan or "PartitionFilters: [isnotnull(ejercicio" in plan
    whole = systems.works_loads(spark, root)
    # the column that is not declared is gone, declared ones that were not written are NULL, rows without a year are kept
    assert "extra" not in whole.columns and whole.filter("obra IS NOT NULL").isEmpty()
    assert whole.filter("ejercicio IS NULL").count() > 0


def test_bucketed_tables_join_without_an_exchange(spark, sf):
    from arqueo.plans import year_queries as q

    df = q.bucketed_join(spark, q.bucketed_pair(spark, sf, 4))
    assert exchanges(df) == []
    assert df.filter("pagado IS NULL").count() > 0 and df.filter("pagos > 1").count() > 0


def test_crosswalk_has_ambiguous_and_coded_names(spark, sf):
    from arqueo.plans import year_queries as q

    out = q.d_co3(spark, sf)
    long = out.filter("obra LIKE 'obra larga%'")
    assert long.count() > 10 and long.select("obra", "cod_obra").distinct().count() == 1 and long.first().cod_obra is not None
    assert out.filter("cod_obra = '123'").count() > 0 and out.filter("cod_obra IS NULL").count() > 0
    assert q.d_co3_inverso(spark, sf).filter("imputacion IS NULL").count() > 0


def test_cash_basis_moves_rows_between_years(spark, sf):
    from arqueo.plans import year_queries as q

    net = q._works_net(spark, sf)
    debt_rows = net.filter("tipo = 'RDEU'")
    moved = debt_rows.filter("id LIKE '%C' AND month(fecha) = 1")
    assert moved.count() > 0 and debt_rows.filter("importe < 0").count() > 0
    totals = {r.ejercicio: r.acum for r in q.d_eo7_cash_total(spark, sf).collect()}
    loads = net.filter("fecha <= '2000-10-31' AND (ejercicio = '2000' OR ejercicio BETWEEN '1996' AND '1999' AND tipo <> 'PA6')")
    for y, total in totals.items():
        assert total == float(loads.filter(F.col("ejercicio") <= y).agg(F.sum("importe")).first()[0])
