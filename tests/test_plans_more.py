"""Remaining named reports on hand-made rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from arqueo.plans import bank, controls, debt, fees, receivables, remainder, sources_clean, withholdings, works
from conftest import D, day, rows
from test_plans import _bank, frame


def test_bank_gap_explained_keeps_null_years(spark):
    lvb = spark.createDataFrame([("2023", "c", D(10), D(8), D(2)), ("2024", "c", D(5), D(5), D(0))],
                                "ejercicio string, cta_cte string, sldo_siif decimal(18,2), "
                                "sldo_banco decimal(18,2), dif_sldo decimal(18,2)")
    rec = spark.createDataFrame([("2023", D(1))], "ejercicio string, diferencia decimal(18,2)")
    obras = spark.createDataFrame([("2023", D(-3)), ("2024", D(4))], "ejercicio string, diferencia decimal(18,2)")
    out = bank.gap_explained(lvb, {"recursos_dif": (rec, "diferencia", -1), "obras_dif": (obras, "diferencia", 1)})
    got = {(r.ejercicio, r.concepto): r.importe for r in out.collect()}
    assert got[("2023", "dif_sldo_ajustado")] == D(2 - 1 - 3)
    assert got[("2024", "recursos_dif")] is None and got[("2024", "dif_sldo_ajustado")] is None


def test_final_vs_running_and_ledger_vs_bank(spark):
    fin_ = frame(spark, "bank_final_balance", [("2024", "a", D(10)), ("2024", "b", D(3))],
                 ["ejercicio", "cta_cte", "saldo"])
    run = spark.createDataFrame([("2024", "a", D(10)), ("2024", "c", D(1))],
                                "ejercicio string, cta_cte string, saldo decimal(18,2)")
    r = bank.final_vs_running(fin_, run, only_diff=True)
    # parity: the row total includes both balances, so an equal pair (a) is still shown and
    # c (0 + 1 - 1 = 0) is hidden, as in the original
    assert rows(r, "cta_cte", "dif") == [("a", D(0)), ("b", D(3))]
    assert rows(bank.final_vs_running(fin_, run).filter(F.col("dif") != 0), "cta_cte") == [("b",), ("c",)]
    led = spark.createDataFrame([("2024", "a", D(9), D(2), D(7))], "ejercicio string, cta_cte string, "
                                "debitos decimal(18,2), creditos decimal(18,2), saldo decimal(18,2)")
    l2 = bank.ledger_vs_bank_final(led, fin_)
    assert rows(l2, "cta_cte", "debitos", "sldo_siif", "dif_sldo") == [("a", D(9), D(7), D(-3)), ("b", D(0), D(0), D(-3))]


def test_ledger_bank_book_and_summary(spark):
    led = frame(spark, "ledger", [("2024", "01/2024", "1112-2-6", "CAP", "E1", "130832-03", D(5), D(1)),
                                  ("2024", "01/2024", "2111-1-2", "CAP", "E1", "x", D(9), D(0))],
                ["ejercicio", "mes", "cta_contable", "tipo_comprobante", "nro_entrada", "auxiliar_1", "debitos",
                 "creditos"])
    amap = frame(spark, "account_map", [("CTA-3", "130832-03")], ["map_to", "siif_contabilidad_cta_cte"])
    book = bank.ledger_bank_book(led, amap)
    s = bank.ledger_bank_summary(book).first()
    assert s.cta_cte == "CTA-3" and s.debitos == D(5)
    codes = frame(spark, "imputation_codes", [("002", "PAGO")], ["cod_imputacion", "tipo"])
    typed = bank.bank_with_imputation_type(_bank(spark), codes)
    assert typed.filter(F.col("tipo") == "PAGO").count() == 2
    book2 = frame(spark, "ledger", [("PAP",), ("CAP",), (None,)], ["tipo_comprobante"])
    assert bank.ledger_bank_without_advances(book2).count() == 2


def test_works_crosswalk_and_list(spark):
    w = frame(spark, "works_list", [("1", "29-01 ESCUELA NORTE", "29-01-01-01", "422"),
                                    ("2", "123 VIVIENDAS SUR", "29-02-01-01", "421"),
                                    ("3", "12-3 POZO", "30-01-01-01", "421")],
              ["id", "obra", "actividad", "partida"])
    reg = frame(spark, "works_register", [("C9", "ESCUELA NORTE"), ("C1", "OTRA")], ["cod_obra", "obra"])
    lst = controls.works_list(w)
    assert lst.columns[:2] == ["obra_sin_cod", "imputacion"] and "id" not in lst.columns
    assert rows(lst, "obra_sin_cod", "imputacion") == [("123 VIVIENDAS SUR", "29-02-01-01-421"),
                                                       ("ESCUELA NORTE", "29-01-01-01-422"),
                                                       ("POZO", "30-01-01-01-421")]
    a, b = controls.works_crosswalk(w, reg)
    got = dict((r.obra, r.cod_obra) for r in a.collect())
    assert got == {"ESCUELA NORTE": "C9", "123 VIVIENDAS SUR": "123", "POZO": None}
    assert dict((r.cod_obra, r.imputacion) for r in b.collect()) == {"C9": "29-01-01-01-422", "C1": None}


def test_yearly_execution_and_sources(spark):
    bud = frame(spark, "budget", [("2024", "29-01-01-01-422", "11", "422", D(100))],
                ["ejercicio", "estructura", "fuente", "partida", "ordenado"])
    ld = frame(spark, "works_loads", [("2024", "29-01-01-01", "422", "11", D(99.95))],
               ["ejercicio", "actividad", "partida", "fuente", "importe"])
    assert controls.yearly_execution(bud, ld).count() == 0  # difference 0.05 is within tolerance
    assert controls.ledger_works_budget(bud).count() == 1
    vo = frame(spark, "expense_vouchers", [("354", "1"), ("354", "2"), ("421", "3"), ("100", None)],
               ["partida", "cuit"])
    assert rows(controls.ledger_works_vouchers(vo, skip_cuits=["2"]), "cuit") == [("1",), ("3",)]
    fv = frame(spark, "expense_vouchers", [("F1", "130832-05"), (None, "130832-05"), ("F2", "x")],
               ["nro_fondo", "cta_cte"])
    assert rows(sources_clean.permanent_fund_vouchers(fv), "nro_fondo") == [("F1",)]


def test_fee_renditions_with_alimony(spark):
    rend = frame(spark, "renditions", [("2024", "01/2024", "FUNCIONAMIENTO", "HONORARIOS - FUNCIONAMIENTO",
                                        "130832-05", D(10), D(9)),
                                       ("2024", "01/2024", "OBRAS", "HONORARIOS - FUNCIONAMIENTO", "130832-05",
                                        D(5), D(5))],
                 ["ejercicio", "mes", "origen", "destino", "cta_cte", "importe_bruto", "importe_neto"])
    out = sources_clean.fee_renditions(rend, _bank(spark))
    assert rows(out, "destino", "importe_bruto", "importe_neto") == [("EMBARGO POR ALIMENTOS", D(3), D(0)),
                                                                     ("HONORARIOS - FUNCIONAMIENTO", D(10), D(9))]
    emb = out.filter(F.col("destino") == "EMBARGO POR ALIMENTOS").first()
    assert emb.otras == D(3) and emb.retenciones == D(3) and emb.beneficiario == "EMBARGO POR ALIMENTOS"


def test_fee_vouchers_notary_contribution(spark):
    vo = frame(spark, "expense_vouchers", [("30632351514", "300", "422", "130832-05", "PAGO HONORARIOS X"),
                                           ("30632351514", "300", "384", "130832-05", "HONORARIOS"),
                                           ("30632351514", "300", None, "130832-07", "LOCACION"),
                                           ("30632351514", "300", "422", "130832-05", "OTRO")],
               ["cuit", "grupo", "partida", "cta_cte", "glosa"])
    assert rows(fees.fee_vouchers(vo), "glosa") == [("LOCACION",), ("PAGO HONORARIOS X",)]
    led = frame(spark, "ledger", [("2024", "01/2024", "2113-2-9", "CAO", "E1", "20-9", D(2), D(10), None),
                                  ("2024", "01/2024", "2113-2-9", "APE", "E2", "20-9", D(0), D(50), None),
                                  ("2024", "01/2024", "2122-1-2", "CAP", "E3", "337", D(7), D(0), None),
                                  ("2024", "01/2024", "1112-2-6", "CAP", "E3", "130832-03", D(0), D(7), None)],
                ["ejercicio", "mes", "cta_contable", "tipo_comprobante", "nro_entrada", "auxiliar_1", "debitos",
                 "creditos", "saldo"])
    nl = fees.notary_ledger(led)
    assert rows(nl, "cuit", "carga_fei", "pagos_fei", "fei_impagos") == [("20-9", D(10), D(2), D(8))]
    ls = fees.notary_ledger_summary(nl)
    rend = frame(spark, "renditions", [("2024", "01/2024", "20-9", "N", "130832-08", D(1)),
                                       ("2024", "02/2024", "20-9", "N", "130832-08", D(4))],
                 ["ejercicio", "mes", "cuit", "beneficiario", "cta_cte", "importe_neto"])
    rs = fees.notary_renditions_summary(rend, ["ejercicio", "mes", "cuit"])
    v3 = {r.mes: r for r in fees.notary_ledger_vs_renditions(ls, rs, ["ejercicio", "mes", "cuit"]).collect()}
    assert v3["01/2024"].dif_pagos == D(1) and v3["02/2024"].carga_fei == D(0) and v3["02/2024"].dif_pagos == D(-4)
    bs = fees.notary_bank_summary(_bank(spark), ["ejercicio", "mes"])
    v2 = {r.mes: r.importe_neto for r in fees.notary_renditions_vs_bank(
        fees.notary_renditions_summary(rend, ["ejercicio", "mes"]), bs, ["ejercicio", "mes"]).collect()}
    assert v2 == {"01/2024": D(1), "02/2024": D(4) - D(11)}
    cw = fees.contribution_withholdings(led)
    assert rows(cw, "pagos_337_siif", "gastos_337_siif") == [(D(7), D(0))]
    rev = frame(spark, "revenue_vouchers", [("2024", "01/2024", "c", D(7), True, True)],
                ["ejercicio", "mes", "cta_cte", "importe", "es_propio", "es_verificado"])
    cr = fees.contribution_revenue(rev, ["ejercicio", "mes"])
    assert fees.contribution_control(cr, cw, ["ejercicio", "mes"], only_diff=True).count() == 1  # parity: row total


def test_fees_vs_renditions_null_one_sided(spark):
    a = spark.createDataFrame([("k", 10.0, 1.0)], "k string, importe_bruto double, iibb double")
    b = spark.createDataFrame([("k", 10.0, 2.0)], "k string, importe_bruto double, gcias double")
    res = fees.fees_vs_renditions(a, b, ["k"])
    out = res.first()
    assert out.importe_bruto == 0.0 and out.iibb is None and "gcias" not in res.columns


def test_withholdings_bank_and_renditions(spark):
    b = frame(spark, "bank", [("2024", "01/2024", "c", "034", "RET GCIAS", D(-4)),
                              ("2024", "01/2024", "c", "034", "SELLOS", D(-1)),
                              ("2024", "01/2024", "c", "034", None, D(-2)),
                              ("2024", "01/2024", "c", "018", "PAGO OBRA", D(-50)),
                              ("2024", "01/2024", "c", "002", "OTRO", D(-9))],
              ["ejercicio", "mes", "cta_cte", "cod_imputacion", "concepto", "importe"])
    s = withholdings.bank_summary(b).first()
    assert s.gcias == D(4) and s.sellos == D(1) and s.retenciones == D(7)
    assert s.importe_neto == D(50) and s.importe_bruto == D(57)
    rend = frame(spark, "renditions", [("FUNCIONAMIENTO", "c", D(1)), ("OBRAS", "c", D(2)), (None, "c", D(3))],
                 ["origen", "cta_cte", "importe_bruto"])
    r = withholdings.renditions_for_withholdings(rend)
    assert r.count() == 2 and withholdings.renditions_summary(r, ["cta_cte"]).first().importe_bruto == D(5)
    per = frame(spark, "works_withholdings", [("L1", "110", D(1))], ["id_carga", "codigo", "importe"])
    lo = frame(spark, "works_loads", [("L1",)], ["id"])
    p = withholdings.withholdings_per_load(lo, per)
    assert p.columns == ["id_carga", "110", "111", "112", "113", "114", "337", "retenciones"]


def test_payroll_vouchers_and_treasury_debt(spark):
    vo = frame(spark, "expense_vouchers", [("2024", "01/2024", "V1", "130832-04", "150", D(10)),
                                           ("2024", "01/2024", "V2", "130832-04", "100", D(20)),
                                           ("2024", "01/2024", "V3", "x", "100", D(30))],
               ["ejercicio", "mes", "nro_comprobante", "cta_cte", "partida", "importe"])
    led = frame(spark, "ledger", [("2024", "01/2024", day("2024-01-09"), "2122-1-2", "CAP", "77", "245", D(0), D(4)),
                                  ("2024", "01/2024", day("2024-01-09"), "2122-1-2", "APE", "78", "245", D(0), D(9))],
                ["ejercicio", "mes", "fecha", "cta_contable", "tipo_comprobante", "nro_entrada", "auxiliar_1",
                 "debitos", "creditos"])
    out = debt.payroll_vouchers(vo, led, skip_art=True, net_codes=True)
    assert rows(out, "nro_comprobante", "importe") == [("00077/24A", D(-4)), ("V2", D(20))]
    syn = out.filter(F.col("clase_gto") == "REM").first()
    assert syn.glosa == "RET. GCIAS. 4TA CATEGORÍA" and syn.nro_expte == "900000002024" and syn.partida == "245"
    tr = frame(spark, "floating_debt", [("12/2024", D(1)), ("11/2024", D(2))], ["mes_hasta", "saldo"])
    assert remainder.treasury_debt(tr, "2024").count() == 1
    snaps = frame(spark, "floating_debt", [("2024", "A", "11/2024", D(1)), ("2024", "B", "12/2024", D(2)),
                                           ("2024", "C", "12/2024", D(3))],
                  ["ejercicio", "nro_comprobante", "mes_hasta", "saldo"])
    assert rows(remainder.latest_debt(snaps, "2024", drop_vouchers=["C"]), "nro_comprobante") == [("B",)]


def test_worksheet_and_execution(spark):
    bud = frame(spark, "budget", [("2024", "29-01-01-01-422", "29", "422", "10", D(5), D(9)),
                                  ("2024", "29-01-01-02-422", "29", "422", "11", D(5), D(9))],
                ["ejercicio", "estructura", "programa", "partida", "fuente", "saldo", "ordenado"])
    desc = spark.createDataFrame([("29-01-01-01", "P", "S", "Y", "A")],
                                 "actividad string, desc_prog string, desc_subprog string, desc_proy string, "
                                 "desc_act string")
    ws = remainder.worksheet(bud, desc).collect()
    assert len(ws) == 1 and ws[0].estructura == "29-01-01-01" and ws[0].act_con_desc == "A"
    assert ws[0].saldo_remte == D(5) and ws[0].remte == D(0) and ws[0].f_y_f is None
    e2 = sources_clean.works_execution_icaro_desc(bud, desc)
    assert e2.columns[:6] == ["estructura", "partida", "fuente", "prog_con_desc", "proy_con_desc", "act_con_desc"]
    assert rows(e2, "estructura", "act_con_desc") == [("29-01-01-01", "A"), ("29-01-01-02", None)]
    sdesc = spark.createDataFrame([("29-01-01-01-422", "P", "S", "Y", "A")], "estructura string, desc_prog string, "
                                  "desc_subprog string, desc_proy string, desc_act string")
    e1 = sources_clean.works_execution(bud, sdesc, current_only="2024")
    assert e1.columns[:7] == ["estructura", "partida", "fuente", "desc_prog", "desc_subprog", "desc_proy", "desc_act"]
    eg = sources_clean.expense_execution(bud, sdesc)
    assert eg.first().programa == 29 and eg.columns[0] == "ejercicio"


def test_receivables_more(spark):
    new = frame(spark, "new_neighbourhoods", [("2024", "001", D(10)), ("2024", "002", D(5))],
                ["ejercicio", "cod_barrio", "importe_total"])
    rnb = frame(spark, "reason_neighbourhood_balance", [("2024", "001", "001", D(10)), ("2024", "003", "001", D(1))],
                ["ejercicio", "cod_barrio", "cod_motivo", "importe"])
    assert rows(receivables.new_vs_delivered_by_neighbourhood(new, rnb), "cod_barrio") == [("002",)]
    coll = frame(spark, "collected", [("2018", "01/2018", D(1), D(100), D(-2)), ("2016", "01/2016", D(1), D(9), D(0))],
                 ["ejercicio", "mes", "amortizacion", "recaudado_total", "pend_acreditacion"])
    bk = spark.createDataFrame([("2018", "01/2018", D(90)), ("2016", "01/2016", D(9))],
                               "ejercicio string, mes string, importe decimal(18,2)")
    cv = receivables.collected_vs_bank(coll, bk).first()
    assert cv.ejercicio == "2018" and cv.diferencia == D(10) and cv["dif%"] == 10.0
    cm = receivables.collected_vs_bank(coll, bk, by_month=True).first()
    assert cm.mes == "01"
    pend = receivables.concept_share_of_collected(coll, "pend_acreditacion").first()
    assert pend.participacion == 2.0
    billed = frame(spark, "billed", [("2018", D(50))], ["ejercicio", "facturado_total"])
    bal = frame(spark, "neighbourhood_balance", [("2018", "b", D(200))], ["ejercicio", "barrio", "saldo_actual"])
    sh = {r.concepto: r.participacion for r in receivables.billed_collected_share(billed, coll, bal)
          .filter(F.col("ejercicio") == "2018").collect()}
    assert sh == {"facturado": 25.0, "recaudado": 50.0}
    assert receivables.balance_per_year(bal, scale=100).first().saldo_actual == 2.0
    var = frame(spark, "receivable_variation", [("2024", "SALDO AL INICIO:"), ("2024", "OTRO")],
                ["ejercicio", "concepto"])
    assert receivables.opening_closing(var).count() == 1
    assert rows(receivables.new_vs_delivered(new, frame(spark, "reason_balance", [("2024", "1", D(3))],
                                                         ["ejercicio", "cod_motivo", "importe"])),
                "diferencia") == [(D(12),)]


def test_loads_with_descriptions_and_basic_modules(spark):
    ld = frame(spark, "works_loads", [("L1", "2024", "PA6", "29-01", "422", "20-1", "O1"),
                                      ("L2", "2024", "REG", "29-01", "422", "20-1", "O1"),
                                      ("L3", "2024", "CYO", "30-01", "421", "20-2", "O2"),
                                      ("L4", "2025", "CYO", "29-01", "422", "20-1", "O1"),
                                      ("L5", "2024", "CYO", "29-01", "100", "20-1", "O1")],
               ["id", "ejercicio", "tipo", "actividad", "partida", "cuit", "obra"])
    desc = spark.createDataFrame([("29-01-422", "DESC")], "estructura string, desc_act string")
    prov = frame(spark, "suppliers", [("20-1", "ACME"), ("20-1", "ACME SA")], ["cuit", "desc_prov"])
    acc = sources_clean.loads_with_descriptions(ld, desc, prov, up_to_year="2024")
    assert rows(acc, "id", "desc_act", "proveedor") == [("L2", "DESC", "ACME"), ("L3", None, None)]
    cash = sources_clean.loads_with_descriptions(ld, desc, prov, cash_basis=True, years=["2024"])
    assert rows(cash, "id") == [("L1",), ("L3",)]
    wl = frame(spark, "works_list", [("O1", "CAPITAL", "R1", "CONV")], ["obra", "localidad", "norma_legal",
                                                                        "info_adicional"])
    bm = sources_clean.basic_module_loads(ld, wl, desc, prov, up_to_year="2024")
    assert rows(bm, "id", "localidad", "desc_act") == [("L2", "CAPITAL", "DESC"), ("L5", "CAPITAL", None)]


def test_revenue_controls_flag_rules(spark):
    rev = frame(spark, "revenue_vouchers", [("2024", "01/2024", "10270", D(10), False, False, True),
                                            ("2024", "01/2024", "10270", D(5), None, False, True),
                                            ("2024", "01/2024", "10270", D(7), True, False, True)],
                ["ejercicio", "mes", "cta_cte", "importe", "es_propio", "es_remanente", "es_verificado"])
    dep = controls.revenue_deposits(_bank(spark))
    r = {(x.mes, x.cta_cte): x for x in controls.revenue_vs_deposits(rev, dep).collect()}
    assert r[("01/2024", "10270")].recursos_siif == D(10)  # NULL or True flags are not third-party revenue
    assert r[("02/2024", "10270")].depositos_sscc == D(50) and r[("02/2024", "10270")].diferencia == D(-50)
    g = controls.revenue_vs_deposits_by_group(rev.withColumn("grupo", controls.fund_group("cta_cte")), dep)
    assert rows(g, "mes", "grupo", "recursos_siif", "depositos_banco") == [("01/2024", "FONAVI", D(10), None),
                                                                           ("02/2024", "FONAVI", None, D(50))]


def test_ledger_bank_gap_composite(spark):
    lvb = spark.createDataFrame([("2024", "c", D(10), D(4), D(6))], "ejercicio string, cta_cte string, "
                                "sldo_siif decimal(18,2), sldo_banco decimal(18,2), dif_sldo decimal(18,2)")

    def ctrl(v, col="diferencia"):
        return spark.createDataFrame([("2024", D(v))], f"ejercicio string, {col} decimal(18,2)")

    out = bank.ledger_bank_gap(lvb, ctrl(1), ctrl(-2), ctrl(-3), ctrl(-1), fees_ctrl=ctrl(5, "importe_bruto"))
    got = {r.concepto: r.importe for r in out.collect()}
    assert got["recursos_dif"] == D(-1) and got["dif_sldo_ajustado"] == D(6 - 1 - 2 - 3 - 1 + 5)


def test_fee_summaries(spark):
    vo = frame(spark, "expense_vouchers", [("2024", "01/2024", "1/24", "c", D(10), True, False),
                                           ("2024", "01/2024", "1/24", "c", D(5), True, True)],
               ["ejercicio", "mes", "nro_comprobante", "cta_cte", "importe", "es_pagado", "es_aprobado"])
    s = fees.fee_vouchers_summary(vo).first()
    assert s.importe == D(15) and s.es_pagado == 2 and s.es_aprobado == 1  # flags counted, as the original
    assert "es_pagado" not in fees.fee_vouchers_summary(vo, count_flags=False).columns
    rd = frame(spark, "renditions", [("2024", "01/2024", "20-1", "X", D(100), D(1), D(2), D(3), D(4), D(5), D(6))],
               ["ejercicio", "mes", "cuit", "beneficiario", "importe_bruto", "otras", "gcias", "suss", "propia",
                "salud", "mutual"])
    r = fees.fee_renditions_summary(rd).first()
    assert r.otras == D(21) and "gcias" not in r.asDict()
    assert fees.fee_renditions_summary(rd, only_gross=True).columns == ["ejercicio", "mes", "cuit", "beneficiario",
                                                                        "importe_bruto"]


def test_report_runs_write_every_table(spark):
    import tempfile

    from arqueo.plans import reports
    bud = frame(spark, "budget", [("2024", "29-01-01-01-422", "29", "422", "10", D(5), D(9))],
                ["ejercicio", "estructura", "programa", "partida", "fuente", "saldo", "ordenado"])
    wdesc = spark.createDataFrame([("29-01-01-01", "P", "S", "Y", "A")], "actividad string, desc_prog string, "
                                  "desc_subprog string, desc_proy string, desc_act string")
    ldesc = spark.createDataFrame([("29-01-01-01-422", "P", "S", "Y", "A")], "estructura string, desc_prog string, "
                                  "desc_subprog string, desc_proy string, desc_act string")
    final = frame(spark, "bank_final_balance", [("2024", "130832-03", D(100))], ["ejercicio", "cta_cte", "saldo"])
    snaps = frame(spark, "floating_debt", [("2024", "V1", "10", "12/2024", D(30))],
                  ["ejercicio", "nro_comprobante", "fuente", "mes_hasta", "saldo"])
    rev = frame(spark, "revenue_vouchers", [("2024", "10", D(80), False)], ["ejercicio", "fuente", "importe",
                                                                            "es_remanente"])
    out = reports.remainder_report(bud, wdesc, final, snaps, snaps, rev, "2024", tempfile.mkdtemp(prefix="arqueo-r-"))
    assert len(out) == 8 and spark.read.parquet(out["rem_met_1"]).count() == 3
    loads = frame(spark, "works_loads", [("L1", "2024", "CYO", "11", "29-01-01-01", "422", "20-1", "O1", D(10), 0.5)],
                  ["id", "ejercicio", "tipo", "fuente", "actividad", "partida", "cuit", "obra", "importe", "avance"])
    prov = frame(spark, "suppliers", [("20-1", "ACME")], ["cuit", "desc_prov"])
    wl = frame(spark, "works_list", [("O1", "CAPITAL", "R1", "CONV")], ["obra", "localidad", "norma_legal",
                                                                        "info_adicional"])
    out = reports.works_execution_report(bud, ldesc, wdesc, loads, prov, wl, "2024",
                                         tempfile.mkdtemp(prefix="arqueo-w-"), last_n=2)
    assert len(out) == 8
    row = spark.read.parquet(out["mod_basicos_por_convenio"]).first()
    assert (row.info_adicional, row.importe) == ("CONV", D(10))


def test_registered_controls_have_matched_and_unmatched_keys(spark):
    """The controls over the driver tables see keys of both sides and of either side alone."""
    from arqueo.plans import catalog
    sf = "/root/testdata/sf0.001"
    for name, left, right in (("d_sg1", "neto_sgf", "debitos_sscc"), ("d_cr1", "recursos_siif", "depositos_sscc"), ("d_cr2", "recursos_siif", "depositos_banco")):
        d = catalog.QUERIES[name](spark, sf).fillna(0, subset=[left, right])
        both = d.filter((F.col(left) != 0) & (F.col(right) != 0)).count()
        assert both > 0 and d.filter((F.col(left) != 0) & (F.col(right) == 0)).count() > 0, name
        assert d.filter((F.col(left) == 0) & (F.col(right) != 0)).count() > 0, name
    assert {r.grupo for r in catalog.QUERIES["d_cr2"](spark, sf).select("grupo").distinct().collect()} == {"FONAVI", "RECUPEROS", "OTROS"}
    assert catalog.QUERIES["d_fc1"](spark, sf).select("ejercicio").distinct().count() == 4
