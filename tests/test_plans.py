"""Named reports on hand-made rows (schemas of FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import functions as F

from arqueo import operators as op
from arqueo.plans import bank, controls, debt, fees, receivables, remainder, sources_clean, withholdings, works
from arqueo.sources.schemas import SCHEMAS
from conftest import D, day, rows


def frame(spark, name, data, cols):
    schema = SCHEMAS[name]
    full = [{c: None for c in schema.fieldNames()} | dict(zip(cols, r)) for r in data]
    return spark.createDataFrame([tuple(d[c] for c in schema.fieldNames()) for d in full], schema)


BANK_COLS = ["ejercicio", "mes", "fecha", "cta_cte", "movimiento", "concepto", "cod_imputacion", "importe", "es_cheque"]


def _bank(spark):
    return frame(spark, "bank", [
        ("2024", "01/2024", day("2024-01-02"), "130832-04", "DEBITO", "HABERES ENERO", "002", D(-100), False),
        ("2024", "01/2024", day("2024-01-03"), "130832-04", "DEBITO", "GCIAS", "002", D(-7), False),
        ("2024", "01/2024", day("2024-01-04"), "130832-04", "DEBITO", "TRANSF", "034", D(-5), False),
        ("2024", "02/2024", day("2024-02-01"), "10270", "DEPOSITO", "FONAVI", "001", D(50), False),
        ("2024", "02/2024", day("2024-02-02"), "334", "DEPOSITO", "CUOTAS", "018", D(9), False),
        ("2024", "02/2024", day("2024-02-03"), "130832-05", "DEBITO", "EMBARGO", "049", D(-3), False),
        ("2024", "02/2024", day("2024-02-03"), "130832-05", "DEBITO", "COMISION", "031", D(-2), False),
        ("2024", "02/2024", day("2024-02-05"), "130832-08", "DEBITO", "ESCRIBANO", "040", D(-11), False),
    ], BANK_COLS)


def test_cash_flow_and_running_balance(spark):
    b = _bank(spark)
    cf = bank.yearly_cash_flow(b)
    got = dict((r.clase, r.importe) for r in cf.collect())
    # 001/002 revenue; 049, 031, 040 operating; 018 works; 034 none of them
    assert got["1 - Recursos"] == D(-57) and got["2 - Gtos. Funcionamiento"] == D(-16)
    assert got["3 - Inversión Obras"] == D(9) and got["4 - OTROS"] == D(-5)
    rb = bank.running_balance_at_period_end(b, up_to_year="2024")
    assert rows(rb.filter(F.col("cta_cte") == "130832-04"), "mes", "saldo") == [("01/2024", D(-112))]


def test_payroll_bank_and_revenue_deposits(spark):
    b = _bank(spark)
    pb = controls.bank_payroll(b)
    assert rows(pb, "importe") == [(D(100),)]  # income tax text and transfer code dropped, sign flipped
    dep = controls.revenue_deposits(b)
    assert rows(dep, "cta_cte", "grupo") == [("10270", "FONAVI")]  # code 018 is not revenue
    dep_parity = controls.revenue_deposits(b, parity=True)
    assert rows(dep_parity, "grupo") == [("FONAVI",), ("RECUPEROS",)]  # the original excluded '18', not '018'
    assert rows(controls.receivable_deposits(b, parity=True), "cta_cte") == [("334",)]


def test_payments_vs_bank_tolerance(spark):
    rend = frame(spark, "renditions", [("01/2024", "130832-04", D(100), D(7)), ("02/2024", "x", D(1), D(0))],
                 ["mes", "cta_cte", "importe_neto", "retenciones"])
    out = controls.payments_vs_bank(rend, _bank(spark))
    got = dict(((r.mes, r.cta_cte), r.diferencia) for r in out.collect())
    # Jan 04: bank debits 100 + 7 + 5 = 112 vs 107 -> -5
    assert got[("01/2024", "130832-04")] == D(-5)
    assert ("02/2024", "130832-05") in got and got[("02/2024", "130832-05")] == D(-3)  # code 031 left out


def test_works_report_status(spark):
    w = spark.createDataFrame([
        ("a1", "w1", "2022", 0.5, D(10)), ("a1", "w1", "2023", 1.0, D(20)),   # finished 2023 (before 2024)
        ("a1", "w2", "2024", 0.3, D(5)),                                      # in progress
        ("a1", "w3", "2024", 1.2, D(7)),                                      # above 1: neither
        ("a1", "w4", "2023", None, D(3)),                                      # never set: neither
    ], "actividad string, obra string, ejercicio string, avance double, importe decimal(18,2)")
    r = works.works_report(w, ["actividad"], "2024", pivot_years=["2023", "2024"]).first()
    assert r.alta == "2022" and r.acum == D(45) and r.en_curso == D(5)
    assert r.terminadas_ant == D(30) and r.terminadas_actual == D(10)
    assert r["2023"] == D(23) and r["2024"] == D(12)
    a = works.works_as_of_years(w, ["actividad"], ["2023", "2024"])
    got = {x.ejercicio: x for x in a.collect()}
    assert got["2023"].acum == D(33) and got["2023"].ejecucion == D(23) and got["2023"].terminadas_ant == D(0)
    assert got["2024"].terminadas_ant == D(30) and got["2024"].en_curso == D(5)
    # as of 2023 work w1 reached 1 that year: not in progress, finished now
    assert got["2023"].en_curso == D(0) and got["2023"].terminadas_actual == D(33)


def test_opening_balances_and_descriptions(spark):
    sheet = frame(spark, "opening_2008", [
        (1, "29", None, None, None, "VIVIENDA", None, None, None, None, None),
        (2, "29", "00", "02", None, "BARRIO", None, None, None, None, None),
        (3, "29", "00", "02", "03", "CASAS", "29-00-02-03-421", "29-00-02-03", "421", "2007", D(5)),
        (4, "29", "00", "02", "04", None, "29-00-02-04-422", "29-00-02-04", "422", "2006", None)],
        ["row_no", "prog", "subprog", "proy", "obra", "descripcion", "estructura", "actividad", "partida", "alta", "acum_2008"])
    ob = works.opening_balances(sheet)
    assert rows(ob, "estructura", "desc_prog", "desc_subprog", "desc_proy", "desc_act", "alta", "acum_2008") == [
        ("29-00-02-03-421", "29 - VIVIENDA", "00 - --", "02 - BARRIO", "03 - CASAS", "2007", D(5)),
        ("29-00-02-04-422", "29 - VIVIENDA", "00 - --", "02 - BARRIO", None, "2006", None)]
    # through the as-of-year report: the balance is finished before the first year
    loads = spark.createDataFrame([("29-00-02-03", "421", "w1", "2009", 0.5, D(7), "p", "y", "own text")],
                                  "actividad string, partida string, obra string, ejercicio string, avance double, "
                                  "importe decimal(18,2), desc_prog string, desc_proy string, desc_act string")
    rep = works.works_ledger_for_accounting(loads, ["desc_prog", "desc_proy", "desc_act", "actividad", "partida"],
                                            opening=ob).collect()
    got = {(r.estructura, r.ejercicio): r for r in rep}
    assert got["29-00-02-03-421", "2009"].desc_act == "own text" and got["29-00-02-03-421", "2009"].alta == "2008"
    assert got["29-00-02-03-421", "2009"].acum == D(12) and got["29-00-02-03-421", "2009"].terminadas_ant == D(5)
    prog = frame(spark, "programs", [("29", "VIVIENDA")], ["programa", "desc_prog"])
    sub = frame(spark, "subprograms", [("29-01", "29", None)], ["subprograma", "programa", "desc_subprog"])
    proy = frame(spark, "projects", [("29-01-02", "29-01", "BARRIO")], ["proyecto", "subprograma", "desc_proy"])
    act = frame(spark, "activities", [("29-01-02-03", "29-01-02", "CASAS")], ["actividad", "proyecto", "desc_act"])
    dsc = works.works_descriptions(prog, sub, proy, act).first()
    assert (dsc.desc_prog, dsc.desc_subprog, dsc.desc_proy, dsc.desc_act) == (
        "29 - VIVIENDA", "01 - ", "02 - BARRIO", "03 - CASAS")


def test_budget_descriptions_newest_wins(spark):
    sd = frame(spark, "structure_desc", [
        ("2023", "01-00-00-01", "01", "00", "00", "01", "PROG VIEJO", "S", "P", "A"),
        ("2024", "01-00-00-01", "01", "00", "00", "01", "PROG NUEVO", "S", "P", "A2")],
        ["ejercicio", "estructura", "programa", "subprograma", "proyecto", "actividad", "desc_prog", "desc_subprog",
         "desc_proy", "desc_act"])
    r = works.budget_descriptions(sd).first()
    assert r.desc_prog == "01 - PROG NUEVO" and r.desc_act == "01 - A2"
    r = works.budget_descriptions(sd, up_to_year="2023").first()
    assert r.desc_prog == "01 - PROG VIEJO"


def test_remainder_methods(spark):
    final = frame(spark, "bank_final_balance", [("2024", "130832-03", D(100)), ("2024", "130832-16", D(10)),
                                                ("2024", "999", D(5000000))], ["ejercicio", "cta_cte", "saldo"])
    debt_ = frame(spark, "floating_debt", [("10", D(30)), ("12", D(5)), ("13", D(1)), ("11", D(2))],
                  ["fuente", "saldo"])
    m1 = {r.fuente: r for r in remainder.method_1(final, debt_).collect()}
    assert m1["Fuente 10 y 12"].rte_met_1 == D(65)
    assert m1["Fuente 13"].saldo_bco == D("4262072.77") and m1["Fuente 11"].saldo_bco == D("737937.23")
    rev = frame(spark, "revenue_vouchers", [("2024", "10", D(80), False), ("2025", "10", D(3), True),
                                            ("2024", "13", D(9), False)], ["ejercicio", "fuente", "importe",
                                                                           "es_remanente"])
    bud = frame(spark, "budget", [("2024", "10", D(50), D(1)), ("2024", "12", D(4), D(0))],
                ["ejercicio", "fuente", "ordenado", "saldo"])
    m2 = {r.fuente: r for r in remainder.method_2(op.years(rev, "2024"), bud).collect()}
    assert m2["10"].rte_met_2 == D(30) and m2["13"].rte_met_2 is None and m2["12"].recursos is None
    hist = remainder.method_2_history(rev, bud).collect()
    assert [(r.ejercicio, r.fuente, r.rte_solicitado, r.dif_rte_solicitado) for r in hist] == [
        ("2024", "10", D(3), D(3) - D(30))]
    cmp_ = {r.fuente: r for r in remainder.methods_compared(remainder.method_1(final, debt_),
                                                             remainder.method_2(op.years(rev, "2024"), bud)).collect()}
    assert cmp_["Fuente 10 y 12"].rte_met_2 == D(30)


def test_receivables(spark):
    reasons = frame(spark, "reason_balance", [("2024", "1", "ENTREGA", D(-60)), ("2024", "2", "X", D(30)),
                                              ("2024", "3", "Y", D(10)), ("2023", "2", "X", D(8))],
                    ["ejercicio", "cod_motivo", "motivo", "importe"])
    coll = frame(spark, "collected", [("2024", "01/2024", D(-4), D(100))], ["ejercicio", "mes", "amortizacion",
                                                                          "recaudado_total"])
    allr = receivables.reasons_with_amortisation(reasons, coll)
    assert allr.filter(F.col("cod_motivo") == "AM").first().importe == D(-4)
    rk = receivables.reason_ranking(allr, "2024")
    assert rows(rk, "cod_motivo", "ranking") == [("1", 1), ("2", 2), ("3", 3), ("AM", 4)]
    top = receivables.top_reasons_over_time(allr, "2024", n=2)
    assert rows(top.filter(F.col("ejercicio") == "2024"), "cod_motivo", "importe") == [("1", D(60)), ("2", D(30)),
                                                                                        ("OT", D(14))]
    new = frame(spark, "new_neighbourhoods", [("2024", "B1", D(60))], ["ejercicio", "cod_barrio", "importe_total"])
    assert rows(receivables.new_vs_delivered(new, reasons), "diferencia") == [(D(120),)]
    var = frame(spark, "balance_variation", [("2023", "B1", D(0), D(-0.001), D(0), D(5)),
                                             ("2024", "B1", D(5), D(0), D(1), D(6)),
                                             ("2023", "B2", D(0), D(-3), D(0), D(9)),
                                             ("2024", "B2", D(9), D(-1), D(0), D(8))],
                ["ejercicio", "barrio", "saldo_inicial", "amortizacion", "cambios", "saldo_final"])
    assert rows(receivables.without_amortisation(var, "2024"), "barrio") == [("B1",)]
    ww = dict((r.concepto, r.importe) for r in receivables.with_without_amortisation(var, "2024").collect())
    assert ww == {"Barrios sin amortizaciones": D(1), "Barrios con amortizaciones": D(1)}
    chk = receivables.variation_check(var).filter(F.col("ejercicio") == "2024").first()
    assert chk.suma_algebraica == D(14) and chk["%_saldo_explicado"] is None  # 0 / 0


def test_withholdings_chain(spark):
    loads = frame(spark, "works_loads", [("L1", "2024", "01/2024", "c1", "1/24", D(100)),
                                         ("L2", "2024", "01/2024", "c1", "2/24", D(-50))],
                  ["id", "ejercicio", "mes", "cta_cte", "nro_comprobante", "importe"])
    wh = frame(spark, "works_withholdings", [("L1", "110", D(3)), ("L1", "113", D(2)), ("L2", "110", D(1)),
                                             ("LX", "110", D(99))], ["id_carga", "codigo", "importe"])
    lw = withholdings.loads_with_withholdings(loads, wh)
    got = {r.id: r for r in lw.collect()}
    assert got["L1"].retenciones == D(5) and got["L1"].importe_neto == D(95) and got["L1"].iibb == D(3)
    assert got["L2"].retenciones == D(-1) and got["L2"].importe_neto == D(-49)  # sign follows the gross
    s = withholdings.loads_summary(lw)
    assert s.first().importe_bruto == D(50)
    led = frame(spark, "ledger", [
        ("2024", "01/2024", "1112-2-6", "CAP", "E1", "130832-03", None, None),
        ("2024", "01/2024", "2111-1-2", "CAP", "E1", "20-1", D(90), D(0)),
        ("2024", "01/2024", "2122-1-2", "CAP", "E1", "110", D(3), D(0)),
        ("2024", "01/2024", "2122-1-2", "CAP", "E1", "999", D(1), D(0))],
        ["ejercicio", "mes", "cta_contable", "tipo_comprobante", "nro_entrada", "auxiliar_1", "debitos", "creditos"])
    cp = withholdings.contractor_payments(led)
    wp = withholdings.withholding_payments(led)
    assert rows(wp, "cod_ret", "cta_cte") == [("iibb", "130832-03")]
    ls = withholdings.ledger_summary(cp, wp, ["ejercicio", "mes", "cta_cte"]).first()
    assert ls.importe_neto == D(90) and ls.iibb == D(3) and ls.importe_bruto == D(93)
    left = s.withColumn("cta_cte", F.lit("130832-03"))
    cmpd = withholdings.compare(left, withholdings.ledger_summary(cp, wp, ["ejercicio", "mes", "cta_cte"]))
    assert cmpd.count() == 1 and cmpd.columns == left.columns  # only the left summary's columns
    assert cmpd.first().iibb == D(4) - D(3) and cmpd.first().importe_bruto == D(50) - D(93)
    folded = withholdings.compare(left, left, how="union", fold_lp=True)
    assert "lp" not in folded.columns and folded.first().sellos == D(0)


def test_fees_and_debits(spark):
    fe = frame(spark, "fees", [("2024", "01/2024", "10/24", D(100), D(3), D(1), D(1), D(2)),
                               ("2024", "01/2024", "SIIF 11/24", D(5), None, None, None, None)],
               ["ejercicio", "mes", "nro_comprobante", "importe_bruto", "iibb", "sellos", "lp", "seguro"])
    vo = frame(spark, "expense_vouchers", [("2024", "01/2024", "10/24", "130832-05", D(100), "355")],
               ["ejercicio", "mes", "nro_comprobante", "cta_cte", "importe", "partida"])
    fwa = fees.fees_with_account(fe, vo)
    assert fwa.count() == 1 and fwa.first().cta_cte == "130832-05"
    fsum = fees.fees_summary(fwa).first()
    # stamps 1 + lp 1; insurance 2 stays its own column; withholdings 3 + 2 + 2 + 0
    assert fsum.sellos == D(2) and fsum.seguro == D(2) and fsum.otras == D(0) and fsum.importe_neto == D(93)
    chk = fees.ledger_vs_fees(vo, fwa)
    assert chk.count() == 0
    dc = fees.debits_control(vo, _bank(spark), ["ejercicio", "mes", "cta_cte"]).collect()
    got = dict(((r.mes, r.cta_cte), r.diferencia) for r in dc)
    assert got[("01/2024", "130832-05")] == D(100) and got[("02/2024", "130832-05")] == D(-2)
    nb = fees.notary_bank_summary(_bank(spark), ["ejercicio", "mes", "cod_imputacion"])
    assert rows(nb, "cod_imputacion", "importe_neto") == [("040", D(11))]


def test_debt_vs_accounting(spark):
    led = frame(spark, "ledger", [
        ("2023", "2111-1-2", "CAP", "100", "2749", D(-5)),
        ("2023", "2111-1-2", "AJU", "202", "79", D(-3)),
        ("2023", "2111-1-2", "AJU", "200", "77", D(-0.05)),
        ("2023", "2241-1-1", "AJU", "201", "78", D(-9)),
        ("2024", "2111-1-2", "CAP", "300", "12", D(-6)),
        ("2024", "1112-2-6", "CAP", "300", "12", D(6))],
        ["ejercicio", "cta_contable", "tipo_comprobante", "nro_entrada", "nro_original", "saldo"])
    assert debt.liabilities(led, "2023").count() == 4
    snaps = frame(spark, "floating_debt", [
        ("2023", "02749/23", "2749", "11/2023", D(4)), ("2023", "02749/23", "2749", "12/2023", D(5)),
        ("2024", "00012/24", "12", "12/2024", D(6)), ("2023", "02749/23", "2749", "12/2024", D(5))],
        ["ejercicio", "nro_comprobante", "nro_origen", "mes_hasta", "saldo"])
    out = debt.debt_with_accounting(snaps, led, ["2023", "2024"])
    assert rows(out["rdeu012"], "ejercicio_contable", "nro_comprobante") == [
        ("2023", "02749/23"), ("2024", "00012/24"), ("2024", "02749/23")]
    # the 2023 filter keeps entry 100 (own voucher 2749) and the adjustments of 2023
    assert rows(out["rcocc31"], "ejercicio", "nro_original") == [
        ("2023", "2749"), ("2023", "77"), ("2023", "78"), ("2023", "79"), ("2024", "12")]
    m = out["rdeu_cta_contable"]
    got = rows(m.filter(F.col("nro_entrada").isNotNull()), "ejercicio_contable", "nro_original", "nro_entrada")
    # 2024 sees the ledger accumulated since 2023: voucher 2749 (carried over) still matches entry 100
    assert ("2024", "2749", "100") in got and ("2023", "2749", "100") in got and ("2024", "12", "300") in got
    # adjustment 79 counts as debt in both report years (repeated, as the original); 77 is below 0.1; 78 skipped
    aju = rows(m.filter(F.col("tipo_comprobante") == "AJU").filter(F.col("fuente") == "11"),
               "ejercicio_contable", "nro_original", "saldo_rdeu")
    assert aju == [("2023", "79", D(3)), ("2024", "79", D(3))]
    cls = debt.debt_with_accounting_class(snaps, led, ["2023", "2024"])
    assert rows(cls, "nro_original", "nro_entrada") == [("12", "300"), ("2749", "100")]


def test_voucher_and_advance_controls(spark):
    ledger = frame(spark, "expense_vouchers", [
        ("2024", "00001/24", "11", D(100), "01/2024", "c1", "20-1", "421", "REG", None),
        ("2024", "00002/24", "11", D(50), "01/2024", "c1", "20-1", "421", "REG", "7"),
    ], ["ejercicio", "nro_comprobante", "fuente", "importe", "mes", "cta_cte", "cuit", "partida", "clase_reg",
        "nro_fondo"])
    loads = frame(spark, "works_loads", [
        ("2024", "00001/24", "CYO", "11", D(60), "01/2024", "c1", "20-1", "421"),
        ("2024", "00001/24", "CYO", "11", D(40), "01/2024", "c1", "20-1", "421"),
        ("2024", "00007/24", "PA6", "11", D(80), "12/2023", "c1", "20-1", "421"),
        ("2024", "00002/24", "REG", "11", D(50), "01/2024", "c1", "20-1", "421"),
    ], ["ejercicio", "nro_comprobante", "tipo", "fuente", "importe", "mes", "cta_cte", "cuit", "partida"])
    vc = controls.voucher_control(ledger, loads)
    # voucher 1: REG without fund counts as CYO; its two load lines together are the ledger's amount
    assert vc.count() == 0
    # several lines on both sides face line by line: nothing differs
    two = ledger.unionByName(ledger.filter(F.col("nro_fondo").isNull()).withColumns({"partida": F.lit("422"), "importe": F.lit(200).cast("decimal(18,2)")}))
    both = loads.unionByName(loads.filter(F.col("importe") == 60).withColumns({"partida": F.lit("422"), "importe": F.lit(200).cast("decimal(18,2)")}))
    assert controls.voucher_control(two, both).count() == 0
    # a line under another code is paired with it, a missing one stands alone
    other = controls.voucher_control(two, both.withColumn("partida", F.when(F.col("partida") == "422", "423").otherwise(F.col("partida"))))
    assert rows(other, "siif_partida", "icaro_partida", "err_partida", "err_importe", "err_nro") == [("422", "423", True, False, False)]
    assert rows(controls.voucher_control(two, loads), "siif_partida", "icaro_nro", "err_nro") == [("422", None, True)]
    funds = frame(spark, "fund_summary", [("2024", "7", "12/2023", D(80), D(30))],
                  ["ejercicio", "nro_fondo", "mes", "ingresos", "saldo"])
    adv = controls.advances_control(funds, ledger, loads)
    assert adv.count() == 0  # the advance and its regularisation match on both systems
    # a regularisation in several ledger lines is one sum too
    split = ledger.filter(F.col("nro_fondo").isNull()).unionByName(
        ledger.filter(F.col("nro_fondo") == "7").withColumn("importe", F.explode(F.array(F.lit(20), F.lit(30)).cast("array<decimal(18,2)>"))))
    assert controls.advances_control(funds, split, loads).count() == 0


def test_sources_cleaning(spark):
    rend = frame(spark, "renditions", [
        ("2024", "01/2024", day("2024-01-02"), "A", "106", "L1", D(10)),
        ("2024", "01/2024", day("2024-01-02"), "A", "106", "L1", D(10)),
        ("2024", "01/2024", day("2024-01-02"), "A", "200", "L1", D(10)),
        ("2024", "01/2024", day("2024-01-02"), "A", "200", "L1", D(10))],
        ["ejercicio", "mes", "fecha", "beneficiario", "cta_cte", "libramiento_sgf", "importe_bruto"])
    assert sources_clean.renditions_clean(rend).count() == 3
    b = _bank(spark)
    with_cert = sources_clean.renditions_clean(rend, b, net_negative_certificates=True)
    cert = with_cert.filter(F.col("cuit") == sources_clean.NEGATIVE_CERTIFICATE_CUIT).first()
    assert cert.importe_neto == D(-9) and cert.importe_bruto == D(-9) and cert.origen == "BANCO"
    assert rows(sources_clean.bank_payments(b).filter(F.col("cod_imputacion") == "049"), "importe") == [(D(3),)]


def test_basic_module_report_by_agreement(spark):
    ld = spark.createDataFrame([
        ("29-01", "422", "11", "w1", "2023", 1.0, D(10), "CONV A"), ("29-01", "422", "11", "w2", "2024", 0.5, D(5), ""),
        ("29-01", "422", "10", "w3", "2024", 0.5, D(99), "CONV A")],
        "actividad string, partida string, fuente string, obra string, ejercicio string, avance double, "
        "importe decimal(18,2), info_adicional string")
    long = works.basic_module_report(ld, "2024", by_agreement=True)
    assert rows(long, "obra", "info_adicional", "importe") == [("w1", "CONV A", D(10)), ("w2", "Sin Convenio", D(5))]
    r = works.basic_module_report(ld, "2024", by_agreement=True, columns=["CONV A", ""])
    got = {x.obra: x for x in r.collect()}
    assert set(got) == {"w1", "w2"} and got["w1"]["CONV A"] == D(10) and got["w2"]["Sin Convenio"] == D(5)
    assert got["w1"].terminadas_ant == D(10) and got["w2"].en_curso == D(5)
    by_year = works.basic_module_report(ld, "2024", by_agreement=False, columns=["2023", "2024"])
    assert {"2023", "2024"} <= set(by_year.columns) and by_year.count() == 3


def test_works_ledger_report_and_current_cash(spark):
    ld = spark.createDataFrame([
        ("29-01", "422", "11", "w1", "2023", 1.0, D(10), "CYO"), ("29-01", "421", "11", "w2", "2024", 0.5, D(5), "CYO"),
        ("29-01", "421", "11", "w2", "2024", 0.5, D(3), "PA6")],
        "actividad string, partida string, fuente string, obra string, ejercicio string, avance double, "
        "importe decimal(18,2), tipo string")
    accrual = ld.filter(F.col("tipo") != "PA6")
    rep = works.works_ledger_report(accrual, "2024", by_line=False, by_fund=False)
    assert rows(rep, "actividad", "ejercicio", "importe", "acum") == [("29-01", "2023", D(10), D(15)), ("29-01", "2024", D(5), D(15))]
    last = works.works_ledger_report(accrual, "2024", by_line=False, by_fund=False, last_n=1)
    assert rows(last, "ejercicio", "importe", "acum") == [("2024", D(5), D(15))]
    wide = works.works_ledger_report(accrual, "2024", by_line=False, by_fund=False, years=["2023", "2024"])
    assert wide.columns[:2] == ["actividad", "alta"] and rows(wide, "2023", "2024", "acum") == [(D(10), D(5), D(15))]
    cash = ld.filter(F.col("tipo") != "REG")
    out = works.works_ledger_for_accounting(accrual, ["actividad", "partida"], from_year=None, current_cash=cash,
                                            current_year="2024")
    got = {(r.estructura, r.ejercicio): r.acum for r in out.collect()}
    assert got[("29-01-421", "2024")] == D(8)  # the current year on cash basis includes the advance
