"""Registered receivables, bank and works reports over the driver tables, each with its oracle SQL.

The oracles are written from the report's definition, not from the code beside them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes as K
from ..functions.scalars import month_of, year_of
from ..sources.views import table
from . import bank, controls, receivables, withholdings
from .registry import V, fin, query

# ---------------------------------------------------------------- receivables

#: Balance variation of a neighbourhood (tax id) and year; the closing balance is negative in some.
VARIATION_SQL = """
v AS (SELECT ejercicio, cuit AS barrio, sum(importe_bruto) AS saldo_inicial,
             -sum(CASE WHEN codigo = 'R' THEN importe_bruto ELSE 0 END) AS amortizacion,
             sum(CASE WHEN codigo = 'N' THEN importe_bruto ELSE 0 END) AS cambios,
             sum(CASE WHEN codigo = 'A' THEN importe_bruto WHEN CAST(cuit AS BIGINT) % 5 = 0 THEN -importe_bruto ELSE 0 END) AS saldo_final
      FROM payments GROUP BY ALL)"""


def _variation(spark, d):
    n, gross = F.col("cuit").cast("long"), F.col("importe_bruto")
    pick = lambda cond, value=gross: F.sum(F.when(cond, value).otherwise(0))
    return V(spark, d, "payments").groupBy("ejercicio", F.col("cuit").alias("barrio")).agg(
        F.sum(gross).alias("saldo_inicial"), (-pick(F.col("codigo") == "R")).alias("amortizacion"), pick(F.col("codigo") == "N").alias("cambios"),
        F.sum(F.when(F.col("codigo") == "A", gross).when(n % 5 == 0, -gross).otherwise(0)).alias("saldo_final"))


def _collected(spark, d):
    return V(spark, d, "payments").select("ejercicio", "mes", F.col("importe_neto").alias("recaudado_total"), F.col("retenciones").alias("amortizacion"))


def _reasons(spark, d):
    return V(spark, d, "works").groupBy("ejercicio", F.col("partida").alias("cod_motivo"), F.concat(F.lit("motivo "), "partida").alias("motivo")).agg(
        F.sum("importe").alias("importe"))


@query("d_rc3", f"""
WITH {VARIATION_SQL},
g AS (SELECT ejercicio, sum(saldo_inicial) AS i, sum(amortizacion) AS a, sum(cambios) AS c, sum(saldo_final) AS f FROM v
      WHERE ejercicio IS NOT NULL GROUP BY 1)
SELECT ejercicio, CAST(i AS DOUBLE) AS saldo_inicial, CAST(a AS DOUBLE) AS amortizacion, CAST(c AS DOUBLE) AS cambios,
       CAST(f AS DOUBLE) AS saldo_final, CAST(i + a + c AS DOUBLE) AS suma_algebraica,
       CASE WHEN f <> i THEN CAST(a + c AS DOUBLE) / CAST(f - i AS DOUBLE) * 100.0 END AS "%_saldo_explicado" FROM g""")
def d_rc3(spark, d):
    return fin(receivables.variation_check(_variation(spark, d)))


@query("d_rc4", """
SELECT ejercicio, partida AS cod_motivo, 'motivo ' || partida AS motivo, CAST(sum(importe) AS DOUBLE) AS importe FROM works GROUP BY ALL
UNION ALL
SELECT ejercicio, 'AM', 'AMORTIZACION', CAST(sum(retenciones) AS DOUBLE) FROM payments WHERE ejercicio IS NOT NULL GROUP BY 1""")
def d_rc4(spark, d):
    reasons = _reasons(spark, d).withColumn("importe", F.col("importe").cast("decimal(38,4)"))
    collected = _collected(spark, d).withColumn("amortizacion", F.col("amortizacion").cast("decimal(28,4)"))
    return fin(receivables.reasons_with_amortisation(reasons, collected))


@query("d_rc7", """
WITH a AS (SELECT ejercicio, sum(saldo) AS n FROM snapshots WHERE ejercicio IS NOT NULL GROUP BY 1),
     b AS (SELECT ejercicio, sum(importe) AS e FROM works WHERE partida = 'A' GROUP BY 1)
SELECT ejercicio, CAST(n AS DOUBLE) AS barrios_nuevos, CAST(e AS DOUBLE) AS entrega_viviendas, CAST(n - e AS DOUBLE) AS diferencia
FROM a JOIN b USING (ejercicio)""")
def d_rc7(spark, d):
    new = V(spark, d, "snapshots").withColumnRenamed("saldo", "importe_total")
    return fin(receivables.new_vs_delivered(new, _reasons(spark, d), reason="A"))


@query("d_rc8", """
WITH a AS (SELECT obra AS cod_barrio, sum(importe) AS n FROM works WHERE fuente = '11' AND obra IS NOT NULL GROUP BY 1),
     b AS (SELECT obra AS cod_barrio, sum(importe) AS e FROM works WHERE partida = 'A' AND obra IS NOT NULL GROUP BY 1)
SELECT cod_barrio, CAST(n AS DOUBLE) AS barrios_nuevos, CAST(coalesce(e, 0) AS DOUBLE) AS entrega_viviendas,
       CAST(abs(n - coalesce(e, 0)) AS DOUBLE) AS diferencia_abs
FROM a LEFT JOIN b USING (cod_barrio) WHERE abs(n - coalesce(e, 0)) > 0.05""")
def d_rc8(spark, d):
    w = V(spark, d, "works").withColumnRenamed("obra", "cod_barrio")
    new = w.filter(F.col("fuente") == "11").withColumnRenamed("importe", "importe_total")
    return fin(receivables.new_vs_delivered_by_neighbourhood(new, w.withColumnRenamed("partida", "cod_motivo"), reason="A"))


@query("d_rc9", """
WITH c AS (SELECT substr(mes, 1, 2) AS mes, ejercicio, importe_neto FROM payments WHERE CAST(ejercicio AS INTEGER) > 1996),
b AS (SELECT substr(mes, 1, 2) AS mes, importe FROM bank WHERE movimiento = 'DEPOSITO' AND ejercicio IN (SELECT ejercicio FROM c)),
r AS (SELECT mes, x, y FROM (SELECT mes, sum(importe_neto) AS x FROM c GROUP BY 1) JOIN (SELECT mes, sum(importe) AS y FROM b GROUP BY 1) USING (mes))
SELECT mes, CAST(x AS DOUBLE) AS recaudado_recuperos, CAST(y AS DOUBLE) AS recaudado_banco, CAST(x - y AS DOUBLE) AS diferencia,
       CASE WHEN x <> 0 THEN CAST(x - y AS DOUBLE) / CAST(x AS DOUBLE) * 100.0 END AS "dif%" FROM r""")
def d_rc9(spark, d):
    deposits = V(spark, d, "bank").filter(F.col("movimiento") == "DEPOSITO")
    return fin(receivables.collected_vs_bank(_collected(spark, d), deposits, after_year=1996, by_month=True))


@query("d_rc10", """
WITH s AS (SELECT ejercicio, sum(saldo) AS s FROM snapshots WHERE ejercicio IS NOT NULL GROUP BY 1),
x AS (SELECT ejercicio, 'facturado' AS concepto, CAST(sum(importe_bruto) AS DECIMAL(38,4)) AS importe FROM payments WHERE ejercicio IS NOT NULL GROUP BY 1
      UNION ALL SELECT ejercicio, 'recaudado', CAST(sum(importe_neto) AS DECIMAL(38,4)) FROM payments WHERE ejercicio IS NOT NULL GROUP BY 1)
SELECT ejercicio, concepto, CAST(importe AS DOUBLE) AS importe, CAST(s AS DOUBLE) AS saldo_actual,
       CASE WHEN s <> 0 THEN CAST(importe AS DOUBLE) / CAST(s AS DOUBLE) * 100.0 END AS participacion
FROM x LEFT JOIN s USING (ejercicio) WHERE ejercicio > '1993'""")
def d_rc10(spark, d):
    p = V(spark, d, "payments")
    billed = p.select("ejercicio", F.col("importe_bruto").cast("decimal(20,4)").alias("facturado_total"))
    balances = V(spark, d, "snapshots").withColumnRenamed("saldo", "saldo_actual")
    return fin(receivables.billed_collected_share(billed, _collected(spark, d), balances, after_year="1993"))


@query("d_rc11", """
WITH g AS (SELECT ejercicio, sum(retenciones) AS a, sum(importe_neto) AS r FROM payments WHERE ejercicio IS NOT NULL GROUP BY 1)
SELECT ejercicio, CAST(a AS DOUBLE) AS amortizacion, CAST(r AS DOUBLE) AS recaudado_total,
       CASE WHEN r <> 0 THEN CAST(abs(a) AS DOUBLE) / CAST(r AS DOUBLE) * 100.0 END AS participacion FROM g WHERE ejercicio > '1993'""")
def d_rc11(spark, d):
    return fin(receivables.concept_share_of_collected(_collected(spark, d), "amortizacion", after_year="1993"))


WITHOUT_SQL = f"""{VARIATION_SQL},
p AS (SELECT barrio, sum(amortizacion) AS a FROM v WHERE saldo_final > 0 AND CAST(ejercicio AS INTEGER) < 1996 AND barrio IS NOT NULL GROUP BY 1),
w AS (SELECT v.*, -p.a AS amort FROM v JOIN p USING (barrio) WHERE v.ejercicio = '1996' AND v.saldo_final > 0 AND -p.a < 0.01)"""


@query("d_rc13", f"""
WITH {WITHOUT_SQL}
SELECT barrio, ejercicio, CAST(saldo_inicial AS DOUBLE) AS saldo_inicial, CAST(cambios AS DOUBLE) AS cambios,
       CAST(saldo_final AS DOUBLE) AS saldo_final, CAST(amort AS DOUBLE) AS amortizacion FROM w""")
def d_rc13(spark, d):
    return fin(receivables.without_amortisation(_variation(spark, d), "1996"))


@query("d_rc14", f"""
WITH {VARIATION_SQL},
p AS (SELECT barrio, sum(amortizacion) AS a FROM v WHERE saldo_final > 0 AND CAST(ejercicio AS INTEGER) < 1996 AND barrio IS NOT NULL GROUP BY 1),
w AS (SELECT v.* FROM v JOIN p USING (barrio) WHERE v.ejercicio = '1996' AND v.saldo_final > 0 AND -p.a < 0.01),
t AS (SELECT (SELECT count(*) FROM v WHERE ejercicio = '1996') AS n, (SELECT count(*) FROM w) AS k)
SELECT 'Barrios sin amortizaciones' AS concepto, CAST(k AS DOUBLE) AS importe FROM t
UNION ALL SELECT 'Barrios con amortizaciones', CAST(n - k AS DOUBLE) FROM t""")
def d_rc14(spark, d):
    return fin(receivables.with_without_amortisation(_variation(spark, d), "1996"))


# ---------------------------------------------------------------- works and bank

@query("d_iv1", """
WITH a AS (SELECT ejercicio, actividad || '-' || partida AS estructura, fuente, sum(importe) AS o FROM works
           WHERE ejercicio IS NOT NULL AND actividad IS NOT NULL AND partida IS NOT NULL AND fuente IS NOT NULL GROUP BY ALL),
b AS (SELECT ejercicio, actividad || '-' || partida AS estructura, fuente, sum(importe) AS i FROM works
      WHERE CAST(obra AS BIGINT) % 10 <> 0 AND ejercicio IS NOT NULL AND actividad IS NOT NULL AND partida IS NOT NULL AND fuente IS NOT NULL
        AND CASE WHEN CAST(obra AS BIGINT) % 4 = 1 THEN 'PA6' ELSE 'CYO' END <> 'PA6' GROUP BY ALL)
SELECT ejercicio, estructura, fuente, CAST(coalesce(o, 0) AS DOUBLE) AS ejecucion_siif, CAST(coalesce(i, 0) AS DOUBLE) AS ejecucion_icaro,
       CAST(coalesce(o, 0) - coalesce(i, 0) AS DOUBLE) AS diferencia
FROM a FULL JOIN b USING (ejercicio, estructura, fuente) WHERE abs(coalesce(o, 0) - coalesce(i, 0)) > 0.1""")
def d_iv1(spark, d):
    w = V(spark, d, "works")
    n = F.col("obra").cast("long")
    budget = w.select("ejercicio", F.concat_ws("-", "actividad", "partida").alias("estructura"), "fuente", F.col("importe").alias("ordenado"))
    loads = w.filter(n % 10 != 0).withColumn("tipo", F.when(n % 4 == 1, "PA6").otherwise("CYO"))
    return fin(controls.yearly_execution(budget, loads))


#: Ledger bank book and the official year-end balances of the same accounts.
BOOK_SQL = """
k AS (SELECT ejercicio, cta_cte, sum(importe) AS debitos, sum(retenciones) AS creditos, sum(importe - retenciones) AS saldo FROM (
        SELECT ejercicio, cta_cte, importe_bruto AS importe, retenciones FROM payments)
      WHERE ejercicio IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL),
f AS (SELECT ejercicio, cta_cte, sum(importe) AS saldo FROM bank WHERE ejercicio IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL),
cb4 AS (SELECT ejercicio, cta_cte, coalesce(debitos, 0) AS debitos, coalesce(creditos, 0) AS creditos, coalesce(k.saldo, 0) AS sldo_siif,
               coalesce(f.saldo, 0) AS sldo_banco, coalesce(k.saldo, 0) - coalesce(f.saldo, 0) AS dif_sldo
        FROM k FULL JOIN f USING (ejercicio, cta_cte))"""


def _ledger_vs_bank(spark, d):
    book = V(spark, d, "payments").select("ejercicio", "cta_cte", F.col("importe_bruto").alias("debitos"), F.col("retenciones").alias("creditos"),
                                          (F.col("importe_bruto") - F.col("retenciones")).alias("saldo"))
    final = V(spark, d, "bank").withColumnRenamed("importe", "saldo")
    return bank.ledger_vs_bank_final(bank.ledger_bank_summary(book, ["ejercicio", "cta_cte"]), final)


@query("d_cb4", f"""
WITH {BOOK_SQL}
SELECT ejercicio, cta_cte, CAST(debitos AS DOUBLE) AS debitos, CAST(creditos AS DOUBLE) AS creditos, CAST(sldo_siif AS DOUBLE) AS sldo_siif,
       CAST(sldo_banco AS DOUBLE) AS sldo_banco, CAST(dif_sldo AS DOUBLE) AS dif_sldo FROM cb4""")
def d_cb4(spark, d):
    return fin(_ledger_vs_bank(spark, d))


@query("d_cb5", f"""
WITH {BOOK_SQL},
y AS (SELECT ejercicio, sum(sldo_siif) AS s, sum(sldo_banco) AS b, sum(dif_sldo) AS dif FROM cb4 GROUP BY 1),
c1 AS (SELECT ejercicio, -sum(importe) AS x FROM loads WHERE tipo = 'REG' AND ejercicio IS NOT NULL GROUP BY 1),
c2 AS (SELECT ejercicio, sum(importe) AS x FROM bank WHERE movimiento = 'DEBITO' AND ejercicio IS NOT NULL GROUP BY 1),
j AS (SELECT y.*, c1.x AS recursos_dif, c2.x AS debitos_banca_dif FROM y LEFT JOIN c1 USING (ejercicio) LEFT JOIN c2 USING (ejercicio)),
l AS (SELECT ejercicio, unnest(['sldo_siif', 'sldo_banco', 'dif_sldo', 'recursos_dif', 'debitos_banca_dif', 'dif_sldo_ajustado']) AS concepto,
             unnest([CAST(s AS DECIMAL(38,2)), CAST(b AS DECIMAL(38,2)), CAST(dif AS DECIMAL(38,2)), CAST(recursos_dif AS DECIMAL(38,2)),
                     CAST(debitos_banca_dif AS DECIMAL(38,2)), CAST(dif + recursos_dif + debitos_banca_dif AS DECIMAL(38,2))]) AS importe FROM j)
SELECT ejercicio, concepto, CAST(importe AS DOUBLE) AS importe FROM l""")
def d_cb5(spark, d):
    own = V(spark, d, "loads").filter(F.col("tipo") == "REG")
    debits = V(spark, d, "bank").filter(F.col("movimiento") == "DEBITO")
    return fin(bank.gap_explained(_ledger_vs_bank(spark, d), {"recursos_dif": (own, "importe", -1), "debitos_banca_dif": (debits, "importe", 1)}))


# ---------------------------------------------------------------- withholdings of works payments

#: General ledger: each order is an entry; its lines are contractor payments, withholdings and the bank's side.
LEDGER_SQL = """
gl AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS ejercicio, strftime(o_orderdate, '%m/%Y') AS mes, CAST(l_orderkey % 5000 AS VARCHAR) AS nro_entrada,
              CASE l_linenumber % 3 WHEN 1 THEN '2111-1-2' WHEN 2 THEN '2122-1-2' ELSE '1112-2-6' END AS cta_contable,
              CASE l_orderkey % 4 WHEN 0 THEN 'CAP' WHEN 1 THEN 'ANP' WHEN 2 THEN 'CAD' ELSE 'REV' END AS tipo_comprobante,
              CASE l_linenumber % 3 WHEN 1 THEN CAST(o_custkey AS VARCHAR)
                   WHEN 2 THEN CASE l_partkey % 7 WHEN 0 THEN '110' WHEN 1 THEN '111' WHEN 2 THEN '112' WHEN 3 THEN '113' WHEN 4 THEN '114' WHEN 5 THEN '337' ELSE '999' END
                   ELSE c_mktsegment END AS auxiliar_1,
              CAST(l_extendedprice AS DECIMAL(18,2)) AS debitos
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
be AS (SELECT ejercicio, nro_entrada, min(auxiliar_1) AS cta_cte FROM gl WHERE cta_contable = '1112-2-6' GROUP BY ALL),
rt4 AS (SELECT gl.ejercicio, mes, gl.nro_entrada, tipo_comprobante, debitos AS importe_neto, auxiliar_1 AS cuit, cta_cte
        FROM gl LEFT JOIN be ON be.ejercicio = gl.ejercicio AND be.nro_entrada = gl.nro_entrada
        WHERE cta_contable = '2111-1-2' AND tipo_comprobante IN ('CAP', 'ANP', 'CAD')),
rt5 AS (SELECT gl.ejercicio, mes, gl.nro_entrada, tipo_comprobante, debitos AS importe, cta_cte,
               CASE auxiliar_1 WHEN '110' THEN 'iibb' WHEN '111' THEN 'sellos' WHEN '112' THEN 'lp' WHEN '113' THEN 'gcias' WHEN '114' THEN 'suss' ELSE 'propia' END AS cod_ret
        FROM gl LEFT JOIN be ON be.ejercicio = gl.ejercicio AND be.nro_entrada = gl.nro_entrada
        WHERE cta_contable = '2122-1-2' AND tipo_comprobante IN ('CAP', 'ANP', 'CAD') AND auxiliar_1 <> '999'),
n6 AS (SELECT ejercicio, mes, cta_cte, sum(importe_neto) AS importe_neto FROM rt4 WHERE cta_cte IS NOT NULL GROUP BY ALL),
r6 AS (SELECT ejercicio, mes, cta_cte, sum(CASE WHEN cod_ret = 'iibb' THEN importe ELSE 0 END) AS iibb, sum(CASE WHEN cod_ret = 'sellos' THEN importe ELSE 0 END) AS sellos,
              sum(CASE WHEN cod_ret = 'lp' THEN importe ELSE 0 END) AS lp, sum(CASE WHEN cod_ret = 'gcias' THEN importe ELSE 0 END) AS gcias,
              sum(CASE WHEN cod_ret = 'suss' THEN importe ELSE 0 END) AS suss, sum(CASE WHEN cod_ret = 'propia' THEN importe ELSE 0 END) AS propia, sum(importe) AS retenciones
       FROM rt5 WHERE cta_cte IS NOT NULL GROUP BY ALL),
rt6 AS (SELECT ejercicio, mes, cta_cte, coalesce(importe_neto, 0) AS importe_neto, coalesce(iibb, 0) AS iibb, coalesce(sellos, 0) AS sellos, coalesce(lp, 0) AS lp,
               coalesce(gcias, 0) AS gcias, coalesce(suss, 0) AS suss, coalesce(propia, 0) AS propia, coalesce(retenciones, 0) AS retenciones,
               coalesce(importe_neto, 0) + coalesce(retenciones, 0) AS importe_bruto FROM n6 FULL JOIN r6 USING (ejercicio, mes, cta_cte))"""

#: Bank movements of works: two codes of works investment and the transfers of withholdings, named by their text.
WORKS_BANK_SQL = """
wb AS (SELECT ejercicio, mes, cta_cte, importe, CASE cod_imputacion WHEN 'view' THEN '{works}' WHEN 'click' THEN '034' ELSE cod_imputacion END AS cod,
              CASE CAST(libramiento AS BIGINT) % 6 WHEN 0 THEN 'RET IIBB' WHEN 1 THEN 'SELLOS Y GCIAS' WHEN 2 THEN 'DEP GCI' WHEN 3 THEN 'SUSS' WHEN 4 THEN 'INV 3' END AS txt FROM bank),
rt8 AS (SELECT ejercicio, mes, cta_cte, sum(CASE WHEN cod = '034' THEN -importe ELSE 0 END) AS retenciones,
               sum(CASE WHEN cod = '034' AND contains(txt, 'IIBB') THEN -importe ELSE 0 END) AS iibb, sum(CASE WHEN cod = '034' AND contains(txt, 'SELLOS') THEN -importe ELSE 0 END) AS sellos,
               sum(CASE WHEN cod = '034' AND contains(txt, 'GCI') THEN -importe ELSE 0 END) AS gcias, sum(CASE WHEN cod = '034' AND contains(txt, 'SUSS') THEN -importe ELSE 0 END) AS suss,
               sum(CASE WHEN cod = '034' AND contains(txt, 'INV') THEN -importe ELSE 0 END) AS propia, sum(CASE WHEN cod <> '034' THEN -importe ELSE 0 END) AS importe_neto,
               sum(-importe) AS importe_bruto
        FROM wb WHERE cod IN ('{works}', '034') AND ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL)""".replace(
    "{works}", K.CASH_FLOW_WORKS[0])
NAMES = ["iibb", "sellos", "gcias", "suss", "propia", "retenciones", "importe_neto", "importe_bruto"]


def _doubles(columns, table="") -> str:
    return ", ".join(f"CAST({table}{c} AS DOUBLE) AS {c}" for c in columns)


def _ledger(spark, d):
    n = F.col("l_linenumber") % 3
    codes = ["110", "111", "112", "113", "114", "337", "999"]
    ret = F.element_at(F.array(*map(F.lit, codes)), (F.col("l_partkey") % 7 + 1).cast("int"))
    kinds = F.element_at(F.array(*map(F.lit, ["CAP", "ANP", "CAD", "REV"])), (F.col("l_orderkey") % 4 + 1).cast("int"))
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    li = table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return li.select(
        year_of("o_orderdate").alias("ejercicio"), month_of("o_orderdate").alias("mes"), (F.col("l_orderkey") % 5000).cast("string").alias("nro_entrada"),
        F.when(n == 1, withholdings.LEDGER_CONTRACTORS_ACCOUNT).when(n == 2, withholdings.LEDGER_WITHHOLDINGS_ACCOUNT).otherwise(withholdings.LEDGER_BANK_ACCOUNT).alias("cta_contable"),
        kinds.alias("tipo_comprobante"), F.when(n == 1, F.col("o_custkey").cast("string")).when(n == 2, ret).otherwise(F.col("c_mktsegment")).alias("auxiliar_1"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("debitos"))


def _ledger_summary(spark, d):
    gl = _ledger(spark, d)
    return withholdings.ledger_summary(withholdings.contractor_payments(gl), withholdings.withholding_payments(gl))


def _works_bank(spark, d):
    text = F.element_at(F.array(*map(F.lit, ["RET IIBB", "SELLOS Y GCIAS", "DEP GCI", "SUSS", "INV 3", None])), (F.col("libramiento").cast("long") % 6 + 1).cast("int"))
    code = F.when(F.col("cod_imputacion") == "view", K.CASH_FLOW_WORKS[0]).when(F.col("cod_imputacion") == "click", "034").otherwise(F.col("cod_imputacion"))
    return V(spark, d, "bank").withColumns({"cod_imputacion": code, "concepto": text})


@query("d_rt4", f"WITH {LEDGER_SQL} SELECT * REPLACE (CAST(importe_neto AS DOUBLE) AS importe_neto) FROM rt4")
def d_rt4(spark, d):
    return fin(withholdings.contractor_payments(_ledger(spark, d)))


@query("d_rt5", f"WITH {LEDGER_SQL} SELECT * REPLACE (CAST(importe AS DOUBLE) AS importe) FROM rt5")
def d_rt5(spark, d):
    return fin(withholdings.withholding_payments(_ledger(spark, d)))


@query("d_rt6", f"WITH {LEDGER_SQL} SELECT ejercicio, mes, cta_cte, {_doubles([*NAMES, 'lp'])} FROM rt6")
def d_rt6(spark, d):
    return fin(_ledger_summary(spark, d))


@query("d_rt7", """
SELECT ejercicio, mes, cta_cte, CAST(sum(importe_bruto) AS DOUBLE) AS importe_bruto, CAST(sum(importe_neto) AS DOUBLE) AS importe_neto,
       CAST(sum(retenciones) AS DOUBLE) AS retenciones
FROM payments WHERE ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL""")
def d_rt7(spark, d):
    return fin(withholdings.renditions_summary(V(spark, d, "payments")))


@query("d_rt8", f"WITH {WORKS_BANK_SQL} SELECT ejercicio, mes, cta_cte, {_doubles(NAMES)} FROM rt8")
def d_rt8(spark, d):
    return fin(withholdings.bank_summary(_works_bank(spark, d)))


@query("d_rt12", f"""
WITH {LEDGER_SQL}, {WORKS_BANK_SQL.strip()},
a AS (SELECT ejercicio, mes, cta_cte, importe_neto, iibb, sellos + lp AS sellos, gcias, suss, propia, retenciones, importe_bruto FROM rt6)
SELECT ejercicio, mes, cta_cte, {", ".join(f"CAST(coalesce(a.{c}, 0) - coalesce(rt8.{c}, 0) AS DOUBLE) AS {c}" for c in NAMES)}
FROM a FULL JOIN rt8 USING (ejercicio, mes, cta_cte)""")
def d_rt12(spark, d):
    # lp is folded into the seals, as the bank has no text for it
    return fin(withholdings.compare(_ledger_summary(spark, d), withholdings.bank_summary(_works_bank(spark, d)), how="union", fold_lp=True))
