"""Registered controls that explain the gap between ledger and bank (D-DB1, D-CH4, D-CE3, S-20) and the whole report (D-CB5).

The oracles are written from the report's definition, not from the code beside them.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import codes as K
from ..functions.scalars import month_of, year_of
from ..session import materialize, together
from ..sources.views import MONEY, table
from . import bank, controls, fees
from .domain_queries import LAST_SNAP_SQL, NET3_SQL, NET_SQL
from .generic_queries import FIRST_SNAP_SQL
from .registry import V, fin, query
from .report_queries import BOOK_SQL

KEYS3 = ["ejercicio", "mes", "cta_cte"]

# ---------------------------------------------------------------- bank debits (D-DB1)

#: Vouchers of the bank-debits line and others, with flags that the control counts; bank movements of the debits' code.
DEBITS_SQL = """
dv AS (SELECT ejercicio, mes, cta_cte, importe_bruto AS importe, codigo = 'A' AS es_355, CAST(nro_comprobante AS BIGINT) % 2 = 0 AS es_pagado,
              CASE WHEN CAST(nro_comprobante AS BIGINT) % 3 > 0 THEN CAST(nro_comprobante AS BIGINT) % 5 = 0 END AS es_aprobado FROM payments),
d1 AS (SELECT ejercicio, mes, cta_cte, sum(importe) AS e, sum(CAST(es_pagado AS INTEGER)) AS p, coalesce(sum(CAST(es_aprobado AS INTEGER)), 0) AS a FROM dv
       WHERE es_355 AND ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL),
d2 AS (SELECT ejercicio, mes, cta_cte, sum(-importe) AS b FROM bank
       WHERE cod_imputacion = 'error' AND ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL),
db1 AS (SELECT ejercicio, mes, cta_cte, coalesce(e, 0) AS ejecutado_siif, coalesce(p, 0) AS es_pagado, coalesce(a, 0) AS es_aprobado, coalesce(b, 0) AS debitos_sscc,
               coalesce(e, 0) - coalesce(b, 0) AS diferencia FROM d1 FULL JOIN d2 USING (ejercicio, mes, cta_cte))"""


def debit_vouchers(payments: DataFrame) -> DataFrame:
    n = F.col("nro_comprobante").cast("long")
    return payments.select("ejercicio", "mes", "cta_cte", F.col("importe_bruto").alias("importe"), F.when(F.col("codigo") == "A", fees.BANK_DEBITS_LINE).otherwise("421").alias("partida"),
                           (n % 2 == 0).alias("es_pagado"), F.when(n % 3 > 0, n % 5 == 0).alias("es_aprobado"))


def debit_movements(movements: DataFrame) -> DataFrame:
    code = F.when(F.col("cod_imputacion") == "error", fees.BANK_DEBITS_CODE).otherwise(F.col("cod_imputacion"))
    return movements.withColumn("cod_imputacion", code)


@query("d_db1", f"""
WITH {DEBITS_SQL}
SELECT ejercicio, mes, cta_cte, CAST(ejecutado_siif AS DOUBLE) AS ejecutado_siif, CAST(es_pagado AS BIGINT) AS es_pagado, CAST(es_aprobado AS BIGINT) AS es_aprobado,
       CAST(debitos_sscc AS DOUBLE) AS debitos_sscc, CAST(diferencia AS DOUBLE) AS diferencia FROM db1""")
def d_db1(spark, d):
    return fin(fees.debits_control(debit_vouchers(V(spark, d, "payments")), debit_movements(V(spark, d, "bank"))))


# ---------------------------------------------------------------- fees against renditions (D-CH4)

#: Fees of two codes with their withholdings; renditions of two codes without insurance, some equal to the fees.
FEES_SQL = """
fe AS (SELECT ejercicio, mes, cta_cte, beneficiario, importe_bruto, retenciones AS iibb, CASE WHEN codigo = 'A' THEN retenciones END AS sellos, importe_neto / 2 AS lp,
              CAST(nro_comprobante AS BIGINT) % 10 AS seguro, CASE WHEN CAST(nro_comprobante AS BIGINT) % 2 = 0 THEN 3 END AS anticipo, 1 AS mutual
       FROM payments WHERE codigo <> 'R'),
h AS (SELECT ejercicio, mes, cta_cte, beneficiario, sum(importe_bruto) AS importe_bruto, sum(iibb) AS iibb, sum(coalesce(sellos, 0) + lp) AS sellos, sum(seguro) AS seguro,
             sum(coalesce(anticipo, 0) + mutual) AS otras FROM fe
      WHERE ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL AND beneficiario IS NOT NULL GROUP BY ALL),
rr AS (SELECT ejercicio, mes, cta_cte, beneficiario, sum(importe_bruto) AS importe_bruto, sum(retenciones) AS iibb, sum(importe_neto) AS sellos,
              sum(2 + coalesce(CASE WHEN CAST(cuit AS BIGINT) % 2 = 0 THEN 5 END, 0)) AS otras FROM payments
       WHERE codigo <> 'N' AND ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL AND beneficiario IS NOT NULL GROUP BY ALL),
ch4 AS (SELECT ejercicio, mes, cta_cte, beneficiario, coalesce(h.importe_bruto, 0) - coalesce(rr.importe_bruto, 0) AS importe_bruto, coalesce(h.iibb, 0) - coalesce(rr.iibb, 0) AS iibb,
               coalesce(h.sellos, 0) - coalesce(rr.sellos, 0) AS sellos, coalesce(h.otras, 0) - coalesce(rr.otras, 0) AS otras FROM h FULL JOIN rr USING (ejercicio, mes, cta_cte, beneficiario)),
ch4d AS (SELECT * FROM ch4 WHERE abs(importe_bruto + iibb + sellos + otras) > 1e-8)"""
FEE_KEYS = [*KEYS3, "beneficiario"]


def fee_difference(payments: DataFrame) -> DataFrame:
    n = F.col("nro_comprobante").cast("long")
    own = payments.filter(F.col("codigo") != "R").select(
        *FEE_KEYS, "importe_bruto", F.col("retenciones").alias("iibb"), F.when(F.col("codigo") == "A", F.col("retenciones")).alias("sellos"), (F.col("importe_neto") / 2).alias("lp"),
        (n % 10).alias("seguro"), F.when(n % 2 == 0, 3).alias("anticipo"), F.lit(1).alias("mutual"))
    paid = payments.filter(F.col("codigo") != "N").select(
        *FEE_KEYS, "importe_bruto", F.col("retenciones").alias("iibb"), F.col("importe_neto").alias("sellos"), F.lit(2).alias("otras"),
        F.when(F.col("cuit").cast("long") % 2 == 0, 5).alias("gcias"))
    return fees.fees_vs_renditions(fees.fees_summary(own, FEE_KEYS), fees.fee_renditions_summary(paid, FEE_KEYS), FEE_KEYS, only_diff=True)


@query("d_ch4", f"""
WITH {FEES_SQL}
SELECT ejercicio, mes, cta_cte, beneficiario, CAST(importe_bruto AS DOUBLE) AS importe_bruto, CAST(iibb AS DOUBLE) AS iibb, CAST(sellos AS DOUBLE) AS sellos,
       CAST(NULL AS BIGINT) AS seguro, CAST(otras AS BIGINT) AS otras FROM ch4d""")
def d_ch4(spark, d):
    return fin(fee_difference(V(spark, d, "payments")).select(*FEE_KEYS, "importe_bruto", "iibb", "sellos", F.col("seguro").cast("long").alias("seguro"), F.col("otras").cast("long").alias("otras")))


# ---------------------------------------------------------------- notaries (D-CE3)

#: Notary account of the ledger (opening entries among others) and renditions of the notary bank account and others.
NOTARY_SQL = """
nl AS (SELECT CAST(year(l_shipdate) AS VARCHAR) AS ejercicio, strftime(l_shipdate, '%m/%Y') AS mes, CAST(l_suppkey AS VARCHAR) AS cuit,
              CAST(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END AS DECIMAL(18,2)) AS c, CAST(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice ELSE 0 END AS DECIMAL(18,2)) AS p
       FROM lineitem WHERE l_suppkey % 7 < 2 AND l_linestatus = 'F' AND l_partkey % 8 <> 6),
n1 AS (SELECT ejercicio, mes, cuit, sum(c) AS c, sum(p) AS p FROM nl GROUP BY ALL),
n2 AS (SELECT CAST(year(l_shipdate) AS VARCHAR) AS ejercicio, strftime(l_shipdate, '%m/%Y') AS mes, CAST(l_suppkey AS VARCHAR) AS cuit, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s
       FROM lineitem WHERE l_suppkey % 7 < 3 AND l_suppkey % 7 > 0 AND l_linestatus = 'O' AND l_linenumber < 4 GROUP BY ALL),
ce3 AS (SELECT ejercicio, mes, cuit, coalesce(c, 0) AS carga_fei, coalesce(p, 0) AS pagos_fei, coalesce(c - p, 0) AS fei_impagos, coalesce(s, 0) AS pagos_sgf,
               coalesce(p, 0) - coalesce(s, 0) AS dif_pagos FROM n1 FULL JOIN n2 USING (ejercicio, mes, cuit))"""


def notary_difference(lines: DataFrame) -> DataFrame:
    k, price = F.col("l_suppkey") % 7, F.col("l_extendedprice").cast(MONEY)
    when = [year_of("l_shipdate").alias("ejercicio"), month_of("l_shipdate").alias("mes")]
    side = lambda cond: F.when(cond, price).otherwise(F.lit(0).cast(MONEY))
    ledger = lines.filter(F.col("l_linestatus") == "F").select(
        *when, F.when(k < 2, fees.NOTARY_LEDGER_ACCOUNT).otherwise("1112-2-6").alias("cta_contable"), F.when(F.col("l_partkey") % 8 == 6, "APE").alias("tipo_comprobante"),
        F.col("l_suppkey").cast("string").alias("auxiliar_1"), side(F.col("l_returnflag") == "R").alias("creditos"), side(F.col("l_returnflag") != "R").alias("debitos"))
    paid = lines.filter((F.col("l_linestatus") == "O") & (F.col("l_linenumber") < 4)).select(
        *when, F.when((k > 0) & (k < 3), K.NOTARY_ACCOUNT).when(k == 3, K.FEES_ACCOUNT).alias("cta_cte"), F.col("l_suppkey").cast("string").alias("cuit"), price.alias("importe_neto"))
    keys = ["ejercicio", "mes", "cuit"]
    return fees.notary_ledger_vs_renditions(fees.notary_ledger_summary(fees.notary_ledger(ledger), keys), fees.notary_renditions_summary(paid, keys), keys)


@query("d_ce3", f"""
WITH {NOTARY_SQL}
SELECT ejercicio, mes, cuit, CAST(carga_fei AS DOUBLE) AS carga_fei, CAST(pagos_fei AS DOUBLE) AS pagos_fei, CAST(fei_impagos AS DOUBLE) AS fei_impagos,
       CAST(pagos_sgf AS DOUBLE) AS pagos_sgf, CAST(dif_pagos AS DOUBLE) AS dif_pagos FROM ce3""")
def d_ce3(spark, d):
    return fin(notary_difference(table(spark, d, "lineitem")))


# ---------------------------------------------------------------- the gap and its seven controls (D-CB5)

def gap_inputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The sources of the report, each written once in the columns that the controls need; all controls read from there."""
    columns = {"loads": ["id", "nro_comprobante", "ejercicio", "mes", "fecha", "cta_cte", "tipo", "fuente", "cuit", "importe"],
               "snapshots": ["nro_comprobante", "ejercicio", "mes", "fecha_hasta", "cuit", "saldo"],
               "payments": ["nro_comprobante", "ejercicio", "mes", "cta_cte", "cuit", "beneficiario", "codigo", "importe_bruto", "importe_neto", "retenciones"],
               "bank": ["ejercicio", "mes", "cta_cte", "cod_imputacion", "movimiento", "importe"]}
    written = together(spark, [partial(materialize, V(spark, d, name).select(*own), name) for name, own in columns.items()])
    return dict(zip(columns, written)) | {
        "lines": table(spark, d, "lineitem"), "advances": table(spark, d, "orders").filter("o_orderkey % 3 = 0 AND year(o_orderdate) != 1998").select(
            year_of("o_orderdate").alias("ejercicio"), F.col("o_totalprice").cast(MONEY).alias("egresos"))}


def whole_gap(s: dict[str, DataFrame]) -> DataFrame:
    """The ledger-bank gap with all seven controls."""
    book = s["payments"].select("ejercicio", "cta_cte", F.col("importe_bruto").alias("debitos"), F.col("retenciones").alias("creditos"),
                                (F.col("importe_bruto") - F.col("retenciones")).alias("saldo"))
    ledger_bank = bank.ledger_vs_bank_final(bank.ledger_bank_summary(book, ["ejercicio", "cta_cte"]), s["bank"].withColumnRenamed("importe", "saldo"))
    revenue = s["loads"].withColumns({"es_propio": F.col("tipo") == "PA6", "es_remanente": F.col("tipo") == "REG"})
    payroll = s["loads"].filter(F.col("tipo") == "CYO").select("ejercicio", "nro_comprobante", "mes", "cta_cte", "importe")
    # both nettings start from one aggregation of the snapshots; a snapshot's year follows from its date, so it decides no order
    monthly = op.monthly_snapshots(s["snapshots"], cols=["cuit", "ejercicio"])
    net = op.net_pending(s["loads"], s["snapshots"], snap_cols=["cuit"], load_cols=["cta_cte", "fuente"], require=None, monthly=monthly)
    net_payroll = op.net_pending_semi(payroll, s["snapshots"], ["1998", "1999"], monthly=monthly)
    return bank.ledger_bank_gap(
        ledger_bank,
        revenue_ctrl=controls.revenue_vs_deposits(revenue, controls.revenue_deposits(s["bank"])),
        works_ctrl=controls.works_vs_paid(net, s["payments"]),
        payroll_ctrl=controls.payroll_vs_paid(net_payroll, s["payments"].withColumnRenamed("importe_neto", "importe")),
        debits_ctrl=fees.debits_control(debit_vouchers(s["payments"]), debit_movements(s["bank"])),
        advances=s["advances"], fees_ctrl=fee_difference(s["payments"]), notary_ctrl=notary_difference(s["lines"]))


#: The payroll netting beside the works netting: the snapshots' CTEs are there once, the rest under names of its own.
PAYROLL_NET_SQL = NET3_SQL.replace(f"{FIRST_SNAP_SQL},\n{LAST_SNAP_SQL},\n", "").replace("pos AS", "pos3 AS").replace("FROM pos)", "FROM pos3)").strip()
PARTS = ["recursos_dif", "obras_dif", "haberes_dif", "debitos_banca_dif", "pa6_reg", "honorarios_dif", "escribanos_dif"]


@query("d_cb5_completo", f"""
WITH {NET_SQL}, {PAYROLL_NET_SQL}, {BOOK_SQL.strip()}, {DEBITS_SQL.strip()}, {FEES_SQL.strip()}, {NOTARY_SQL.strip()},
y AS (SELECT ejercicio, sum(sldo_siif) AS s, sum(sldo_banco) AS b, sum(dif_sldo) AS dif FROM cb4 GROUP BY 1),
re AS (SELECT ejercicio, -sum(x) AS v FROM (
         SELECT ejercicio, importe AS x FROM loads WHERE tipo <> 'PA6' AND tipo <> 'REG' AND mes IS NOT NULL AND cta_cte IS NOT NULL
         UNION ALL SELECT ejercicio, -importe FROM bank WHERE movimiento = 'DEPOSITO' AND mes IS NOT NULL AND cta_cte IS NOT NULL) WHERE ejercicio IS NOT NULL GROUP BY 1),
ob AS (SELECT ejercicio, sum(x) AS v FROM (
         SELECT ejercicio, importe AS x FROM net WHERE mes IS NOT NULL AND cta_cte IS NOT NULL
         UNION ALL SELECT ejercicio, -importe_bruto FROM payments WHERE mes IS NOT NULL AND cta_cte IS NOT NULL) WHERE ejercicio IS NOT NULL GROUP BY 1),
ha AS (SELECT ejercicio, sum(x) AS v FROM (
         SELECT ejercicio, importe AS x FROM net3 WHERE mes IS NOT NULL UNION ALL SELECT ejercicio, -importe_neto FROM payments WHERE mes IS NOT NULL)
       WHERE ejercicio IS NOT NULL GROUP BY 1),
de AS (SELECT ejercicio, sum(diferencia) AS v FROM db1 GROUP BY 1),
pa AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS ejercicio, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders WHERE o_orderkey % 3 = 0 AND year(o_orderdate) <> 1998 GROUP BY 1),
ho AS (SELECT ejercicio, sum(importe_bruto) AS v FROM ch4d GROUP BY 1),
es AS (SELECT ejercicio, sum(dif_pagos) AS v FROM ce3 GROUP BY 1),
t AS (SELECT y.*, re.v AS v1, ob.v AS v2, ha.v AS v3, de.v AS v4, pa.v AS v5, ho.v AS v6, es.v AS v7 FROM y LEFT JOIN re USING (ejercicio) LEFT JOIN ob USING (ejercicio)
      LEFT JOIN ha USING (ejercicio) LEFT JOIN de USING (ejercicio) LEFT JOIN pa USING (ejercicio) LEFT JOIN ho USING (ejercicio) LEFT JOIN es USING (ejercicio)),
l AS (SELECT ejercicio, unnest(['sldo_siif', 'sldo_banco', 'dif_sldo', {", ".join(f"'{p}'" for p in PARTS)}, 'dif_sldo_ajustado']) AS concepto,
             unnest([CAST(x AS DECIMAL(38,2)) FOR x IN [CAST(s AS DECIMAL(38,4)), b, dif, v1, v2, v3, v4, v5, v6, v7, dif + v1 + v2 + v3 + v4 + v5 + v6 + v7]]) AS importe FROM t)
SELECT ejercicio, concepto, CAST(importe AS DOUBLE) AS importe FROM l""")
def d_cb5_completo(spark, d):
    return fin(whole_gap(gap_inputs(spark, d)))
