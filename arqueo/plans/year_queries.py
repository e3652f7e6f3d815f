"""Registered reports over several years: works crosswalk (D-CO3), remainder (D-RM2..D-RM5), cleaned renditions (D-SRC1),
the works ledger on cash basis (D-EO7), and sources written, pruned and bucketed (S-10, S-14, S-25, K-01).

The oracles are written from the report's definition, not from the code beside them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions.scalars import month_of, year_of
from ..session import checkpoint_root, materialize
from ..sources import io, systems
from ..sources.views import MONEY, table
from . import controls, remainder, sources_clean, works
from .domain_queries import LAST_SNAP_SQL
from .generic_queries import FIRST_SNAP_SQL
from .ledger_queries import DEBT_SQL, MAJOR_SQL, _debt, _lines, _major, _pick
from .registry import V, fin, query

# ---------------------------------------------------------------- works and their register (D-CO3)

#: Names with a leading code, equal in their first 85 characters, starting with digits, blank-padded, missing; repeated ones.
CROSS_SQL = """
wl AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 5 = 0 THEN '29-00' ELSE p_brand END AS actividad, CASE WHEN p_partkey % 7 > 0 THEN '421' END AS partida,
              CASE p_partkey % 6 WHEN 0 THEN '12-34 ' || p_name || p_size WHEN 1 THEN repeat('obra larga ', 9) || p_partkey WHEN 2 THEN '123 plan ' || p_size
                                 WHEN 3 THEN '  ' || p_name || ' ' WHEN 4 THEN NULL ELSE p_name || p_size END AS obra FROM part),
rg AS (SELECT 'C' || p_partkey AS cod_obra, CASE p_partkey % 4 WHEN 0 THEN p_name || p_size || '  ' WHEN 1 THEN repeat('obra larga ', 9) || 'z' || p_partkey
                                                               WHEN 2 THEN 'solo ' || p_partkey ELSE p_name END AS obra FROM part WHERE p_partkey % 3 = 0),
w AS (SELECT k, trim(substr(ltrim(regexp_replace(obra, '^\\d+-\\d+', '')), 1, 85)) AS obra, actividad || '-' || partida AS imputacion FROM wl),
r AS (SELECT cod_obra, trim(substr(obra, 1, 85)) AS obra FROM rg)"""


def _works_list(spark, d):
    k, name = F.col("p_partkey"), F.concat("p_name", F.col("p_size").cast("string"))
    long = F.concat(F.repeat(F.lit("obra larga "), 9), k.cast("string"))
    obra = F.when(k % 6 == 0, F.concat(F.lit("12-34 "), name)).when(k % 6 == 1, long).when(k % 6 == 2, F.concat(F.lit("123 plan "), F.col("p_size").cast("string"))) \
        .when(k % 6 == 3, F.concat(F.lit("  "), "p_name", F.lit(" "))).when(k % 6 == 5, name)
    return table(spark, d, "part").select(k.alias("k"), obra.alias("obra"), F.when(k % 5 == 0, "29-00").otherwise(F.col("p_brand")).alias("actividad"),
                                          F.when(k % 7 > 0, "421").alias("partida"))


def _register(spark, d):
    k = F.col("p_partkey")
    obra = F.when(k % 4 == 0, F.concat("p_name", F.col("p_size").cast("string"), F.lit("  "))).when(k % 4 == 1, F.concat(F.repeat(F.lit("obra larga "), 9), F.lit("z"), k.cast("string"))) \
        .when(k % 4 == 2, F.concat(F.lit("solo "), k.cast("string"))).otherwise(F.col("p_name"))
    return table(spark, d, "part").filter(k % 3 == 0).select(F.concat(F.lit("C"), k.cast("string")).alias("cod_obra"), obra.alias("obra"))


@query("d_co3", f"""
WITH {CROSS_SQL}, u AS (SELECT obra, min(cod_obra) AS cod_obra FROM r GROUP BY 1)
SELECT k, w.obra, imputacion, CASE WHEN starts_with(imputacion, '29-') AND regexp_full_match(substr(w.obra, 1, 3), '[0-9]{{1,3}}') THEN substr(w.obra, 1, 3) ELSE cod_obra END AS cod_obra
FROM w LEFT JOIN u ON u.obra = w.obra""")
def d_co3(spark, d):
    return controls.works_crosswalk(_works_list(spark, d), _register(spark, d))[0].select("k", "obra", "imputacion", "cod_obra")


@query("d_co3_inverso", f"""
WITH {CROSS_SQL}, u AS (SELECT obra, min(imputacion) AS imputacion FROM w GROUP BY 1)
SELECT cod_obra, r.obra, imputacion FROM r LEFT JOIN u ON u.obra = r.obra""")
def d_co3_inverso(spark, d):
    return controls.works_crosswalk(_works_list(spark, d), _register(spark, d))[1].select("cod_obra", "obra", "imputacion")


# ---------------------------------------------------------------- remainder (D-RM2..D-RM5)

#: Revenue with remainder flags (some unknown) and a year missing in fund 12; budget with a year missing in fund 13 and a
#: fund without revenue; final balances of two fixed accounts, others and NULL; debt of the last month of a year.
REMAINDER_SQL = f"""
rv AS (SELECT * FROM (SELECT CAST(year(o_orderdate) AS VARCHAR) AS ejercicio, ['10', '11', '12', '13', NULL][CAST(o_custkey % 5 + 1 AS INTEGER)] AS fuente,
                             CAST(o_totalprice AS DECIMAL(18,2)) AS importe, CASE WHEN o_orderkey % 11 > 0 THEN o_orderkey % 7 = 0 END AS es_remanente FROM orders)
       WHERE NOT (ejercicio = '1998' AND fuente IS NOT DISTINCT FROM '12')),
bu AS (SELECT * FROM (SELECT CAST(year(l_shipdate) AS VARCHAR) AS ejercicio, '1' || l_suppkey % 5 AS fuente, CAST(l_extendedprice AS DECIMAL(18,2)) AS ordenado,
                             CAST(l_quantity AS DECIMAL(18,2)) AS saldo FROM lineitem)
       WHERE NOT (ejercicio = '1997' AND fuente = '13')),
fb AS (SELECT CASE cta_cte WHEN 'AUTOMOBILE' THEN '130832-03' WHEN 'BUILDING' THEN '130832-16' ELSE cta_cte END AS cta_cte, importe AS saldo FROM bank WHERE ejercicio = '1998'),
{DEBT_SQL.strip()},
ds AS (SELECT * FROM rdeu WHERE ejercicio = '2014' AND strptime(mes_hasta, '%m/%Y') = (SELECT max(strptime(mes_hasta, '%m/%Y')) FROM rdeu WHERE ejercicio = '2014')),
m1 AS (SELECT 'Fuente 10 y 12' AS fuente, coalesce((SELECT sum(saldo) FROM fb WHERE cta_cte = '130832-03'), 0) AS saldo_bco, coalesce((SELECT sum(saldo) FROM ds WHERE fuente IN ('10', '12')), 0) AS rdeu
       UNION ALL SELECT 'Fuente 13', coalesce((SELECT sum(saldo) FROM fb WHERE cta_cte = '130832-16'), 0) + 4262062.77, coalesce((SELECT sum(saldo) FROM ds WHERE fuente = '13'), 0)
       UNION ALL SELECT 'Fuente 11', coalesce((SELECT sum(saldo) FROM fb WHERE cta_cte IS NULL OR cta_cte NOT IN ('130832-03', '130832-16')), 0) - 4262062.77, coalesce((SELECT sum(saldo) FROM ds WHERE fuente = '11'), 0)),
rec AS (SELECT ejercicio, fuente, sum(importe) AS recursos FROM rv WHERE fuente IS NOT NULL GROUP BY ALL),
gas AS (SELECT ejercicio, fuente, sum(ordenado) AS gastos, sum(saldo) AS saldo_pres FROM bu GROUP BY ALL),
m2 AS (SELECT ejercicio, fuente, recursos, gastos, saldo_pres, recursos - gastos AS rte_met_2 FROM rec FULL JOIN gas USING (ejercicio, fuente))"""


def _revenue(spark, d):
    k = F.col("o_orderkey")
    r = table(spark, d, "orders").select(year_of("o_orderdate").alias("ejercicio"), _pick(F.col("o_custkey") % 5, ["10", "11", "12", "13", None]).alias("fuente"),
                                         F.col("o_totalprice").cast(MONEY).alias("importe"), F.when(k % 11 > 0, k % 7 == 0).alias("es_remanente"))
    return r.filter(~((F.col("ejercicio") == "1998") & F.col("fuente").eqNullSafe("12")))


def _budget(spark, d):
    b = table(spark, d, "lineitem").select(year_of("l_shipdate").alias("ejercicio"), F.concat(F.lit("1"), (F.col("l_suppkey") % 5).cast("string")).alias("fuente"),
                                           F.col("l_extendedprice").cast(MONEY).alias("ordenado"), F.col("l_quantity").cast(MONEY).alias("saldo"))
    return b.filter(~((F.col("ejercicio") == "1997") & (F.col("fuente") == "13")))


def _method_1(spark, d):
    account = F.when(F.col("cta_cte") == "AUTOMOBILE", "130832-03").when(F.col("cta_cte") == "BUILDING", "130832-16").otherwise(F.col("cta_cte"))
    final = op.years(V(spark, d, "bank"), "1998").select(account.alias("cta_cte"), F.col("importe").alias("saldo"))
    return remainder.method_1(final, remainder.latest_debt(_debt(spark, d), "2014"))


@query("d_rm2", f"""
WITH {REMAINDER_SQL} SELECT fuente, CAST(saldo_bco AS DOUBLE) AS saldo_bco, CAST(rdeu AS DOUBLE) AS rdeu, CAST(saldo_bco - rdeu AS DOUBLE) AS rte_met_1 FROM m1""")
def d_rm2(spark, d):
    return fin(_method_1(spark, d).select("fuente", "saldo_bco", "rdeu", "rte_met_1"))


@query("d_rm3", f"""
WITH {REMAINDER_SQL}
SELECT fuente, CAST(recursos AS DOUBLE) AS recursos, CAST(gastos AS DOUBLE) AS gastos, CAST(saldo_pres AS DOUBLE) AS saldo_pres, CAST(rte_met_2 AS DOUBLE) AS rte_met_2
FROM m2 WHERE ejercicio = '1998'""")
def d_rm3(spark, d):
    return fin(remainder.method_2(op.years(_revenue(spark, d), "1998"), op.years(_budget(spark, d), "1998")))


@query("d_rm4", f"""
WITH {REMAINDER_SQL},
q AS (SELECT CAST(CAST(ejercicio AS INTEGER) - 1 AS VARCHAR) AS ejercicio, fuente, sum(importe) AS rte_solicitado FROM rv WHERE es_remanente AND fuente IS NOT NULL GROUP BY ALL)
SELECT ejercicio, fuente, CAST(recursos AS DOUBLE) AS recursos, CAST(gastos AS DOUBLE) AS gastos, CAST(saldo_pres AS DOUBLE) AS saldo_pres, CAST(rte_met_2 AS DOUBLE) AS rte_met_2,
       CAST(rte_solicitado AS DOUBLE) AS rte_solicitado, CAST(rte_solicitado - rte_met_2 AS DOUBLE) AS dif_rte_solicitado
FROM m2 JOIN q USING (ejercicio, fuente) WHERE fuente <> '11' AND recursos IS NOT NULL AND gastos IS NOT NULL""")
def d_rm4(spark, d):
    return fin(remainder.method_2_history(_revenue(spark, d), _budget(spark, d)))


@query("d_rm5", f"""
WITH {REMAINDER_SQL},
z AS (SELECT CASE WHEN fuente IN ('10', '12') THEN 'Fuente 10 y 12' ELSE 'Fuente ' || fuente END AS fuente, coalesce(sum(rte_met_2), 0) AS rte_met_2 FROM m2 WHERE ejercicio = '1998' GROUP BY 1)
SELECT fuente, CAST(saldo_bco - rdeu AS DOUBLE) AS rte_met_1, CAST(rte_met_2 AS DOUBLE) AS rte_met_2, CAST(saldo_bco - rdeu - rte_met_2 AS DOUBLE) AS dif_metodos
FROM m1 LEFT JOIN z USING (fuente)""")
def d_rm5(spark, d):
    m2 = remainder.method_2(op.years(_revenue(spark, d), "1998"), op.years(_budget(spark, d), "1998"))
    return fin(remainder.methods_compared(_method_1(spark, d), m2))


# ---------------------------------------------------------------- cleaned renditions (D-SRC1)

#: Renditions with repeats in every account (only two accounts are cleaned), accounts to map (one to NULL, one unknown); bank
#: deposits and debits of the certificates' code, cheques, others and unknown.
RENDITIONS_SQL = """
mp AS (SELECT 'S' || n_nationkey AS sgf, CASE n_nationkey WHEN 1 THEN '106' WHEN 2 THEN '2210178150' WHEN 3 THEN NULL ELSE '1308' || n_nationkey END AS map_to FROM nation),
rr AS (SELECT CAST(year(l_shipdate) AS VARCHAR) AS ejercicio, strftime(l_shipdate, '%m/%Y') AS mes, CAST(date_trunc('month', l_shipdate) AS DATE) AS fecha,
              CASE WHEN o_custkey % 6 = 5 THEN 'X' ELSE 'S' || o_custkey % 6 END AS sgf, 'b' || o_custkey % 20 AS beneficiario,
              CASE WHEN l_suppkey % 4 > 0 THEN CAST(l_suppkey % 4 AS VARCHAR) END AS libramiento_sgf, CAST(l_quantity AS DECIMAL(18,2)) AS importe_bruto,
              CAST(CAST(l_quantity AS DECIMAL(18,2)) / 2 AS DECIMAL(18,2)) AS importe_neto
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
rm AS (SELECT rr.* EXCLUDE (sgf), map_to AS cta_cte FROM rr LEFT JOIN mp USING (sgf)),
rc AS (SELECT ejercicio, mes, fecha, cta_cte, beneficiario, libramiento_sgf, importe_bruto, importe_neto FROM rm WHERE cta_cte IS NULL OR cta_cte NOT IN ('106', '2210178150')
       UNION ALL SELECT DISTINCT ejercicio, mes, fecha, cta_cte, beneficiario, libramiento_sgf, importe_bruto, importe_neto FROM rm WHERE cta_cte IN ('106', '2210178150'))"""
SRC1_COLS = ["ejercicio", "mes", "fecha", "cta_cte", "beneficiario", "libramiento_sgf", "importe_bruto", "importe_neto"]


def _renditions(spark, d):
    amount = F.col("l_quantity").cast(MONEY)
    return _lines(spark, d).select(
        year_of("l_shipdate").alias("ejercicio"), month_of("l_shipdate").alias("mes"), F.to_date(F.date_trunc("month", "l_shipdate")).alias("fecha"),
        F.when(F.col("o_custkey") % 6 == 5, "X").otherwise(F.concat(F.lit("S"), (F.col("o_custkey") % 6).cast("string"))).alias("cta_cte"),
        F.concat(F.lit("b"), (F.col("o_custkey") % 20).cast("string")).alias("beneficiario"),
        F.when(F.col("l_suppkey") % 4 > 0, (F.col("l_suppkey") % 4).cast("string")).alias("libramiento_sgf"), amount.alias("importe_bruto"), (amount / 2).cast(MONEY).alias("importe_neto"))


def _rendition_accounts(spark, d):
    k = F.col("n_nationkey")
    to = F.when(k == 1, "106").when(k == 2, "2210178150").when(k != 3, F.concat(F.lit("1308"), k.cast("string")))
    return table(spark, d, "nation").select(F.concat(F.lit("S"), k.cast("string")).alias("sgf_cta_cte"), to.alias("map_to"))


def _certificates(spark, d):
    n = F.col("libramiento").cast("long")
    return V(spark, d, "bank").withColumns({
        "cod_imputacion": F.when(F.col("cod_imputacion").isin("purchase", "view"), sources_clean.NEGATIVE_CERTIFICATE_CODE).otherwise(F.col("cod_imputacion")),
        "es_cheque": F.when(n % 7 > 0, n % 3 == 0), "concepto": F.concat(F.lit("c"), "libramiento"), "imputacion": F.col("movimiento")})


@query("d_src1", f"""
WITH {RENDITIONS_SQL} SELECT * REPLACE (CAST(importe_bruto AS DOUBLE) AS importe_bruto, CAST(importe_neto AS DOUBLE) AS importe_neto) FROM rc""")
def d_src1(spark, d):
    return fin(sources_clean.renditions_clean(_renditions(spark, d), account_map=_rendition_accounts(spark, d)).select(*SRC1_COLS))


@query("d_src1_neto", f"""
WITH {RENDITIONS_SQL}
SELECT ejercicio, mes, fecha, cta_cte, beneficiario, libramiento_sgf, CAST(importe_bruto AS DOUBLE) AS importe_bruto, CAST(importe_neto AS DOUBLE) AS importe_neto,
       NULL AS origen, NULL AS cuit, NULL AS destino FROM rc
UNION ALL
SELECT ejercicio, mes, fecha, cta_cte, 'c' || libramiento, NULL, CAST(-importe AS DOUBLE), CAST(-importe AS DOUBLE), 'BANCO', '30632351514', movimiento FROM bank
WHERE cod_imputacion IN ('purchase', 'view') AND movimiento = 'DEPOSITO' AND CAST(libramiento AS BIGINT) % 7 > 0 AND CAST(libramiento AS BIGINT) % 3 > 0""")
def d_src1_neto(spark, d):
    r = sources_clean.renditions_clean(_renditions(spark, d), _certificates(spark, d), net_negative_certificates=True, account_map=_rendition_accounts(spark, d))
    return fin(r.select(*SRC1_COLS, "origen", "cuit", "destino"))


# ---------------------------------------------------------------- the works ledger on cash basis (D-EO7)

#: Works loads line by line, netted of floating debt: rows move to the month of their payment, at times the next year.
CASH_SQL = f"""
wl AS (SELECT CAST(l_orderkey AS VARCHAR) AS nro_comprobante, CAST(year(l_shipdate) AS VARCHAR) AS ejercicio, strftime(l_shipdate, '%m/%Y') AS mes, CAST(l_shipdate AS DATE) AS fecha,
              CASE o_orderstatus WHEN 'P' THEN 'PA6' WHEN 'F' THEN 'REG' ELSE 'CYO' END AS tipo, 'B' || l_partkey % 9 AS actividad, l_returnflag AS partida,
              CASE WHEN l_partkey % 8 > 0 THEN CAST(l_partkey AS VARCHAR) END AS obra, l_quantity / 50 AS avance, CAST(l_extendedprice AS DECIMAL(18,2)) AS importe
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ba AS (SELECT * FROM wl WHERE tipo = 'CYO'),
{FIRST_SNAP_SQL.strip()},
{LAST_SNAP_SQL.strip()},
nt AS (SELECT ejercicio, fecha, tipo, actividad, partida, obra, avance, importe FROM wl WHERE tipo <> 'REG'
       UNION ALL SELECT b.ejercicio, b.fecha, 'RDEU', actividad, partida, obra, avance, -f.saldo FROM first_snap f JOIN ba b ON b.nro_comprobante = f.nro_comprobante AND b.mes = f.mes
       UNION ALL SELECT CAST(year(l.fecha_hasta + INTERVAL 1 MONTH) AS VARCHAR), CAST(l.fecha_hasta + INTERVAL 1 MONTH AS DATE), 'RDEU', actividad, partida, obra, avance, l.saldo
                 FROM last_snap l JOIN ba b ON b.nro_comprobante = l.nro_comprobante),
al AS (SELECT * FROM nt WHERE fecha <= DATE '2000-10-31' AND (ejercicio = '2000' OR CAST(ejercicio AS INTEGER) BETWEEN 1996 AND 1999 AND tipo <> 'PA6'))"""


def _works_net(spark, d):
    k = F.col("l_partkey")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    loads = table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").cast("string").alias("id"), F.col("l_orderkey").cast("string").alias("nro_comprobante"), year_of("l_shipdate").alias("ejercicio"),
        month_of("l_shipdate").alias("mes"), F.to_date("l_shipdate").alias("fecha"),
        F.when(F.col("o_orderstatus") == "P", "PA6").when(F.col("o_orderstatus") == "F", "REG").otherwise("CYO").alias("tipo"),
        F.concat(F.lit("B"), (k % 9).cast("string")).alias("actividad"), F.col("l_returnflag").alias("partida"), F.when(k % 8 > 0, k.cast("string")).alias("obra"),
        (F.col("l_quantity") / F.lit(50)).alias("avance"), F.col("l_extendedprice").cast(MONEY).alias("importe"))
    return materialize(op.net_pending(loads, V(spark, d, "snapshots"), snap_cols=["cuit"], load_cols=["actividad", "partida", "obra", "avance"]), "net")


@query("d_eo7_cash", f"""
WITH {CASH_SQL},
y AS (SELECT DISTINCT CAST(ejercicio AS INTEGER) AS h FROM al),
dd AS (SELECT actividad, partida, obra, CAST(ejercicio AS INTEGER) AS y, sum(importe) AS s, max(avance) AS mx FROM al GROUP BY ALL),
wy AS (SELECT obra, y, max(mx) AS mx FROM dd WHERE obra IS NOT NULL GROUP BY ALL),
wf AS (SELECT obra, h, max(mx) AS le, max(CASE WHEN wy.y < h THEN mx END) AS lt FROM wy JOIN y ON wy.y <= h GROUP BY ALL),
a AS (SELECT actividad, partida, x.h, sum(s) AS acum, coalesce(sum(CASE WHEN x.y = x.h THEN s END), 0) AS ejecucion, coalesce(sum(CASE WHEN le < 1 THEN s END), 0) AS en_curso,
             coalesce(sum(CASE WHEN x.y < x.h AND lt = 1 THEN s END), 0) AS terminadas_ant
      FROM (SELECT dd.*, h FROM dd JOIN y ON dd.y <= h) x LEFT JOIN wf ON wf.obra = x.obra AND wf.h = x.h GROUP BY ALL),
f AS (SELECT actividad, partida, CAST(min(y) AS VARCHAR) AS alta FROM dd GROUP BY ALL)
SELECT actividad || '-' || partida AS estructura, alta, CAST(h AS VARCHAR) AS ejercicio, CAST(acum AS DOUBLE) AS acum, CAST(en_curso AS DOUBLE) AS en_curso,
       CAST(terminadas_ant AS DOUBLE) AS terminadas_ant, CAST(ejecucion AS DOUBLE) AS ejecucion, CAST(acum - en_curso - terminadas_ant AS DOUBLE) AS terminadas_actual
FROM a JOIN f USING (actividad, partida)""")
def d_eo7_cash(spark, d):
    net = _works_net(spark, d)
    out = works.works_ledger_for_accounting(net.filter(F.col("tipo") != "PA6"), ["actividad", "partida"], from_year=1996, date_up_to="2000-10-31", current_cash=net,
                                            current_year="2000")
    return fin(out)


@query("d_eo7_cash_total", f"""
WITH {CASH_SQL}, y AS (SELECT DISTINCT CAST(ejercicio AS INTEGER) AS h FROM al)
SELECT CAST(h AS VARCHAR) AS ejercicio, CAST(sum(importe) AS DOUBLE) AS acum FROM al JOIN y ON CAST(ejercicio AS INTEGER) <= h GROUP BY 1""")
def d_eo7_cash_total(spark, d):
    """Every report year's total: the netted loads up to that year."""
    net = _works_net(spark, d)
    out = works.works_ledger_for_accounting(net.filter(F.col("tipo") != "PA6"), ["actividad", "partida"], from_year=1996, date_up_to="2000-10-31", current_cash=net,
                                            current_year="2000")
    return fin(op.group_sum(out, ["ejercicio"], ["acum"]))


# ---------------------------------------------------------------- written sources (S-10, S-14, S-25, K-01)

def write_sources(spark: SparkSession, d: str) -> str:
    """Loads, debt and ledger as the sources' tables, partitioned by year; loads without year, other columns than declared
    (one more, several missing).  The folder they are in."""
    root = f"{checkpoint_root(spark).rstrip('/')}/sources-{uuid.uuid4().hex}"
    n = F.col("id").cast("long")
    loads = V(spark, d, "loads").withColumns({"ejercicio": F.when(n % 97 > 0, F.col("ejercicio")), "extra": F.lit("not declared")})
    io.write_tables({"icaro_carga": loads, "siif_rdeu012": _debt(spark, d), "siif_rcocc31": _major(spark, d)}, root)
    return root


def _by_year(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.groupBy("ejercicio").agg(F.count("*").alias("n"), F.sum(value).alias("importe")).select(F.lit(name).alias("fuente"), "ejercicio", "n", "importe")


@query("k_sources", f"""
WITH {DEBT_SQL.strip()}, {MAJOR_SQL.strip()},
c AS (SELECT CASE WHEN CAST(id AS BIGINT) % 97 > 0 THEN ejercicio END AS ejercicio, tipo, importe FROM loads)
SELECT 'S-10' AS fuente, ejercicio, count(*) AS n, CAST(sum(importe) AS DOUBLE) AS importe FROM c WHERE tipo <> 'PA6' GROUP BY 2
UNION ALL SELECT 'S-10 1998', ejercicio, count(*), CAST(sum(importe) AS DOUBLE) FROM c WHERE ejercicio IN ('1998', '2000') GROUP BY 2
UNION ALL SELECT 'S-14', ejercicio, count(*), CAST(sum(saldo) AS DOUBLE) FROM rdeu WHERE ejercicio = '2013' GROUP BY 2
UNION ALL SELECT 'S-25', ejercicio, count(*), CAST(sum(saldo) AS DOUBLE) FROM gl WHERE cta_contable = '2111-1-1' AND ejercicio IN ('2012', '2014') GROUP BY 2""")
def k_sources(spark, d):
    """Sources written by year and read back with their schemas and filters."""
    root = write_sources(spark, d)
    return fin(op.union_all(
        _by_year(systems.works_loads(spark, root, skip_advances=True), "S-10", "importe"),
        _by_year(systems.works_loads(spark, root, years=["1998", "2000"]), "S-10 1998", "importe"),
        _by_year(systems.floating_debt(spark, root, years="2013"), "S-14", "saldo"),
        _by_year(systems.general_ledger(spark, root, years=["2012", "2014"], account="2111-1-1"), "S-25", "saldo")))


def bucketed_pair(spark: SparkSession, d: str, buckets: int = 16) -> tuple[str, str]:
    """Loads and payments as tables of the session's catalog, bucketed and sorted by voucher; their names."""
    tag = uuid.uuid4().hex
    names = [f"bk_loads_{tag}", f"bk_payments_{tag}"]
    by = (buckets, ["nro_comprobante"])
    io.write_tables({names[0]: V(spark, d, "loads"), names[1]: V(spark, d, "payments")}, f"{checkpoint_root(spark).rstrip('/')}/buckets-{tag}",
                    partition_by_year=False, bucket_by={n: by for n in names})
    return names[0], names[1]


def bucketed_join(spark: SparkSession, names: tuple[str, str]) -> DataFrame:
    """Paid amounts by load: both sides summed by voucher and joined inside their buckets, without an exchange."""
    loads, payments = (spark.table(n) for n in names)
    paid = payments.groupBy("nro_comprobante").agg(F.sum("importe_bruto").alias("pagado"), F.count("*").alias("pagos"))
    return loads.select("nro_comprobante", "cta_cte", "importe").join(paid.hint("merge"), "nro_comprobante", "left")


@query("k_bucketed", """
WITH p AS (SELECT nro_comprobante, sum(importe_bruto) AS pagado, count(*) AS pagos FROM payments GROUP BY 1)
SELECT nro_comprobante, cta_cte, CAST(importe AS DOUBLE) AS importe, CAST(pagado AS DOUBLE) AS pagado, pagos FROM loads LEFT JOIN p USING (nro_comprobante)""")
def k_bucketed(spark, d):
    return fin(bucketed_join(spark, bucketed_pair(spark, d)))
