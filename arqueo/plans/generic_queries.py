"""One query per generic operator on the domain views."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from ..functions import scalars as sc
from ..sources.views import table
from .registry import V, fin, query

KEYS3 = ["ejercicio", "mes", "cta_cte"]

# ---------------------------------------------------------------- filters


@query("p_years", """
SELECT id, ejercicio, mes, cta_cte, tipo, CAST(importe AS DOUBLE) AS importe
FROM loads WHERE ejercicio IN ('1996', '1998')""")
def p_years(spark, d):
    ld = V(spark, d, "loads")
    return fin(op.years(ld, ["1996", "1998"], date_col="fecha").select("id", "ejercicio", "mes", "cta_cte", "tipo", "importe"))


@query("p_up_to_year", """
SELECT id, ejercicio, CAST(importe AS DOUBLE) AS importe FROM loads WHERE CAST(ejercicio AS INTEGER) <= 1997""")
def p_up_to_year(spark, d):
    return fin(op.up_to(V(spark, d, "loads"), "1997", date_col="fecha").select("id", "ejercicio", "importe"))


@query("p_exclude_codes", """
SELECT libramiento, cod, CAST(importe AS DOUBLE) AS importe
FROM (SELECT libramiento, NULLIF(cod_imputacion, 'error') AS cod, importe FROM bank)
WHERE cod IS NULL OR cod NOT IN ('click', 'view')""")
def p_exclude_codes(spark, d):
    b = V(spark, d, "bank").select("libramiento", F.nullif(F.col("cod_imputacion"), F.lit("error")).alias("cod"),
                                   "importe")
    return fin(op.codes(b, "cod", exclude=["click", "view"]))


@query("p_pattern", """
SELECT obra, desc_obra, ejercicio, CAST(importe AS DOUBLE) AS importe FROM works
WHERE NOT coalesce(regexp_matches(desc_obra, 'ring|bolt'), false)""")
def p_pattern(spark, d):
    w = V(spark, d, "works").select("obra", "desc_obra", "ejercicio", "importe")
    return fin(op.matches(w, "desc_obra", ["ring", "bolt"], keep=False))


@query("p_prefix", """
SELECT obra, actividad, CAST(importe AS DOUBLE) AS importe FROM works
WHERE starts_with(actividad, 'Brand#1') AND NOT ends_with(obra, '7')""")
def p_prefix(spark, d):
    w = V(spark, d, "works").select("obra", "actividad", "importe")
    w = op.prefix_filter(w, "actividad", prefix="Brand#1")
    return fin(op.prefix_filter(w, "obra", suffix="7", keep=False))


BANK_CLASSES = {"1 - Recursos": ["purchase", "signup"], "2 - Gtos. Funcionamiento": ["click"],
                "3 - Inversión Obras": ["view"]}


@query("p_classify", """
SELECT libramiento, cod_imputacion,
       CASE WHEN cod_imputacion IN ('purchase', 'signup') THEN '1 - Recursos'
            WHEN cod_imputacion IN ('click') THEN '2 - Gtos. Funcionamiento'
            WHEN cod_imputacion IN ('view') THEN '3 - Inversión Obras' ELSE '4 - OTROS' END AS clase
FROM bank""")
def p_classify(spark, d):
    b = V(spark, d, "bank").select("libramiento", "cod_imputacion")
    return op.classify(b, "cod_imputacion", BANK_CLASSES, "4 - OTROS")


@query("p_overwrite", """
SELECT id, CASE WHEN tipo = 'PA6' AND fuente = '11' THEN 'Macro' ELSE cta_cte END AS cta_cte FROM loads""")
def p_overwrite(spark, d):
    ld = V(spark, d, "loads").select("id", "cta_cte", "tipo", "fuente")
    return op.overwrite(ld, (F.col("tipo") == "PA6") & (F.col("fuente") == "11"), "cta_cte", "Macro") \
        .select("id", "cta_cte")


@query("p_negate", """
SELECT libramiento, CAST(-importe AS DOUBLE) AS importe FROM bank WHERE movimiento <> 'DEPOSITO'""")
def p_negate(spark, d):
    b = V(spark, d, "bank")
    b = b.filter(~F.col("movimiento").eqNullSafe("DEPOSITO")).select("libramiento", "importe")
    return fin(op.negate(b, "importe"))


@query("p_prefix_cols", """
SELECT ejercicio, mes, CAST(sum(importe_neto) AS DOUBLE) AS sgf_importe_neto,
       CAST(sum(retenciones) AS DOUBLE) AS sgf_retenciones
FROM payments GROUP BY ejercicio, mes""")
def p_prefix_cols(spark, d):
    g = op.group_sum(V(spark, d, "payments"), ["ejercicio", "mes"], ["importe_neto", "retenciones"])
    return fin(op.prefix_columns(g, "sgf_", keep=["ejercicio", "mes"]))


@query("p_dropna", """
SELECT c.c_custkey, r.r_name AS region
FROM customer c
LEFT JOIN (SELECT map_to, sscc_cta_cte FROM acct_map WHERE sscc_cta_cte IS NOT NULL) m
       ON 'NATION_' || CAST(c.c_nationkey AS VARCHAR) = m.sscc_cta_cte
LEFT JOIN region r ON m.map_to = r.r_name
WHERE m.map_to IS NOT NULL""")
def p_dropna(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet").select(
        "c_custkey", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("region"))
    m = op.lookup(c, V(spark, d, "acct_map"), "region", "sscc_cta_cte", "map_to")
    return op.dropna(m, subset=["region"])


@query("p_only_diff", """
WITH a AS (SELECT ejercicio, cta_cte, sum(importe) AS ejecutado FROM loads GROUP BY ALL),
     b AS (SELECT ejercicio, cta_cte, sum(importe_bruto) AS pagado FROM payments GROUP BY ALL),
     j AS (SELECT coalesce(a.ejercicio, b.ejercicio) AS ejercicio, coalesce(a.cta_cte, b.cta_cte) AS cta_cte,
                  coalesce(ejecutado, 0) AS ejecutado, coalesce(pagado, 0) AS pagado,
                  coalesce(ejecutado, 0) - coalesce(pagado, 0) AS diferencia
           FROM a FULL JOIN b ON a.ejercicio = b.ejercicio AND a.cta_cte = b.cta_cte)
SELECT ejercicio, cta_cte, CAST(ejecutado AS DOUBLE) AS ejecutado, CAST(pagado AS DOUBLE) AS pagado,
       CAST(diferencia AS DOUBLE) AS diferencia
FROM j WHERE ejecutado + pagado + diferencia <> 0""")
def p_only_diff(spark, d):
    r = op.reconcile(V(spark, d, "loads"), V(spark, d, "payments"), ["ejercicio", "cta_cte"],
                     {"ejecutado": "importe"}, {"pagado": "importe_bruto"})
    return fin(op.only_diff(r, ["ejecutado", "pagado", "diferencia"]))


RECON3_SQL = """
a AS (SELECT ejercicio, mes, cta_cte, sum(importe) AS ejecutado FROM loads GROUP BY ALL),
b AS (SELECT ejercicio, mes, cta_cte, sum(importe_bruto) AS pagado FROM payments GROUP BY ALL),
r AS (SELECT coalesce(a.ejercicio, b.ejercicio) AS ejercicio, coalesce(a.mes, b.mes) AS mes,
             coalesce(a.cta_cte, b.cta_cte) AS cta_cte,
             coalesce(ejecutado, 0) AS ejecutado, coalesce(pagado, 0) AS pagado,
             coalesce(ejecutado, 0) - coalesce(pagado, 0) AS diferencia
      FROM a FULL JOIN b ON a.ejercicio = b.ejercicio AND a.mes = b.mes AND a.cta_cte = b.cta_cte)"""


def _recon3(spark, d):
    return op.reconcile(V(spark, d, "loads"), V(spark, d, "payments"), KEYS3,
                        {"ejecutado": "importe"}, {"pagado": "importe_bruto"})


@query("p_tolerance", f"""
WITH {RECON3_SQL}
SELECT ejercicio, mes, cta_cte, CAST(diferencia AS DOUBLE) AS diferencia FROM r WHERE abs(diferencia) >= 100000""")
def p_tolerance(spark, d):
    r = op.beyond(_recon3(spark, d), "diferencia", 100000, strict=False)
    return fin(r.select(*KEYS3, "diferencia"))


VOUCHER_SQL = """
lv AS (SELECT nro_comprobante AS siif_nro, ejercicio AS siif_ejercicio, cuit AS siif_cuit,
              sum(importe) AS siif_importe FROM loads GROUP BY ALL),
pv AS (SELECT nro_comprobante AS sgf_nro, min(ejercicio) AS sgf_ejercicio, min(cuit) AS sgf_cuit,
              sum(importe_bruto) AS sgf_importe FROM payments GROUP BY nro_comprobante),
mv AS (SELECT * FROM lv FULL JOIN pv ON siif_nro = sgf_nro)"""


def _vouchers(spark, d):
    lv = (V(spark, d, "loads").groupBy("nro_comprobante", "ejercicio", "cuit").agg(F.sum("importe").alias("imp"))
          .select(F.col("nro_comprobante").alias("siif_nro"), F.col("ejercicio").alias("siif_ejercicio"),
                  F.col("cuit").alias("siif_cuit"), F.col("imp").alias("siif_importe")))
    pv = (V(spark, d, "payments").groupBy("nro_comprobante")
          .agg(F.min("ejercicio").alias("sgf_ejercicio"), F.min("cuit").alias("sgf_cuit"),
               F.sum("importe_bruto").alias("sgf_importe"))
          .withColumnRenamed("nro_comprobante", "sgf_nro"))
    return op.match_vouchers(lv, pv, [("siif_nro", "sgf_nro")], how="full")


@query("p_mismatch_flags", f"""
WITH {VOUCHER_SQL}
SELECT siif_nro, sgf_nro, siif_ejercicio, sgf_ejercicio,
       CAST(siif_importe AS DOUBLE) AS siif_importe, CAST(sgf_importe AS DOUBLE) AS sgf_importe,
       coalesce(siif_ejercicio <> sgf_ejercicio, true) AS err_ejercicio,
       coalesce(siif_cuit <> sgf_cuit, true) AS err_cuit,
       siif_importe IS DISTINCT FROM sgf_importe AS err_importe
FROM mv
WHERE coalesce(siif_ejercicio <> sgf_ejercicio, true) OR coalesce(siif_cuit <> sgf_cuit, true)
   OR siif_importe IS DISTINCT FROM sgf_importe""")
def p_mismatch_flags(spark, d):
    m = op.flag_mismatch(_vouchers(spark, d), {"err_ejercicio": ("siif_ejercicio", "sgf_ejercicio"),
                                               "err_cuit": ("siif_cuit", "sgf_cuit")}, only_flagged=False)
    # amounts were filled from sums: two missing amounts compare equal
    m = op.flag_mismatch(m, {"err_importe": ("siif_importe", "sgf_importe")}, null_policy="equal",
                         only_flagged=False)
    m = m.filter(F.col("err_ejercicio") | F.col("err_cuit") | F.col("err_importe"))
    return fin(m.select("siif_nro", "sgf_nro", "siif_ejercicio", "sgf_ejercicio", "siif_importe", "sgf_importe",
                        "err_ejercicio", "err_cuit", "err_importe"))


@query("p_date_bound", """
SELECT obra, fecha, CAST(importe AS DOUBLE) AS importe FROM works WHERE fecha <= DATE '1997-06-30'""")
def p_date_bound(spark, d):
    return fin(op.date_bound(V(spark, d, "works").select("obra", "fecha", "importe"), "fecha", "1997-06-30"))


# ---------------------------------------------------------------- joins

@query("j_map_code", """
SELECT c.c_custkey, m.map_to AS cta_cte
FROM customer c
LEFT JOIN (SELECT map_to, sscc_cta_cte FROM acct_map WHERE sscc_cta_cte IS NOT NULL) m
       ON 'NATION_' || CAST(c.c_nationkey AS VARCHAR) = m.sscc_cta_cte""")
def j_map_code(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet").select(
        "c_custkey", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("cta_cte"))
    return op.lookup(c, V(spark, d, "acct_map"), "cta_cte", "sscc_cta_cte", "map_to")


@query("j_left_enrich", """
SELECT w.obra, w.importe, p.p_name AS desc_obra, p.p_brand AS brand
FROM (SELECT obra, CAST(sum(importe) AS DOUBLE) AS importe FROM works GROUP BY obra) w
LEFT JOIN part p ON CAST(p.p_partkey AS VARCHAR) = w.obra""")
def j_left_enrich(spark, d):
    w = op.group_sum(V(spark, d, "works"), ["obra"], ["importe"])
    p = spark.read.parquet(f"{d}/part.parquet").select(
        F.col("p_partkey").cast("string").alias("obra"), F.col("p_name").alias("desc_obra"),
        F.col("p_brand").alias("brand"))
    return fin(op.enrich(w, p, "obra"))


@query("j_hierarchy", """
SELECT c.c_custkey, c.c_nationkey, n.n_name, n.n_regionkey, r.r_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def j_hierarchy(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey", "n_name", "n_regionkey")
    r = spark.read.parquet(f"{d}/region.parquet").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    h = op.hierarchy([(c, []), (n, ["n_nationkey"]), (r, ["n_regionkey"])])
    return h.select("c_custkey", F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey", "r_name")


FIRST_SNAP_SQL = """
first_snap AS (SELECT nro_comprobante, mes, saldo FROM (
    SELECT nro_comprobante, mes, saldo, row_number() OVER (PARTITION BY nro_comprobante, mes
        ORDER BY fecha_hasta ASC NULLS LAST, saldo ASC NULLS LAST) AS rn FROM snapshots) WHERE rn = 1)"""


@query("j_natural", f"""
WITH {FIRST_SNAP_SQL}
SELECT f.nro_comprobante, f.mes, CAST(f.saldo AS DOUBLE) AS saldo, l.id, l.ejercicio, l.cta_cte,
       CAST(l.importe AS DOUBLE) AS importe
FROM first_snap f JOIN loads l ON f.nro_comprobante = l.nro_comprobante AND f.mes = l.mes""")
def j_natural(spark, d):
    first = op.netting.monthly_snapshots(V(spark, d, "snapshots")).select("nro_comprobante", "mes", F.col("first.saldo").alias("saldo"))
    ld = V(spark, d, "loads").select("nro_comprobante", "mes", "id", "ejercicio", "cta_cte", "importe")
    return fin(op.natural_join(first, ld))


@query("j_inner", """
SELECT l.nro_comprobante, l.ejercicio, CAST(l.importe AS DOUBLE) AS importe, CAST(p.pagado AS DOUBLE) AS pagado
FROM loads l JOIN (SELECT nro_comprobante, sum(importe_bruto) AS pagado FROM payments GROUP BY 1) p
  ON l.nro_comprobante = p.nro_comprobante""")
def j_inner(spark, d):
    p = op.group_sum(V(spark, d, "payments"), ["nro_comprobante"], {"pagado": "importe_bruto"})
    ld = V(spark, d, "loads").select("nro_comprobante", "ejercicio", "importe")
    return fin(op.inner(ld, p, "nro_comprobante"))


@query("j_full_fill0", f"""
WITH {RECON3_SQL}
SELECT ejercicio, mes, cta_cte, CAST(ejecutado AS DOUBLE) AS ejecutado, CAST(pagado AS DOUBLE) AS pagado,
       CAST(diferencia AS DOUBLE) AS diferencia FROM r""")
def j_full_fill0(spark, d):
    return fin(_recon3(spark, d))


@query("j_full_voucher", f"""
WITH {VOUCHER_SQL}
SELECT siif_nro, sgf_nro, coalesce(siif_ejercicio, sgf_ejercicio) AS ejercicio,
       CAST(siif_importe AS DOUBLE) AS siif_importe, CAST(sgf_importe AS DOUBLE) AS sgf_importe FROM mv""")
def j_full_voucher(spark, d):
    m = _vouchers(spark, d)
    m = m.withColumn("ejercicio", F.coalesce("siif_ejercicio", "sgf_ejercicio"))
    return fin(m.select("siif_nro", "sgf_nro", "ejercicio", "siif_importe", "sgf_importe"))


@query("j_semi", """
SELECT id, ejercicio, CAST(importe AS DOUBLE) AS importe FROM loads l
WHERE EXISTS (SELECT 1 FROM payments p WHERE p.nro_comprobante = l.nro_comprobante AND p.codigo = 'R')""")
def j_semi(spark, d):
    p = V(spark, d, "payments").filter(F.col("codigo") == "R")
    return fin(op.semi(V(spark, d, "loads"), p, "nro_comprobante").select("id", "ejercicio", "importe"))


@query("j_anti", """
SELECT id, ejercicio, CAST(importe AS DOUBLE) AS importe FROM loads l
WHERE NOT EXISTS (SELECT 1 FROM payments p WHERE p.nro_comprobante = l.nro_comprobante AND p.codigo = 'R')""")
def j_anti(spark, d):
    p = V(spark, d, "payments").filter(F.col("codigo") == "R")
    return fin(op.anti(V(spark, d, "loads"), p, "nro_comprobante").select("id", "ejercicio", "importe"))


@query("j_semi_having", """
SELECT nro_comprobante, fecha, CAST(importe_bruto AS DOUBLE) AS importe_bruto FROM payments
WHERE nro_comprobante IN (SELECT nro_comprobante FROM payments GROUP BY 1 HAVING abs(sum(importe_bruto)) > 300000)""")
def j_semi_having(spark, d):
    p = V(spark, d, "payments")
    out = op.having_semi(p, ["nro_comprobante"], "importe_bruto", lambda s: F.abs(s) > 300000)
    return fin(out.select("nro_comprobante", "fecha", "importe_bruto"))


ALIGN_SQL = """
a AS (SELECT ejercicio, cta_cte, sum(importe) AS recurso FROM loads WHERE tipo <> 'REG' GROUP BY ALL),
b AS (SELECT ejercicio, cta_cte, sum(retenciones) AS retencion FROM payments WHERE codigo <> 'N' GROUP BY ALL)"""


@query("j_align_union", f"""
WITH {ALIGN_SQL}
SELECT coalesce(a.ejercicio, b.ejercicio) AS ejercicio, coalesce(a.cta_cte, b.cta_cte) AS cta_cte,
       CAST(coalesce(recurso, 0) AS DOUBLE) AS recurso, CAST(coalesce(retencion, 0) AS DOUBLE) AS retencion
FROM a FULL JOIN b ON a.ejercicio = b.ejercicio AND a.cta_cte = b.cta_cte""")
def j_align_union(spark, d):
    a = V(spark, d, "loads").filter(F.col("tipo") != "REG")
    b = V(spark, d, "payments").filter(F.col("codigo") != "N")
    return fin(op.reconcile(a, b, ["ejercicio", "cta_cte"], {"recurso": "importe"}, {"retencion": "retenciones"},
                            diff=None))


@query("j_align_left", f"""
WITH {ALIGN_SQL}
SELECT a.ejercicio, a.cta_cte, CAST(recurso AS DOUBLE) AS recurso,
       CAST(coalesce(retencion, 0) AS DOUBLE) AS retencion,
       CAST(recurso - coalesce(retencion, 0) AS DOUBLE) AS diferencia
FROM a LEFT JOIN b ON a.ejercicio = b.ejercicio AND a.cta_cte = b.cta_cte""")
def j_align_left(spark, d):
    a = V(spark, d, "loads").filter(F.col("tipo") != "REG")
    b = V(spark, d, "payments").filter(F.col("codigo") != "N")
    return fin(op.reconcile(a, b, ["ejercicio", "cta_cte"], {"recurso": "importe"}, {"retencion": "retenciones"},
                            how="left"))


AS_OF_YEARS = [str(y) for y in range(1992, 2003)]


@query("j_asof_years", f"""
WITH y AS (SELECT CAST(unnest(range(1992, 2003)) AS INTEGER) AS hasta),
     g AS (SELECT ejercicio, fuente, sum(importe) AS importe, count(*) AS n FROM works GROUP BY ALL)
SELECT CAST(y.hasta AS VARCHAR) AS hasta, g.fuente, CAST(sum(g.importe) AS DOUBLE) AS acumulado,
       CAST(sum(g.n) AS BIGINT) AS lineas
FROM g JOIN y ON CAST(g.ejercicio AS INTEGER) <= y.hasta GROUP BY ALL""")
def j_asof_years(spark, d):
    g = V(spark, d, "works").groupBy("ejercicio", "fuente").agg(F.sum("importe").alias("importe"),
                                                                 F.count(F.lit(1)).alias("n"))
    e = op.as_of_years(g, AS_OF_YEARS)
    return fin(e.groupBy("hasta", "fuente").agg(F.sum("importe").alias("acumulado"),
                                                 F.sum("n").cast("bigint").alias("lineas")))


@query("j_subtract", """
WITH a AS (SELECT ejercicio, cta_cte, sum(importe) AS importe,
                  sum(CASE WHEN tipo = 'PA6' THEN importe ELSE 0 END) AS pa6 FROM loads GROUP BY ALL),
     b AS (SELECT ejercicio, cta_cte, sum(importe_neto) AS importe, sum(retenciones) AS retenciones
           FROM payments GROUP BY ALL)
SELECT coalesce(a.ejercicio, b.ejercicio) AS ejercicio, coalesce(a.cta_cte, b.cta_cte) AS cta_cte,
       CAST(coalesce(a.importe, 0) - coalesce(b.importe, 0) AS DOUBLE) AS importe,
       CAST(0 AS DOUBLE) AS pa6, CAST(0 AS DOUBLE) AS retenciones
FROM a FULL JOIN b ON a.ejercicio = b.ejercicio AND a.cta_cte = b.cta_cte""")
def j_subtract(spark, d):
    ld = V(spark, d, "loads").withColumn("pa6", F.when(F.col("tipo") == "PA6", F.col("importe")).otherwise(0))
    a = op.group_sum(ld, ["ejercicio", "cta_cte"], ["importe", "pa6"])
    b = op.group_sum(V(spark, d, "payments"), ["ejercicio", "cta_cte"],
                     {"importe": "importe_neto", "retenciones": "retenciones"})
    return fin(op.subtract(a, b, ["ejercicio", "cta_cte"]))


@query("j_concat_cols", """
WITH a AS (SELECT ejercicio, sum(importe) AS cargado FROM loads GROUP BY 1),
     b AS (SELECT ejercicio, sum(importe_bruto) AS pagado FROM payments GROUP BY 1),
     c AS (SELECT ejercicio, sum(saldo) AS deuda FROM snapshots GROUP BY 1)
SELECT coalesce(a.ejercicio, b.ejercicio, c.ejercicio) AS ejercicio, CAST(cargado AS DOUBLE) AS cargado,
       CAST(pagado AS DOUBLE) AS pagado, CAST(deuda AS DOUBLE) AS deuda
FROM a FULL JOIN b ON a.ejercicio = b.ejercicio
FULL JOIN c ON coalesce(a.ejercicio, b.ejercicio) = c.ejercicio""")
def j_concat_cols(spark, d):
    a = op.group_sum(V(spark, d, "loads"), ["ejercicio"], {"cargado": "importe"})
    b = op.group_sum(V(spark, d, "payments"), ["ejercicio"], {"pagado": "importe_bruto"})
    c = op.group_sum(V(spark, d, "snapshots"), ["ejercicio"], {"deuda": "saldo"})
    return fin(op.concat_columns({"cargado": a, "pagado": b, "deuda": c}, ["ejercicio"]))


@query("j_star", """
WITH s AS (SELECT DISTINCT ejercicio FROM loads),
     b AS (SELECT ejercicio, sum(importe_bruto) AS pagado FROM payments GROUP BY 1),
     c AS (SELECT ejercicio, sum(saldo) AS deuda FROM snapshots GROUP BY 1)
SELECT s.ejercicio, CAST(b.pagado AS DOUBLE) AS pagado, CAST(c.deuda AS DOUBLE) AS deuda
FROM s LEFT JOIN b ON s.ejercicio = b.ejercicio LEFT JOIN c ON s.ejercicio = c.ejercicio""")
def j_star(spark, d):
    spine = op.distinct_values(V(spark, d, "loads"), ["ejercicio"])
    b = op.group_sum(V(spark, d, "payments"), ["ejercicio"], {"pagado": "importe_bruto"})
    c = op.group_sum(V(spark, d, "snapshots"), ["ejercicio"], {"deuda": "saldo"})
    return fin(op.star(spine, {"pagado": b, "deuda": c}, ["ejercicio"]))


@query("j_many_to_many", """
WITH a AS (SELECT ejercicio, mes, cta_cte, sum(importe) AS icaro_total FROM loads GROUP BY ALL),
     b AS (SELECT ejercicio, mes, cta_cte, sum(importe_bruto) AS sgf_total FROM payments GROUP BY ALL),
     t AS (SELECT coalesce(a.ejercicio, b.ejercicio) AS ejercicio, coalesce(a.mes, b.mes) AS mes,
                  coalesce(a.cta_cte, b.cta_cte) AS cta_cte, coalesce(icaro_total, 0) AS icaro_total,
                  coalesce(sgf_total, 0) AS sgf_total, coalesce(icaro_total, 0) - coalesce(sgf_total, 0) AS diferencia
           FROM a FULL JOIN b ON a.ejercicio = b.ejercicio AND a.mes = b.mes AND a.cta_cte = b.cta_cte),
     dd AS (SELECT ejercicio, mes, cta_cte, 'icaro' AS lado, nro_comprobante AS icaro_nro_comprobante,
                   importe AS icaro_importe, NULL AS sgf_nro_comprobante, NULL AS sgf_importe_bruto FROM loads
            UNION ALL
            SELECT ejercicio, mes, cta_cte, 'sgf', NULL, NULL, nro_comprobante, importe_bruto FROM payments)
SELECT dd.ejercicio, dd.mes, dd.cta_cte, lado, icaro_nro_comprobante, CAST(icaro_importe AS DOUBLE) AS icaro_importe,
       sgf_nro_comprobante, CAST(sgf_importe_bruto AS DOUBLE) AS sgf_importe_bruto,
       CAST(icaro_total AS DOUBLE) AS icaro_total, CAST(sgf_total AS DOUBLE) AS sgf_total,
       CAST(diferencia AS DOUBLE) AS diferencia
FROM dd LEFT JOIN t ON dd.ejercicio = t.ejercicio AND dd.mes = t.mes AND dd.cta_cte = t.cta_cte""")
def j_many_to_many(spark, d):
    a = V(spark, d, "loads").select(*KEYS3, "nro_comprobante", "importe")
    b = V(spark, d, "payments").select(*KEYS3, "nro_comprobante", "importe_bruto")
    out = op.full_detail(a, b, KEYS3, "importe", "importe_bruto", "icaro_", "sgf_")
    return fin(out.select(*KEYS3, "lado", "icaro_nro_comprobante", "icaro_importe", "sgf_nro_comprobante",
                          "sgf_importe_bruto", "icaro_total", "sgf_total", "diferencia"))


# ---------------------------------------------------------------- aggregations

@query("a_group_sum", """
SELECT ejercicio, cta_cte, CAST(sum(importe_neto) AS DOUBLE) AS importe_neto,
       CAST(sum(retenciones) AS DOUBLE) AS retenciones FROM payments GROUP BY ALL""")
def a_group_sum(spark, d):
    return fin(op.group_sum(V(spark, d, "payments"), ["ejercicio", "cta_cte"], ["importe_neto", "retenciones"]))


@query("a_sum_all_numeric", """
SELECT ejercicio, mes, CAST(sum(importe_bruto) AS DOUBLE) AS importe_bruto,
       CAST(sum(importe_neto) AS DOUBLE) AS importe_neto, CAST(sum(retenciones) AS DOUBLE) AS retenciones
FROM payments GROUP BY ALL""")
def a_sum_all_numeric(spark, d):
    return fin(op.sum_numeric(V(spark, d, "payments"), ["ejercicio", "mes"]))


@query("a_min_max", """
SELECT obra, min(ejercicio) AS primer_ejercicio, max(avance) AS avance_max FROM works GROUP BY obra""")
def a_min_max(spark, d):
    return op.group_min_max(V(spark, d, "works"), ["obra"], {"primer_ejercicio": "ejercicio"},
                            {"avance_max": "avance"})


@query("a_pivot", """
SELECT ejercicio, cta_cte,
       CAST(coalesce(sum(CASE WHEN codigo = 'A' THEN retenciones END), 0) AS DOUBLE) AS "A",
       CAST(coalesce(sum(CASE WHEN codigo = 'N' THEN retenciones END), 0) AS DOUBLE) AS "N",
       CAST(coalesce(sum(CASE WHEN codigo = 'R' THEN retenciones END), 0) AS DOUBLE) AS "R",
       CAST(coalesce(sum(CASE WHEN codigo = 'A' THEN retenciones END), 0)
          + coalesce(sum(CASE WHEN codigo = 'N' THEN retenciones END), 0)
          + coalesce(sum(CASE WHEN codigo = 'R' THEN retenciones END), 0) AS DOUBLE) AS total_retenciones
FROM payments GROUP BY ALL""")
def a_pivot(spark, d):
    return fin(op.pivot_sum(V(spark, d, "payments"), ["ejercicio", "cta_cte"], "codigo", "retenciones",
                            values=["A", "N", "R"], total="total_retenciones"))


@query("a_row_total", """
SELECT ejercicio, CAST(sum(importe_neto) AS DOUBLE) AS importe_neto, CAST(sum(retenciones) AS DOUBLE) AS retenciones,
       CAST(sum(importe_neto) + sum(retenciones) AS DOUBLE) AS total FROM payments GROUP BY 1""")
def a_row_total(spark, d):
    g = op.group_sum(V(spark, d, "payments"), ["ejercicio"], ["importe_neto", "retenciones"])
    return fin(op.row_total(g, ["importe_neto", "retenciones"], "total"))


@query("a_totals", """
SELECT CAST(sum(importe_bruto) AS DOUBLE) AS importe_bruto, CAST(sum(retenciones) AS DOUBLE) AS retenciones,
       CAST(count(*) AS BIGINT) AS lineas FROM payments""")
def a_totals(spark, d):
    return fin(op.totals(V(spark, d, "payments"), ["importe_bruto", "retenciones"], count="lineas"))


COND_ROWS = {"altas": ["signup"], "ventas": ["purchase"], "devoluciones": ["refund"]}


@query("a_conditional_rows", """
WITH k AS (SELECT DISTINCT ejercicio FROM bank WHERE ejercicio IS NOT NULL),
     l AS (SELECT * FROM (VALUES ('altas'), ('ventas'), ('devoluciones')) t(concepto)),
     g AS (SELECT ejercicio, CASE WHEN cod_imputacion IN ('signup') THEN 'altas'
                                  WHEN cod_imputacion IN ('purchase') THEN 'ventas'
                                  WHEN cod_imputacion IN ('refund') THEN 'devoluciones' END AS concepto,
                  sum(importe) AS importe
           FROM bank GROUP BY ALL)
SELECT k.ejercicio, l.concepto, CAST(coalesce(g.importe, 0) AS DOUBLE) AS importe
FROM k CROSS JOIN l LEFT JOIN g ON g.ejercicio = k.ejercicio AND g.concepto = l.concepto""")
def a_conditional_rows(spark, d):
    return fin(op.conditional_rows(V(spark, d, "bank"), "cod_imputacion", COND_ROWS, {"importe": "importe"},
                                   keys=["ejercicio"]))


@query("a_having", """
SELECT cuit, CAST(sum(importe) AS DOUBLE) AS importe FROM loads GROUP BY cuit HAVING abs(sum(importe)) > 2500000""")
def a_having(spark, d):
    return fin(op.group_having(V(spark, d, "loads"), ["cuit"], "importe", lambda s: F.abs(s) > 2500000))


@query("u_distinct", "SELECT DISTINCT ejercicio, cta_cte FROM loads")
def u_distinct(spark, d):
    return op.distinct_values(V(spark, d, "loads"), ["ejercicio", "cta_cte"])


@query("a_latest_period", """
SELECT nro_comprobante, mes, CAST(saldo AS DOUBLE) AS saldo FROM snapshots
WHERE strptime(mes, '%m/%Y') = (SELECT max(strptime(mes, '%m/%Y')) FROM snapshots)""")
def a_latest_period(spark, d):
    return fin(op.latest_period(V(spark, d, "snapshots"), "mes").select("nro_comprobante", "mes", "saldo"))


@query("w_latest_snapshot", """
SELECT nro_comprobante, fecha_hasta, CAST(saldo AS DOUBLE) AS saldo FROM snapshots s
WHERE fecha_hasta = (SELECT max(fecha_hasta) FROM snapshots t WHERE t.nro_comprobante = s.nro_comprobante)""")
def w_latest_snapshot(spark, d):
    s = V(spark, d, "snapshots").select("nro_comprobante", "fecha_hasta", "saldo")
    return fin(op.latest_snapshot(s, ["nro_comprobante"], "fecha_hasta"))


@query("w_share", """
WITH g AS (SELECT ejercicio, cta_cte, abs(sum(importe)) AS importe FROM loads GROUP BY ALL)
SELECT ejercicio, cta_cte, CAST(importe AS DOUBLE) AS importe,
       CAST(importe AS DOUBLE) / CAST(sum(importe) OVER (PARTITION BY ejercicio) AS DOUBLE) * 100.0 AS participacion
FROM g""")
def w_share(spark, d):
    g = op.group_sum(V(spark, d, "loads"), ["ejercicio", "cta_cte"], ["importe"])
    return fin(op.share(g, "importe", ["ejercicio"], absolute=True))


@query("w_running_balance", """
WITH dly AS (SELECT cta_cte, fecha, sum(importe) AS v FROM bank GROUP BY ALL),
     cum AS (SELECT cta_cte, fecha, sum(v) OVER (PARTITION BY cta_cte ORDER BY fecha
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS saldo FROM dly),
     lst AS (SELECT ejercicio, mes, cta_cte, max(fecha) AS fecha FROM bank GROUP BY ALL)
SELECT lst.ejercicio, lst.mes, lst.cta_cte, CAST(cum.saldo AS DOUBLE) AS saldo
FROM lst JOIN cum ON lst.cta_cte = cum.cta_cte AND lst.fecha = cum.fecha""")
def w_running_balance(spark, d):
    return fin(op.running_balance(V(spark, d, "bank"), KEYS3))


@query("w_cumulative_diff", """
WITH a AS (SELECT ejercicio, mes, sum(importe) AS ejecutado FROM loads GROUP BY ALL),
     b AS (SELECT ejercicio, mes, sum(importe_bruto) AS pagado FROM payments GROUP BY ALL),
     r AS (SELECT coalesce(a.ejercicio, b.ejercicio) AS ejercicio, coalesce(a.mes, b.mes) AS mes,
                  coalesce(ejecutado, 0) AS ejecutado, coalesce(pagado, 0) AS pagado,
                  coalesce(ejecutado, 0) - coalesce(pagado, 0) AS diferencia
           FROM a FULL JOIN b ON a.ejercicio = b.ejercicio AND a.mes = b.mes)
SELECT ejercicio, mes, CAST(ejecutado AS DOUBLE) AS ejecutado, CAST(pagado AS DOUBLE) AS pagado,
       CAST(diferencia AS DOUBLE) AS diferencia,
       CAST(sum(diferencia) OVER (ORDER BY ejercicio, mes ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DOUBLE) AS dif_acum
FROM r""")
def w_cumulative_diff(spark, d):
    r = op.reconcile(V(spark, d, "loads"), V(spark, d, "payments"), ["ejercicio", "mes"],
                     {"ejecutado": "importe"}, {"pagado": "importe_bruto"})
    # one row per (year, month) after the reconciliation: the window holds months, not movements
    return fin(op.cumulative(r, ["ejercicio", "mes"], "diferencia", out="dif_acum", presummed=True))


@query("w_forward_fill", """
SELECT conv_id, turn, role,
       last_value(heading_turn IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading_turn
FROM headings""")
def w_forward_fill(spark, d):
    return op.forward_fill(V(spark, d, "headings"), ["heading_turn"], "turn", ["conv_id"], block_rows=4)


PAY_COLS = ["nro_comprobante", "ejercicio", "mes", "fecha", "cta_cte", "cuit", "beneficiario", "codigo",
            "importe_bruto", "importe_neto", "retenciones"]
PAY_TIE = " ASC NULLS LAST, ".join(c for c in PAY_COLS if c not in ("nro_comprobante", "fecha")) + " ASC NULLS LAST"


@query("w_dedupe", f"""
SELECT nro_comprobante, ejercicio, mes, fecha, cta_cte, cuit, beneficiario, codigo,
       CAST(importe_bruto AS DOUBLE) AS importe_bruto, CAST(importe_neto AS DOUBLE) AS importe_neto,
       CAST(retenciones AS DOUBLE) AS retenciones
FROM (SELECT *, row_number() OVER (PARTITION BY nro_comprobante ORDER BY fecha ASC NULLS LAST, {PAY_TIE}) AS rn
      FROM payments) WHERE rn = 1""")
def w_dedupe(spark, d):
    p = V(spark, d, "payments").select(*PAY_COLS)
    return fin(op.dedupe(p, ["nro_comprobante"], ["fecha"], "first"))


@query("w_rank", """
WITH g AS (SELECT ejercicio, cta_cte, sum(importe) AS importe FROM loads GROUP BY ALL)
SELECT ejercicio, cta_cte, CAST(importe AS DOUBLE) AS importe,
       CAST(row_number() OVER (PARTITION BY ejercicio ORDER BY abs(importe) DESC, cta_cte) AS BIGINT) AS ranking
FROM g""")
def w_rank(spark, d):
    g = op.group_sum(V(spark, d, "loads"), ["ejercicio", "cta_cte"], ["importe"])
    return fin(op.rank_by(g, "importe", ["ejercicio"], tie_break=["cta_cte"]))


@query("w_rank_lines", """
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DOUBLE) AS importe,
       CAST(row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS BIGINT) AS ranking
FROM lineitem""")
def w_rank_lines(spark, d):
    # every line by amount, no group at all
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("importe"))
    return fin(op.rank_by(li, "importe", tie_break=["l_orderkey", "l_linenumber"]))


@query("w_cumulative_lines", """
SELECT nro_comprobante, codigo, fecha, CAST(importe_bruto AS DOUBLE) AS importe_bruto,
       CAST(sum(importe_bruto) OVER (PARTITION BY codigo ORDER BY fecha) AS DOUBLE) AS acum
FROM payments""")
def w_cumulative_lines(spark, d):
    # running total over raw lines of three large groups; lines of one day share a value
    p = V(spark, d, "payments").select("nro_comprobante", "codigo", "fecha", "importe_bruto")
    return fin(op.cumulative(p, ["fecha"], "importe_bruto", ["codigo"]))


# ---------------------------------------------------------------- top-k

@query("t_top_n", """
SELECT cuit, CAST(sum(importe) AS DOUBLE) AS importe FROM loads GROUP BY cuit
ORDER BY sum(importe) DESC, cuit LIMIT 10""")
def t_top_n(spark, d):
    g = op.group_sum(V(spark, d, "loads"), ["cuit"], ["importe"])
    return fin(op.top_n(g, 10, ["importe", "cuit"], ascending=[False, True]))


@query("t_top_n_other", """
WITH base AS (SELECT cta_cte FROM payments WHERE ejercicio = '1998' AND cta_cte IS NOT NULL GROUP BY cta_cte
              ORDER BY sum(abs(retenciones)) DESC, cta_cte LIMIT 3),
     d AS (SELECT ejercicio, CASE WHEN cta_cte IN (SELECT cta_cte FROM base) THEN cta_cte ELSE 'OT' END AS cta_cte,
                  retenciones FROM payments)
SELECT ejercicio, cta_cte, CAST(sum(retenciones) AS DOUBLE) AS retenciones FROM d
WHERE ejercicio IS NOT NULL GROUP BY ALL""")
def t_top_n_other(spark, d):
    p = V(spark, d, "payments").select("ejercicio", "cta_cte", "retenciones")
    return fin(op.top_n_other(p, 3, "cta_cte", "retenciones", ["ejercicio"],
                              base=p.filter(F.col("ejercicio") == "1998")))


@query("t_recent_years", """
SELECT id, ejercicio, CAST(importe AS DOUBLE) AS importe FROM loads
WHERE ejercicio IN (SELECT DISTINCT ejercicio FROM loads WHERE ejercicio IS NOT NULL
                    ORDER BY CAST(ejercicio AS INTEGER) DESC LIMIT 3)""")
def t_recent_years(spark, d):
    return fin(op.recent_years(V(spark, d, "loads"), 3).select("id", "ejercicio", "importe"))


# ---------------------------------------------------------------- set / reshape

@query("u_union", """
SELECT ejercicio, mes, cta_cte, nro_comprobante, CAST(importe AS DOUBLE) AS importe,
       CAST(NULL AS DOUBLE) AS importe_bruto, CAST(NULL AS VARCHAR) AS codigo FROM loads
UNION ALL
SELECT ejercicio, mes, cta_cte, nro_comprobante, NULL, CAST(importe_bruto AS DOUBLE), codigo FROM payments""")
def u_union(spark, d):
    a = V(spark, d, "loads").select("ejercicio", "mes", "cta_cte", "nro_comprobante", "importe")
    b = V(spark, d, "payments").select("ejercicio", "mes", "cta_cte", "nro_comprobante", "importe_bruto", "codigo")
    return fin(op.union_all(a, b))


@query("u_dedupe_subset", """
SELECT nro_comprobante, mes, cuit, cta_cte, fecha, CAST(importe_bruto AS DOUBLE) AS importe_bruto FROM (
  SELECT *, row_number() OVER (PARTITION BY nro_comprobante, mes, cuit
      ORDER BY fecha ASC NULLS LAST, cta_cte ASC NULLS LAST, importe_bruto ASC NULLS LAST) AS rn
  FROM (SELECT nro_comprobante, mes, cuit, cta_cte, fecha, importe_bruto FROM payments) WHERE cta_cte = 'BUILDING')
WHERE rn = 1
UNION ALL
SELECT nro_comprobante, mes, cuit, cta_cte, fecha, CAST(importe_bruto AS DOUBLE) FROM payments
WHERE cta_cte IS DISTINCT FROM 'BUILDING'""")
def u_dedupe_subset(spark, d):
    p = V(spark, d, "payments").select("nro_comprobante", "mes", "cuit", "cta_cte", "fecha", "importe_bruto")
    return fin(op.dedupe_subset(p, F.col("cta_cte") == "BUILDING", ["nro_comprobante", "mes", "cuit"], ["fecha"]))


@query("u_unpivot", """
WITH g AS (SELECT ejercicio, sum(importe_bruto) AS importe_bruto, sum(importe_neto) AS importe_neto,
                  sum(retenciones) AS retenciones FROM payments GROUP BY 1)
SELECT ejercicio, 'importe_bruto' AS concepto, CAST(importe_bruto AS DOUBLE) AS importe FROM g
UNION ALL SELECT ejercicio, 'importe_neto', CAST(importe_neto AS DOUBLE) FROM g
UNION ALL SELECT ejercicio, 'retenciones', CAST(retenciones AS DOUBLE) FROM g""")
def u_unpivot(spark, d):
    g = op.group_sum(V(spark, d, "payments"), ["ejercicio"], ["importe_bruto", "importe_neto", "retenciones"])
    return op.unpivot(g, ["ejercicio"], ["importe_bruto", "importe_neto", "retenciones"], cast="double")


# ---------------------------------------------------------------- scalar functions

@query("f_scalars", """
SELECT id,
       substr(mes, 1, 2) AS mes_num,
       right(mes, 4) AS anio,
       cta_cte || '-' || fuente AS cta_fuente,
       CASE WHEN length(id) >= 5 THEN id ELSE lpad(id, 5, '0') END AS nro_zfill,
       CASE WHEN length(id) >= 5 THEN id ELSE lpad(id, 5, '0') END || '/' || substr(ejercicio, 3, 2) AS nro_comprobante,
       CAST(CAST(split_part(
           CASE WHEN length(id) >= 5 THEN id ELSE lpad(id, 5, '0') END || '/' || substr(ejercicio, 3, 2), '/', 1)
           AS INTEGER) AS VARCHAR) AS nro_entero,
       trim(regexp_replace('12-34 ' || cta_cte || ' ', '^\\d+-\\d+', '')) AS sin_codigo,
       coalesce(regexp_matches(substr(id, 1, 3), '^[0-9]{1,3}$'), false) AS es_numerico,
       coalesce(NULLIF(tipo, 'CYO'), '') AS tipo_vacio,
       CAST(fecha + INTERVAL 1 MONTH AS DATE) AS fecha_mas_mes,
       strftime(CAST(fecha + INTERVAL 1 MONTH AS DATE), '%m/%Y') AS mes_siguiente,
       CAST(strptime(mes, '%m/%Y') AS DATE) AS inicio_mes,
       CAST(CAST(ejercicio AS INTEGER) - 1 AS VARCHAR) AS ejercicio_anterior,
       CAST(abs(importe - 150000) AS DOUBLE) AS desvio,
       abs(importe - importe) <= 1e-8 AS es_cero,
       (tipo = 'PA6') OR (fuente = '11') AS alguna_marca
FROM loads""")
def f_scalars(spark, d):
    ld = V(spark, d, "loads")
    nro = sc.voucher_number("id", "ejercicio")
    return fin(ld.select(
        "id",
        F.substring("mes", 1, 2).alias("mes_num"),
        sc.year_from_month("mes").alias("anio"),
        F.concat("cta_cte", F.lit("-"), "fuente").alias("cta_fuente"),
        sc.zfill("id").alias("nro_zfill"),
        nro.alias("nro_comprobante"),
        sc.voucher_int_text(nro).alias("nro_entero"),
        sc.strip_code_prefix(F.concat(F.lit("12-34 "), "cta_cte", F.lit(" "))).alias("sin_codigo"),
        sc.is_numeric_prefix("id").alias("es_numerico"),
        F.coalesce(F.nullif("tipo", F.lit("CYO")), F.lit("")).alias("tipo_vacio"),
        sc.add_one_month("fecha").alias("fecha_mas_mes"),
        sc.month_of(sc.add_one_month("fecha")).alias("mes_siguiente"),
        sc.month_start("mes").alias("inicio_mes"),
        sc.shift_year("ejercicio", -1).alias("ejercicio_anterior"),
        F.abs(F.col("importe") - F.lit(150000)).alias("desvio"),
        sc.near_zero(F.col("importe") - F.col("importe")).alias("es_cero"),
        sc.any_flag(F.col("tipo") == "PA6", F.col("fuente") == "11").alias("alguna_marca"),
    ))
