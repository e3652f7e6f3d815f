"""Explicit schemas of the accounting sources (enforced at read time).

Money is DECIMAL(18,2); codes, fiscal years and months ('MM/YYYY') are text.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, DT, B, DB, I = (T.StringType(), T.DecimalType(18, 2), T.DateType(), T.BooleanType(),
                      T.DoubleType(), T.IntegerType())


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def _strings(*names: str) -> list[tuple[str, T.DataType]]:
    return [(n, S) for n in names]


def _money(*names: str) -> list[tuple[str, T.DataType]]:
    return [(n, D) for n in names]


SCHEMAS: dict[str, T.StructType] = {
    "account_map": _schema(*_strings("map_to", "icaro_cta_cte", "siif_contabilidad_cta_cte", "siif_gastos_cta_cte",
                                     "siif_recursos_cta_cte", "sgf_cta_cte", "sscc_cta_cte")),
    "imputation_codes": _schema(*_strings("cod_imputacion", "tipo")),
    "bank": _schema(*_strings("ejercicio", "mes"), ("fecha", DT),
                    *_strings("cta_cte", "movimiento", "beneficiario", "concepto", "moneda", "libramiento",
                              "cod_imputacion", "imputacion"), ("es_cheque", B), ("importe", D)),
    "bank_final_balance": _schema(*_strings("ejercicio", "cta_cte"), ("saldo", D)),
    "fees": _schema(*_strings("id", "ejercicio", "mes", "nro_comprobante", "razon_social"),
                    *_money("importe_bruto", "iibb", "sellos", "lp", "seguro", "otras_retenciones", "anticipo",
                            "descuento", "embargo", "mutual")),
    "programs": _schema(*_strings("programa", "desc_prog")),
    "subprograms": _schema(*_strings("subprograma", "programa", "desc_subprog")),
    "projects": _schema(*_strings("proyecto", "subprograma", "desc_proy")),
    "activities": _schema(*_strings("actividad", "proyecto", "desc_act")),
    "works_loads": _schema(*_strings("id", "ejercicio", "nro_comprobante", "tipo", "fuente", "mes", "cta_cte", "cuit",
                                     "actividad", "partida", "certificado", "origen", "obra"), ("fecha", DT),
                           ("importe", D), ("fondo_reparo", D), ("avance", DB)),
    "works_list": _schema(*_strings("id", "obra", "actividad", "partida", "localidad", "norma_legal",
                                    "info_adicional")),
    "works_withholdings": _schema(*_strings("id_carga", "codigo"), ("importe", D)),
    "suppliers": _schema(*_strings("cuit", "desc_prov")),
    "floating_debt": _schema(*_strings("ejercicio", "nro_comprobante", "nro_origen", "mes", "mes_hasta", "fuente",
                                       "cta_cte", "cuit", "org_fin", "glosa", "nro_expte"),
                             ("fecha", DT), ("fecha_desde", DT), ("fecha_hasta", DT), ("fecha_aprobado", DT),
                             ("saldo", D)),
    "budget": _schema(*_strings("ejercicio", "estructura", "programa", "subprograma", "proyecto", "actividad",
                                "grupo", "partida", "fuente", "org"),
                      *_money("credito_original", "credito_vigente", "comprometido", "ordenado", "saldo",
                              "pendiente")),
    "structure_desc": _schema(*_strings("ejercicio", "estructura", "programa", "subprograma", "proyecto", "actividad",
                                        "desc_prog", "desc_subprog", "desc_proy", "desc_act")),
    "fund_summary": _schema(*_strings("ejercicio", "mes", "nro_fondo", "tipo_comprobante"),
                            *_money("ingresos", "egresos", "saldo")),
    "expense_vouchers": _schema(*_strings("ejercicio", "mes", "nro_comprobante", "grupo", "partida", "nro_entrada",
                                          "nro_origen", "nro_expte", "glosa", "beneficiario", "nro_fondo", "fuente",
                                          "cta_cte", "cuit", "clase_reg", "clase_mod", "clase_gto"),
                                ("fecha", DT), ("importe", D), ("es_comprometido", B), ("es_verificado", B),
                                ("es_aprobado", B), ("es_pagado", B)),
    "revenue_vouchers": _schema(*_strings("ejercicio", "mes", "fuente", "cta_cte", "glosa"), ("importe", D),
                                ("es_propio", B), ("es_remanente", B), ("es_verificado", B)),
    "ledger": _schema(*_strings("ejercicio", "mes", "cta_contable", "tipo_comprobante", "nro_entrada", "nro_original",
                                "auxiliar_1", "auxiliar_2"), ("fecha", DT), ("fecha_aprobado", DT),
                      *_money("debitos", "creditos", "saldo")),
    "renditions": _schema(*_strings("ejercicio", "mes", "origen", "beneficiario", "destino", "cta_cte",
                                    "libramiento_sgf", "movimiento", "cuit"), ("fecha", DT),
                          *_money("importe_bruto", "gcias", "sellos", "iibb", "suss", "propia", "seguro", "salud",
                                  "mutual", "otras", "retenciones", "importe_neto")),
    "new_neighbourhoods": _schema(*_strings("ejercicio", "cod_barrio"), ("importe_total", D)),
    "billed": _schema(("ejercicio", S), ("facturado_total", D)),
    "collected": _schema(*_strings("ejercicio", "mes"),
                         *_money("amortizacion", "int_financiero", "int_mora", "gtos_adm", "seg_incendio", "seg_vida",
                                 "subsidio", "pago_amigable", "escritura", "pend_acreditacion", "recaudado_total")),
    "balance_variation": _schema(*_strings("ejercicio", "barrio"),
                                 *_money("saldo_inicial", "amortizacion", "cambios", "saldo_final")),
    "neighbourhood_balance": _schema(*_strings("ejercicio", "barrio"), ("saldo_actual", D)),
    "receivable_variation": _schema(*_strings("ejercicio", "concepto"), ("importe", D)),
    "reason_neighbourhood_balance": _schema(*_strings("ejercicio", "cod_barrio", "cod_motivo"), ("importe", D)),
    "reason_balance": _schema(*_strings("ejercicio", "cod_motivo", "motivo"), ("importe", D)),
    "works_register": _schema(*_strings("cod_obra", "obra", "contratista", "localidad", "tipo_obra", "operatoria",
                                        "nro_ultimo_certif", "mes_obra_certif"), ("fecha_inicio", DT),
                              ("fecha_fin", DT), ("avance_fis_real", DB), ("monto_pagado", D)),
    "opening_2008": _schema(("row_no", I), *_strings("prog", "subprog", "proy", "obra", "descripcion", "estructura",
                                                     "actividad", "partida", "alta"), ("acum_2008", D)),
}
