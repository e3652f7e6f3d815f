"""Cross-system controls (D-CO*, D-HB1, D-SG1, D-CR*, D-IV*, D-CH*, D-RT*, ...).

Each control is a plain function of DataFrames and parameters.  Grouping keys
are free (``keys``), as in the original ``groupby_cols`` arguments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import operators as op
from ..session import materialize
from ..functions import codes as K
from ..functions.nulls import contains_any, not_in_keep_null

KEYS3 = ("ejercicio", "mes", "cta_cte")


def works_vs_paid(net_loads: DataFrame, renditions: DataFrame, keys: Sequence[str] = KEYS3) -> DataFrame:
    """D-CO1: works executed (loads net of floating debt) vs paid gross, full outer, difference."""
    return op.reconcile(net_loads, renditions, keys, {"ejecutado_icaro": "importe"}, {"bruto_sgf": "importe_bruto"})


def works_renditions(renditions: DataFrame, exclude_origin: str = "FUNCIONAMIENTO", epam_origin: str = "EPAM",
                     fee_words: Sequence[str] = ("HONORARIOS",)) -> DataFrame:
    """D-SRC12: renditions for the works control: not operating expenses; EPAM rows without fee text."""
    r = renditions.filter(not_in_keep_null("origen", [exclude_origin]))
    epam = r.filter(F.col("origen") == epam_origin).filter(~contains_any("destino", fee_words))
    return op.union_all(r.filter(not_in_keep_null("origen", [epam_origin])), epam)


def works_vs_paid_detail(loads: DataFrame, renditions: DataFrame, keys: Sequence[str] = KEYS3) -> DataFrame:
    """D-CO4 (re-aimed, see J-16): line detail of both systems with group totals.

    Both sides are needed twice (lines and totals) and the loads are usually
    netted: each is written once to the shared folder and read from there.
    """
    return op.full_detail(materialize(loads, "loads"), materialize(renditions, "renditions"), keys,
                          "importe", "importe_bruto", "icaro_", "sgf_")


def payroll_vs_paid(net_vouchers: DataFrame, bank_payroll: DataFrame, keys: Sequence[str] = ("ejercicio", "mes")
                    ) -> DataFrame:
    """D-HB1: payroll executed vs paid by month, with the running difference."""
    r = op.reconcile(net_vouchers, bank_payroll, keys, {"ejecutado_siif": "importe"}, {"pagado_sscc": "importe"})
    # one row per (year, month) after the reconciliation: the window holds months, not movements
    return op.cumulative(r, list(keys), "diferencia", out="dif_acum", presummed=True)


def bank_payroll(bank: DataFrame, account: str = K.PAYROLL_ACCOUNT) -> DataFrame:
    """D-SRC4: payroll bank payments: not deposits, one account, no income-tax text,
    sign flipped, minus internal transfers and other codes."""
    b = bank.filter(not_in_keep_null("movimiento", [K.DEPOSIT])).filter(F.col("cta_cte") == account)
    b = b.filter(~contains_any("concepto", K.INCOME_TAX_WORDS))
    b = op.negate(b, "importe")
    return op.codes(b, "cod_imputacion", exclude=K.DEPOSIT_INTERNAL_TRANSFER + K.DEPOSIT_OTHER)


def payments_vs_bank(renditions: DataFrame, bank: DataFrame, keys: Sequence[str] = ("mes", "cta_cte"),
                     tol: float = 0.1, debit_code: str = K.BANK_DEBIT_CODE) -> DataFrame:
    """D-SG1: net + withholdings - bank debits (bank without deposits and code 031); keep |d| >= tol."""
    b = op.negate(bank.filter(not_in_keep_null("movimiento", [K.DEPOSIT])), "importe")
    b = b.filter(not_in_keep_null("cod_imputacion", [debit_code]))
    r = op.reconcile(renditions, b, keys, {"neto_sgf": "importe_neto", "retenciones_sgf": "retenciones"},
                     {"debitos_sscc": "importe"})
    return op.beyond(r, "diferencia", tol, strict=False)


def revenue_deposits(bank: DataFrame, parity: bool = False) -> DataFrame:
    """D-SRC3: bank deposits that count as revenue, with their fund group."""
    b = bank.filter(F.col("movimiento") == K.DEPOSIT)
    b = op.codes(b, "cod_imputacion", exclude=K.non_revenue_deposits(parity))
    return b.withColumn("grupo", fund_group("cta_cte"))


def receivable_deposits(bank: DataFrame, parity: bool = False) -> DataFrame:
    """D-SRC3, receivables version: revenue deposits of the recovery group only."""
    return revenue_deposits(bank, parity).filter(F.col("grupo") == K.FUND_GROUP_LABELS[1])


def fund_group(c: str):
    fon, rec, other = K.FUND_GROUP_LABELS
    return (F.when(F.col(c) == K.FUND_GROUP_FONAVI_ACCOUNT, fon)
            .when(F.col(c).isin(K.FUND_GROUP_RECOVERY_ACCOUNTS), rec).otherwise(other))


def verified_revenue(revenue: DataFrame) -> DataFrame:
    """D-SRC6: verified revenue; text MACRO moves it to the Macro account; fund group."""
    r = revenue.filter(F.col("es_verificado") == F.lit(True))
    r = op.overwrite(r, contains_any("glosa", ["MACRO"]), "cta_cte", "Macro")
    return r.withColumn("grupo", fund_group("cta_cte"))


def _third_party_revenue(revenue: DataFrame) -> DataFrame:
    """Revenue that is neither own funds nor carried over (flags must be False)."""
    return revenue.filter((F.col("es_propio") == F.lit(False)) & (F.col("es_remanente") == F.lit(False)))


def revenue_vs_deposits(revenue: DataFrame, deposits: DataFrame, keys: Sequence[str] = KEYS3) -> DataFrame:
    """D-CR1: verified revenue without own and carried-over funds vs revenue
    deposits, on the union of keys, ``diferencia`` = revenue - deposits."""
    return op.reconcile(_third_party_revenue(revenue), deposits, keys, {"recursos_siif": "importe"},
                        {"depositos_sscc": "importe"})


VOUCHER_ATTRS = ("tipo", "fuente", "mes", "cta_cte", "cuit", "partida")


def _first_attrs(attrs: Sequence[str], when=None):
    """The first row's attributes (ascending, NULLs last), as a struct to aggregate with ``min``."""
    s = F.struct(*[e for a in attrs for e in (F.col(a).isNull().alias(f"n_{a}"), F.col(a).alias(a))])
    return F.min(s if when is None else F.when(when, s))


def voucher_control(ledger: DataFrame, loads: DataFrame, tol: float = 0.1,
                    attrs: Sequence[str] = VOUCHER_ATTRS) -> DataFrame:
    """D-IV2: ledger vouchers vs works loads by (year, voucher), line against line.

    Ledger: a regularisation (``REG``) without fund number counts as ``CYO``.
    Loads: advances (``PA6``) are left out.  Both sides are summed per (year,
    voucher, budget line); lines present on both sides face each other, the
    others of a voucher are paired in order of line, and what is left stands
    alone.  It is all aggregation: no line is joined to another.  A flag is
    raised for every attribute present on both sides that differs (NULL on
    either side counts), and for amounts (missing = 0) more than ``tol``
    apart; rows with any flag are kept.  A line of NULL and a line of '' are two
    lines.
    """
    lg = ledger
    if "clase_reg" in lg.columns:
        fondo = F.col("nro_fondo").isNull() if "nro_fondo" in lg.columns else F.lit(True)
        lg = lg.withColumn("tipo", F.when((F.col("clase_reg") == K.WORKS_REGULARISATION_TYPE) & fondo,
                                          F.lit("CYO")).otherwise(F.col("clase_reg")))
    ic = loads.filter(not_in_keep_null("tipo", [K.WORKS_ADVANCE_TYPE]))
    la, ia = ([a for a in attrs if a in d.columns] for d in (lg, ic))
    # the number first: where sorts compare years first, most comparisons go on to the number
    voucher = ["nro_comprobante", "ejercicio"]

    def side(d: DataFrame, name: str, own: Sequence[str]) -> DataFrame:
        line = F.col("partida").cast("string") if "partida" in d.columns else F.lit(None).cast("string")
        d = d.select(*voucher, line.alias("_line"), F.lit(name).alias("_side"), F.col("importe").alias("importe"),
                     *[F.col(a).cast("string").alias(a) for a in own])
        return d

    lines = op.union_all(side(lg, "siif", la), side(ic, "icaro", ia))
    every = [a for a in attrs if a in la or a in ia]

    def both(per: dict) -> list:
        return [f(name, F.col("_side") == name).alias(f"{name}_{out}") for name in ("siif", "icaro")
                for out, f in per.items()]

    per_line = {"n": lambda s, w: F.count(F.when(w, 1)), "importe": lambda s, w: F.sum(F.when(w, F.col("importe"))),
                "a": lambda s, w: _first_attrs(every, w)}
    by_line = lines.groupBy(*voucher, "_line").agg(*both(per_line))
    # lines of one side only are numbered inside their voucher and side, so that they pair off in order
    alone = F.when(F.col("siif_n") == 0, F.lit("icaro")).when(F.col("icaro_n") == 0, F.lit("siif")).otherwise(F.lit("both"))
    # one exchange of the summed lines by voucher serves the numbering and the pairing
    by_line = by_line.withColumn("_alone", alone).repartition(*voucher)
    rank = F.row_number().over(Window.partitionBy(*voucher, "_alone").orderBy("_line"))

    def slot(number, no_line, line):
        return F.struct(number.cast("int").alias("number"), no_line.alias("no_line"), line.alias("line"))

    by_line = by_line.withColumn("_slot", F.when(F.col("_alone") == "both", slot(F.lit(0), F.col("_line").isNull(), F.coalesce("_line", F.lit(""))))
                                 .otherwise(slot(rank, F.lit(False), F.lit(""))))
    m = by_line.groupBy(*voucher, "_slot").agg(*[f(f"{n}_{c}").alias(f"{n}_{c}") for n in ("siif", "icaro")
                                                 for c, f in (("n", F.sum), ("importe", F.sum), ("a", F.min))])
    out = m.select("ejercicio", *[x for n, own in (("siif", la), ("icaro", ia)) for x in (
        F.when(F.col(f"{n}_n") > 0, F.col("nro_comprobante")).alias(f"{n}_nro"),
        F.coalesce(F.col(f"{n}_importe"), F.lit(0)).alias(f"{n}_importe"),
        *[F.col(f"{n}_a").getField(a).alias(f"{n}_{a}") for a in own])])
    pairs = {"err_nro": ("siif_nro", "icaro_nro")}
    pairs.update({f"err_{a}": (f"siif_{a}", f"icaro_{a}") for a in attrs if a in la and a in ia})
    pairs["err_importe"] = ("siif_importe", "icaro_importe", tol)
    return op.flag_mismatch(out, pairs)


def revenue_vs_deposits_by_group(revenue: DataFrame, deposits: DataFrame,
                                 keys: Sequence[str] = ("ejercicio", "mes", "cta_cte", "grupo")) -> DataFrame:
    """D-CR2: revenue vs deposits with the fund group; natural full outer on the
    keys, gaps left NULL, no difference column."""
    a = op.group_sum(_third_party_revenue(revenue), keys, {"recursos_siif": "importe"})
    b = op.group_sum(deposits, keys, {"depositos_banco": "importe"})
    return op.concat_columns({"siif": a, "banco": b}, list(keys))


def ledger_works_budget(budget: DataFrame, lines: Sequence[str] = ("421", "422"),
                        structure: str = "01-00-00-03-354") -> DataFrame:
    """D-SRC8: works budget of the ledger: lines 421/422 or one structure."""
    return budget.filter(F.col("partida").isin(list(lines)) | F.coalesce(F.col("estructura") == structure,
                                                                         F.lit(False)))


# FIXED VALUES: tax ids whose line-354 vouchers are not works.
LINE_354_SKIP_CUITS = ["30500049460", "30632351514", "20231243527"]


def ledger_works_vouchers(vouchers: DataFrame, lines: Sequence[str] = ("421", "422"), line_354: str = "354",
                          skip_cuits: Sequence[str] = tuple(LINE_354_SKIP_CUITS)) -> DataFrame:
    """D-SRC7: works vouchers of the ledger: lines 421/422, or 354 except some tax ids."""
    w = F.col("partida").isin(list(lines))
    o = (F.col("partida") == line_354) & not_in_keep_null("cuit", list(skip_cuits))
    return vouchers.filter(F.coalesce(w | o, F.lit(False)))


def yearly_execution(budget: DataFrame, loads: DataFrame, keys: Sequence[str] = ("ejercicio", "estructura", "fuente"),
                     tol: float = 0.1, descriptions: DataFrame | None = None) -> DataFrame:
    """D-IV1: budget executed (ordered, D-SRC8 lines) vs works loads without
    advances, by year, structure (activity-line) and fund; full outer,
    |difference| > tol, with descriptions."""
    ld = loads.filter(not_in_keep_null("tipo", [K.WORKS_ADVANCE_TYPE])) if "tipo" in loads.columns else loads
    if "estructura" not in ld.columns:
        ld = ld.withColumn("estructura", F.concat(F.col("actividad"), F.lit("-"), F.col("partida")))
    r = op.reconcile(budget, ld, list(keys), {"ejecucion_siif": "ordenado"}, {"ejecucion_icaro": "importe"})
    r = op.beyond(r, "diferencia", tol)
    if descriptions is not None:
        r = op.enrich(r, descriptions, "estructura")
    return r


def advances_control(fund_summary: DataFrame, vouchers: DataFrame, loads: DataFrame, tol: float = 0.1,
                     rank: str | None = None) -> DataFrame:
    """D-IV3: contractor advances (fund summary) with their regularisation
    vouchers, against advance loads and regularisation loads.

    funds LEFT JOIN ledger REG vouchers (year, fund number) FULL JOIN advance
    loads (fund number) LEFT JOIN regularisation loads (year, voucher).  Ledger
    lines and load lines are both summed per voucher first, so like faces like.
    Missing values compare equal (the original filled everything with 0);
    amounts differ beyond ``tol``.  Sorted by severity of the flags; ``rank``
    names a column for a row's place in that order (1 + rows more severe).
    """
    from ..functions.scalars import voucher_number
    f = fund_summary.select("ejercicio", voucher_number("nro_fondo", "ejercicio").alias("siif_nro_fondo"),
                            F.col("mes").alias("siif_mes_pa6"), F.col("ingresos").alias("siif_importe_pa6"),
                            F.col("saldo").alias("siif_saldo_pa6"))
    ga = ("mes", "clase_reg", "fuente", "cta_cte", "cuit")
    g = vouchers.filter(F.col("clase_reg") == K.WORKS_REGULARISATION_TYPE).groupBy(
        "ejercicio", voucher_number("nro_fondo", "ejercicio").alias("siif_nro_fondo"),
        F.col("nro_comprobante").alias("siif_nro_reg")).agg(F.sum("importe").alias("siif_importe_reg"),
                                                            _first_attrs(ga).alias("_g"))
    g = g.select("ejercicio", "siif_nro_fondo", "siif_nro_reg", "siif_importe_reg",
                 *[F.col("_g").getField(c).alias(n) for c, n in zip(ga, (
                     "siif_mes_reg", "siif_tipo", "siif_fuente", "siif_cta_cte", "siif_cuit"))])
    df = f.join(g, on=["ejercicio", "siif_nro_fondo"], how="left")
    pa6 = loads.filter(F.col("tipo") == K.WORKS_ADVANCE_TYPE).groupBy("nro_comprobante").agg(
        F.min("mes").alias("icaro_mes_pa6"), F.sum("importe").alias("icaro_importe_pa6")) \
        .withColumnRenamed("nro_comprobante", "icaro_nro_fondo")
    df = df.join(pa6, df["siif_nro_fondo"] == pa6["icaro_nro_fondo"], "full")
    first = F.struct(*[F.col(c) for c in ("mes", "tipo", "fuente", "cta_cte", "cuit")])
    reg = loads.filter(not_in_keep_null("tipo", [K.WORKS_ADVANCE_TYPE])).groupBy(
        F.col("ejercicio").alias("_rej"), F.col("nro_comprobante").alias("icaro_nro_reg")).agg(
        F.sum("importe").alias("icaro_importe_reg"), F.min(first).alias("_a"))
    reg = reg.select("_rej", "icaro_nro_reg", "icaro_importe_reg",
                     *[F.col("_a").getField(c).alias(n) for c, n in (("mes", "icaro_mes_reg"), ("tipo", "icaro_tipo"),
                                                                   ("fuente", "icaro_fuente"),
                                                                   ("cta_cte", "icaro_cta_cte"),
                                                                   ("cuit", "icaro_cuit"))])
    df = df.join(reg, (df["ejercicio"] == reg["_rej"]) & (df["siif_nro_reg"] == reg["icaro_nro_reg"]), "left") \
        .drop("_rej")
    df = op.fill0(df, ["siif_importe_pa6", "icaro_importe_pa6", "siif_importe_reg", "icaro_importe_reg"])
    pairs = {
        "err_nro_fondo": ("siif_nro_fondo", "icaro_nro_fondo"), "err_mes_pa6": ("siif_mes_pa6", "icaro_mes_pa6"),
        "err_importe_pa6": ("siif_importe_pa6", "icaro_importe_pa6", tol),
        "err_nro_reg": ("siif_nro_reg", "icaro_nro_reg"), "err_mes_reg": ("siif_mes_reg", "icaro_mes_reg"),
        "err_importe_reg": ("siif_importe_reg", "icaro_importe_reg", tol),
        "err_tipo": ("siif_tipo", "icaro_tipo"), "err_fuente": ("siif_fuente", "icaro_fuente"),
        "err_cta_cte": ("siif_cta_cte", "icaro_cta_cte"), "err_cuit": ("siif_cuit", "icaro_cuit")}
    out = op.flag_mismatch(df, pairs, null_policy="equal")
    order = ["err_nro_fondo", "err_importe_pa6", "err_nro_reg", "err_importe_reg", "err_fuente", "err_cta_cte",
             "err_cuit", "err_tipo", "err_mes_pa6", "err_mes_reg"]
    if rank is not None:
        out = op.severity_rank(out, order, rank)
    return out.orderBy(*[F.col(c).desc() for c in order])


def works_list(works: DataFrame) -> DataFrame:
    """D-CO2: works list with the name without its leading numeric code
    (``obra_sin_cod``) and ``imputacion`` = activity-line, both in front."""
    w = works.drop("id") if "id" in works.columns else works
    w = w.withColumns({"obra_sin_cod": F.ltrim(F.regexp_replace("obra", r"^\d+-\d+", "")),
                       "imputacion": F.concat(F.col("actividad"), F.lit("-"), F.col("partida"))})
    return op.front(w, ["obra_sin_cod", "imputacion"])


def works_crosswalk(works: DataFrame, register: DataFrame, name_len: int = 85) -> tuple[DataFrame, DataFrame]:
    """D-CO3: works list <-> works register by name, both directions.

    Names are compared without the leading code, cut to 85 characters and
    trimmed.  For ``29-`` imputations whose name starts with digits, the first
    three characters are the register code.  Each side keeps one row per name
    (the first), so a repeated name cannot multiply rows.
    """
    from ..functions.scalars import is_numeric_prefix
    w = works.drop("id") if "id" in works.columns else works
    w = w.withColumns({"obra": F.ltrim(F.regexp_replace("obra", r"^\d+-\d+", "")),
                       "imputacion": F.concat(F.col("actividad"), F.lit("-"), F.col("partida"))})
    w = w.withColumn("obra", F.trim(F.substring("obra", 1, name_len)))
    r = register.withColumn("obra", F.trim(F.substring("obra", 1, name_len)))
    reg_keys = op.dedupe(r.select("obra", "cod_obra"), ["obra"], ["cod_obra"], "first")
    w2 = w.join(reg_keys, on="obra", how="left")
    coded = F.coalesce(F.col("imputacion").startswith("29-"), F.lit(False)) & is_numeric_prefix("obra")
    w2 = op.front(op.overwrite(w2, coded, "cod_obra", F.substring("obra", 1, 3)), ["cod_obra"])
    imp = op.dedupe(w.select("obra", "imputacion"), ["obra"], ["imputacion"], "first")
    r2 = op.front(r.join(imp, on="obra", how="left"), ["imputacion"])
    return w2, r2
