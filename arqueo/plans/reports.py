"""Report runs that write several result tables (K-01) from shared inputs.

An intermediate used by more than one control (the netted ledger) is written
once under the shared checkpoint folder (``spark.checkpoint.dir``) and read
back: the controls then start from files, which also cuts the lineage, so a
lost executor re-reads those files instead of recomputing the netting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import net_pending
from ..session import materialize
from ..sources.io import write_tables
from . import controls


def works_controls(loads: DataFrame, snapshots: DataFrame, renditions: DataFrame, out_path: str,
                   years: Sequence[str] | None = None, keys: Sequence[str] = controls.KEYS3, **net_kw) -> dict:
    """D-CO1 and D-CO4 from one netted ledger; writes both tables, returns their paths."""
    net = materialize(net_pending(loads, snapshots, years=years, **net_kw), "netted-loads")
    tables = {
        "control_cruzado": controls.works_vs_paid(net, renditions, keys),
        "control_completo": controls.works_vs_paid_detail(
            net.select(*keys, "id", "tipo", "importe"),
            renditions.select(*keys, "nro_comprobante", "importe_bruto"), keys),
    }
    return write_tables(tables, out_path)


def remainder_report(budget: DataFrame, descriptions: DataFrame, bank_final: DataFrame, snapshots: DataFrame,
                     treasury: DataFrame, revenue: DataFrame, year: str, out_path: str) -> dict:
    """The remainder export (D-RM1..5, D-NET4, D-NET5, bank year-end balances), one table each."""
    from . import remainder
    from .. import operators as op
    debt = materialize(remainder.latest_debt(snapshots, year), "latest-debt")
    budget_y = op.years(budget, year)
    m1 = remainder.method_1(op.years(bank_final, year), debt)
    m2 = remainder.method_2(op.years(revenue, year), budget_y)
    tables = {
        "hoja_trabajo": remainder.worksheet(budget_y, descriptions),
        "rem_met_1": m1,
        "rem_met_2": m2,
        "rem_met_2_hist": remainder.method_2_history(revenue, budget),
        "rem_dif_met": remainder.methods_compared(m1, m2),
        "rdeu": debt,
        "rdeu_tg": remainder.treasury_debt(treasury, year),
        "sld_bco_cierre": op.years(bank_final, year),
    }
    return write_tables(tables, out_path)


def works_execution_report(budget: DataFrame, ledger_desc: DataFrame, works_desc: DataFrame, loads: DataFrame,
                           suppliers: DataFrame, works: DataFrame, year: str, out_path: str,
                           opening: DataFrame | None = None, last_n: int = 5, date_up_to=None) -> dict:
    """The works-execution export (D-EO1, D-EO2, D-EO5, D-EO6, D-EO7): current
    execution with both description sources, the works ledger (by activity and
    by work), the accounting summary as of each of the last years, and the
    basic-module reports by agreement and by year."""
    from . import sources_clean, works as w
    from .. import operators as op
    accrual = materialize(sources_clean.loads_with_descriptions(loads, works_desc, suppliers, up_to_year=year,
                                                               siif_desc=False), "works-loads")
    bm = sources_clean.basic_module_loads(loads, works, works_desc, suppliers, up_to_year=year, siif_desc=False)
    current = sources_clean.works_execution(budget, ledger_desc, current_only=year)
    tables = {
        "ejecucion_siif": current,
        "ejecucion_siif_desc_icaro": sources_clean.works_execution_icaro_desc(budget, works_desc, years=year),
        "planillometro": w.works_ledger_report(accrual, year),
        "planillometro_full": w.works_ledger_report(accrual, year, full=True),
        "planillometro_resumido": w.works_ledger_for_accounting(
            accrual, [c for c in ("desc_prog", "desc_proy", "desc_act", "actividad", "partida") if c in accrual.columns],
            last_n=last_n, date_up_to=date_up_to, opening=opening),
        "mod_basicos_siif": op.prefix_filter(current, "estructura", prefix="29"),
        "mod_basicos_por_convenio": w.basic_module_report(bm, year, by_agreement=True),
        "mod_basicos_por_ejercicio": w.basic_module_report(bm, year, by_agreement=False),
    }
    return write_tables(tables, out_path)
