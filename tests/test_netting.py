from __future__ import annotations

from pyspark.sql import functions as F

from arqueo import operators as op
from conftest import D, day, rows

LOADS = "id string, ejercicio string, nro_comprobante string, tipo string, fuente string, mes string, " \
        "cta_cte string, cuit string, actividad string, partida string, fecha date, importe decimal(18,2)"
SNAPS = "ejercicio string, nro_comprobante string, mes string, fuente string, cta_cte string, cuit string, " \
        "fecha_hasta date, saldo decimal(18,2)"


def _data(spark):
    loads = spark.createDataFrame([
        # voucher accrued in Dec 2023, unpaid at year end, paid in Jan 2024
        ("L1", "2023", "00001/23", "CYO", "11", "12/2023", "c1", "p1", "29-01", "422", day("2023-12-10"), D(100)),
        # voucher with two load lines (the balance repeats on each line)
        ("L2", "2024", "00002/24", "CYO", "11", "01/2024", "c1", "p2", "29-02", "422", day("2024-01-05"), D(60)),
        ("L3", "2024", "00002/24", "CYO", "11", "01/2024", "c1", "p2", "29-03", "422", day("2024-01-05"), D(40)),
        ("L4", "2024", "00003/24", "PA6", "11", "02/2024", "c1", "p3", "29-04", "422", day("2024-02-01"), D(7)),
        ("L5", "2024", "00004/24", "REG", "11", "02/2024", "c1", "p3", "29-04", "422", day("2024-02-01"), D(9)),
    ], LOADS)
    snaps = spark.createDataFrame([
        ("2023", "00001/23", "12/2023", "11", "c1", "p1", day("2023-12-31"), D(100)),
        ("2023", "00001/23", "12/2023", "11", "c1", "p1", day("2023-12-15"), D(80)),   # earlier in the month
        ("2024", "00002/24", "01/2024", "11", "c1", "p2", day("2024-01-31"), D(100)),  # 31 Jan snapshot
    ], SNAPS)
    return loads, snaps


def test_net_pending_steps(spark):
    loads, snaps = _data(spark)
    net = op.net_pending(loads, snaps, years=["2023", "2024"])
    got = rows(net, "id", "tipo", "mes", "importe")
    assert ("L1", "CYO", "12/2023", D(100)) in got
    # step 2: earliest snapshot of the month (80) nets the accrual
    assert ("L1", "RDEU", "12/2023", D(-80)) in got
    # step 4: paid one month after the last snapshot; the 31 Jan snapshot moves to 29 Feb
    pos = net.filter(F.col("id") == "00002/24C").collect()
    assert len(pos) == 2 and {r.fecha for r in pos} == {day("2024-02-29")} and {r.mes for r in pos} == {"02/2024"}
    assert {r.actividad for r in pos} == {"29-02", "29-03"}  # balance repeated per load line (original result)
    assert ("L4", "PA6", "02/2024", D(7)) in got
    assert not [g for g in got if g[0] == "L5"]  # regularisations are dropped
    # voucher 1 paid in Jan 2024 with its last balance (100)
    assert rows(net.filter(F.col("id") == "00001/23C"), "ejercicio", "mes", "importe") == [("2024", "01/2024", D(100))]


def test_net_pending_allocate_first(spark):
    loads, snaps = _data(spark)
    net = op.net_pending(loads, snaps, years=["2024"], allocate="first")
    assert net.filter(F.col("id") == "00002/24C").count() == 1


def test_netting_cancels_when_paid_inside_years(spark):
    loads, snaps = _data(spark)
    net = op.net_pending(loads, snaps, years=["2023", "2024"])
    v1 = net.filter(F.col("nro_comprobante") == "00001/23").agg(F.sum("importe")).first()[0]
    # accrual 100, netted -80 in Dec, paid +100 in Jan: cash view shows 120 over the two years
    assert v1 == D(120)


def test_year_filter_drops_outside_payments(spark):
    loads, snaps = _data(spark)
    net = op.net_pending(loads, snaps, years=["2023"])
    assert net.filter(F.col("id").endswith("C")).count() == 0


def test_net_pending_semi(spark):
    loads, snaps = _data(spark)
    vouchers = loads.filter(F.col("tipo") == "CYO").select("ejercicio", "nro_comprobante", "mes", "importe")
    out = op.net_pending_semi(vouchers, snaps.select("ejercicio", "nro_comprobante", "mes", "fecha_hasta", "saldo"),
                              years=["2024"])
    synth = out.filter(F.col("clase_gto") == "RDEU")
    assert rows(synth, "nro_comprobante", "mes", "importe") == [
        ("00001/23", "01/2024", D(100)), ("00001/23", "12/2023", D(-80)),
        ("00002/24", "01/2024", D(-100)), ("00002/24", "02/2024", D(100))]
    assert synth.filter(F.col("clase_mod") == "NOR").count() == 4


def test_works_controls_run_writes_tables(spark):
    import tempfile

    from arqueo.plans import reports
    loads, snaps = _data(spark)
    rend = spark.createDataFrame([("2024", "01/2024", "c1", "00002/24", D(100))],
                                 "ejercicio string, mes string, cta_cte string, nro_comprobante string, "
                                 "importe_bruto decimal(18,2)")
    out = reports.works_controls(loads, snaps, rend, tempfile.mkdtemp(prefix="arqueo-out-"), years=["2023", "2024"])
    cc = spark.read.parquet(out["control_cruzado"])
    jan = cc.filter((F.col("ejercicio") == "2024") & (F.col("mes") == "01/2024")).first()
    # Jan 2024: loads 60 + 40; the 31 Jan snapshot (100) nets each of the two load lines (-200, the
    # original's repeated balance); voucher 1 paid +100; renditions 100
    assert jan.ejecutado_icaro == D(0) and jan.bruto_sgf == D(100) and jan.diferencia == D(-100)
    assert cc.schema["ejercicio"].dataType.simpleString() == "string"  # years stay text in partition folders
    assert spark.read.parquet(out["control_completo"]).count() > 0
