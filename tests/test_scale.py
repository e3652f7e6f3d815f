"""Work spread over tasks: shapes of plans and partitions that only show on larger tables."""

from __future__ import annotations

import contextlib
import os
import threading

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from arqueo.operators import netting
from arqueo.plans import catalog, fees
from arqueo.sources import io
from conftest import D, rows

SF = "/root/testdata/sf0.001"
driver_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {k.replace("_", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_equally_severe_vouchers_are_sorted_in_more_than_one_task(spark):
    v = spark.range(4000).select(F.lit("2024").alias("ejercicio"), F.col("id").cast("string").alias("nro_comprobante"), F.lit("01/2024").alias("mes"),
                                 F.lit("1").alias("cta_cte"), F.lit(1).cast("decimal(18,2)").alias("importe"))
    none = v.limit(0).withColumnRenamed("importe", "importe_bruto")
    with settings(spark, spark_sql_adaptive_enabled="false"):
        sizes = fees.ledger_vs_fees(v, none).rdd.glom().map(len).collect()
    assert sum(sizes) == 4000 and max(sizes) < 2000
    few = v.filter("nro_comprobante < 3").withColumn("importe", F.when(F.col("nro_comprobante") == "1", D(5)).otherwise(F.col("importe")))
    other = v.filter("nro_comprobante in (1, 2)").withColumnRenamed("importe", "importe_bruto")
    got = fees.ledger_vs_fees(few, other).select("siif_nro", "err_nro", "err_importe").collect()
    assert [tuple(r) for r in got] == [("0", True, True), ("1", False, True)] and len(rows(fees.ledger_vs_fees(few, other))) == 2


def test_tables_are_written_at_the_same_time(spark, tmp_path, monkeypatch):
    met, save = threading.Barrier(2, timeout=30), DataFrameWriter.save

    def both(self, *args, **kwargs):
        met.wait()  # breaks when a write waits for the end of the other
        return save(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "save", both)
    made = {name: spark.range(3).select(F.lit("2024").alias("ejercicio"), (F.col("id") + k).alias("x")) for k, name in enumerate(("a", "b"))}
    assert io.write_tables(made, str(tmp_path)) == {name: f"{tmp_path}/{name}" for name in made}
    assert rows(spark.read.parquet(f"{tmp_path}/b"), "x") == [(1,), (2,), (3,)]


def test_a_failed_table_fails_the_whole_writing(spark, tmp_path):
    bad = spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        io.write_tables({"good": spark.range(3), "bad": bad}, str(tmp_path))


@driver_tables
def test_voucher_control_reads_its_lines_joined_once_and_written(spark):
    plan = catalog.QUERIES["d_iv2"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


@driver_tables
def test_gap_sums_up_the_snapshots_once(spark, monkeypatch):
    seen, write = [], netting.materialize
    monkeypatch.setattr(netting, "materialize", lambda df, name: seen.append(name) or write(df, name))
    assert catalog.QUERIES["d_cb5_completo"](spark, SF).count() > 0
    assert seen == ["snapshots"]
