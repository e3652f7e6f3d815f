from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from arqueo.sources import io, systems
from arqueo.sources.schemas import SCHEMAS
from conftest import D, day


def test_write_tables_partitioned_and_year_pruned(spark):
    root = tempfile.mkdtemp(prefix="arqueo-src-")
    loads = spark.createDataFrame(
        [("L1", "2023", "c1", "PA6", D(1)), ("L2", "2024", "c1", "REG", D(2)), ("L3", "2024", "c2", "CYO", D(3))],
        "id string, ejercicio string, cta_cte string, tipo string, importe decimal(18,2)")
    amap = spark.createDataFrame([("C-1", "c1")], "map_to string, icaro_cta_cte string")
    io.write_tables({"icaro_carga": loads, "ctas_ctes": amap}, root)
    df = systems.works_loads(spark, root, years="2024", amap=systems.account_map(spark, root),
                             skip_regularisations=True)
    assert [(r.id, r.cta_cte) for r in df.collect()] == [("L3", None)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ejercicio" in plan
    assert df.schema["importe"].dataType == SCHEMAS["works_loads"]["importe"].dataType


def test_csv_opening_balances(spark):
    root = tempfile.mkdtemp(prefix="arqueo-csv-")
    with open(f"{root}/acum_2008", "w") as f:
        f.write("row_no,prog,subprog,proy,obra,descripcion,estructura,actividad,partida,alta,acum_2008\n")
        f.write("1,29,,,,,,,,,\n2,,,,O1,,29-01,29-01-01-01,422,2008,5.50\n")
    df = systems.opening_2008(spark, root)
    assert df.filter(F.col("row_no") == 2).first().acum_2008 == D(5.5)


def test_bucketed_tables_join_without_shuffle(spark):
    root = tempfile.mkdtemp(prefix="arqueo-bkt-")
    a = spark.range(0, 2000).select(F.col("id").cast("string").alias("nro_comprobante"), F.lit(1).alias("x"))
    b = spark.range(0, 2000).select(F.col("id").cast("string").alias("nro_comprobante"), F.lit(2).alias("y"))
    io.write_tables({"bk_ledger": a, "bk_loads": b}, root, partition_by_year=False,
                    bucket_by={"bk_ledger": (8, ["nro_comprobante"]), "bk_loads": (8, ["nro_comprobante"])})
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("bk_ledger").join(spark.table("bk_loads"), "nro_comprobante")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _readers():
    import inspect

    return [f for n, f in inspect.getmembers(systems, inspect.isfunction) if f.__module__ == systems.__name__ and not n.startswith("_")]


def test_every_source_reads_its_schema_and_years(spark, tmp_path, monkeypatch):
    """Each S-xx reader over a small table of its schema: all declared columns, and only the years asked for."""
    import datetime as dt
    import inspect
    from decimal import Decimal

    from pyspark.sql import types as T

    samples = {"string": "x", "int": 1, "bigint": 1, "double": 1.0, "boolean": True, "date": dt.date(2024, 1, 5), "timestamp": dt.datetime(2024, 1, 5)}
    made = {}

    def small(kind):
        return Decimal("1.00") if isinstance(kind, T.DecimalType) else samples[kind.simpleString()]

    real = systems._read

    def read(spark_, root, table, schema, *args, **kwargs):
        shape = SCHEMAS[schema]
        path = f"{root}/{table}"
        if path not in made and shape is not None:
            rows = [tuple(y if f.name == "ejercicio" else small(f.dataType) for f in shape.fields) for y in ("2023", "2024")]
            spark_.createDataFrame(rows, shape).write.mode("overwrite").parquet(path)
            made[path] = schema
        kwargs["fmt"] = "parquet"
        return real(spark_, root, table, schema, *args, **kwargs)

    monkeypatch.setattr(systems, "_read", read)
    readers = _readers()
    assert len(readers) >= 36
    seen = set()
    for f in readers:
        parameters = inspect.signature(f).parameters
        own = {"years": "2024"} if "years" in parameters else {}
        df = f(spark, str(tmp_path), **own)
        rows_ = df.collect()
        if not rows_:
            continue  # readers of one document type leave the sample out
        if own and "ejercicio" in df.columns:
            assert {r.ejercicio for r in rows_} == {"2024"}, f.__name__
        seen.add(f.__name__)
    assert len(seen) >= 30 and len(set(made.values())) >= 25
