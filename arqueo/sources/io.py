"""Reading sources and writing result tables (S-01..S-40, K-01)."""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import together
from .schemas import SCHEMAS


def read_source(spark: SparkSession, name: str, path: str, years: str | Sequence[str] | None = None,
                up_to: str | None = None, fmt: str = "parquet", options: dict | None = None,
                year_col: str = "ejercicio") -> DataFrame:
    """Read one source with its declared schema; the year filter reaches the scan.

    ``fmt`` is ``parquet`` (default), ``csv`` or ``jdbc``; ``options`` then carry
    the connection and must name a partitioned read (column, bounds, number),
    as one task would read the whole table otherwise.  Tables written by :func:`write_tables` are partitioned by
    ``ejercicio``, so a year filter prunes whole folders.
    """
    schema = SCHEMAS.get(name)
    reader = spark.read.options(**(options or {}))
    if fmt == "jdbc":
        missing = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"} - set(options or {})
        if missing:
            raise ValueError(f"a JDBC read needs {sorted(missing)}")
        df = reader.format("jdbc").load()
        if schema is not None:
            df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields if f.name in df.columns])
    else:
        if schema is not None:
            reader = reader.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", "true")
        df = reader.format(fmt).load(path)
    if years is not None and year_col in df.columns:
        ys = [years] if isinstance(years, str) else list(years)
        df = df.filter(F.col(year_col).isin(ys))
    if up_to is not None and year_col in df.columns:
        df = df.filter(F.col(year_col).cast("int") <= F.lit(int(up_to)))
    return df


def write_tables(tables: dict[str, DataFrame], path: str, fmt: str = "parquet", mode: str = "overwrite",
                 partition_by_year: bool = True,
                 bucket_by: dict[str, tuple[int, Sequence[str]]] | None = None) -> dict[str, str]:
    """K-01: write several result tables, one folder per table (workbook sheets re-aimed).

    Tables that carry ``ejercicio`` are partitioned by it so later reads of one
    year prune the rest.  ``bucket_by`` maps a table to (buckets, columns): the
    table is registered in the session catalog with that bucketing (and sorted
    by those columns), so two tables bucketed alike on a join key join without
    a shuffle; read them back with ``spark.table(name)``.  Tables are
    written several at a time, bucketed ones one after another.
    """
    def save(name: str, df: DataFrame) -> str:
        target = os.path.join(path, name)
        w = df.write.mode(mode).format(fmt)
        if fmt == "csv":
            w = w.option("header", "true")
        if partition_by_year and "ejercicio" in df.columns:
            w = w.partitionBy("ejercicio")
        if bucket_by and name in bucket_by:
            n, cols = bucket_by[name]
            w.bucketBy(int(n), *cols).sortBy(*cols).option("path", target).saveAsTable(name)
        else:
            w.save(target)
        return target

    bucketed = [name for name in tables if bucket_by and name in bucket_by]
    plain = [name for name in tables if name not in bucketed]
    out = {}
    if plain:
        spark = tables[plain[0]].sparkSession
        out.update(zip(plain, together(spark, [partial(save, name, tables[name]) for name in plain])))
    out.update({name: save(name, tables[name]) for name in bucketed})
    return {name: out[name] for name in tables}
