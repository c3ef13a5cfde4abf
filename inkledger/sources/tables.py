"""Relational tables: read, write, migrate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkledger.model import DEFAULTS, TABLES


def read_tables(spark: SparkSession, path: str, merge_schema: bool = True) -> dict[str, DataFrame]:
    """The five tables from Parquet folders below ``path``, each under its full schema.

    Merging finds columns only some files have, by reading every footer; turn it off
    where all files of a table were written under one schema.
    """
    reader = spark.read.option("mergeSchema", merge_schema)
    return {name: align_schema(reader.parquet(f"{path}/{name}"), schema, DEFAULTS.get(name))
            for name, schema in TABLES.items()}


def read_jdbc_tables(spark: SparkSession, url: str, key_bounds: Mapping[str, tuple[str, int, int, int]],
                     **options: str) -> dict[str, DataFrame]:
    """The five tables from a database, each read by ranges of a numeric key.

    ``key_bounds`` gives per table (column, lower, upper, partitions); the database
    filters and projects what Catalyst pushes down.
    """
    tables = {}
    for name in TABLES:
        reader = spark.read.format("jdbc").options(url=url, dbtable=name, **options)
        if name in key_bounds:
            column, low, high, parts = key_bounds[name]
            reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high,
                                    numPartitions=parts)
        tables[name] = reader.load()
    return tables


def write_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    """Tables as Parquet; invoices by invoice month and sorted by status within files.

    The rebalance gathers a month into few files and splits a month that holds most rows.
    """
    for name, df in tables.items():
        if name == "invoices":
            df = df.withColumn("invoice_month", F.date_format("invoice_date", "yyyy-MM"))
            df = df.hint("rebalance", F.col("invoice_month")).sortWithinPartitions(
                "invoice_month", "status", "invoice_date")
            df.write.mode("overwrite").partitionBy("invoice_month").parquet(f"{path}/{name}")
        else:
            df.write.mode("overwrite").parquet(f"{path}/{name}")


def align_schema(df: DataFrame, target: T.StructType, defaults: Mapping[str, str] | None = None) -> DataFrame:
    """Add the target's missing columns, with their defaults; keep every column there is.

    ``defaults`` maps a column to a SQL expression.  Running it again changes nothing.
    """
    defaults = defaults or {}
    have = {name.lower() for name in df.columns}
    added = [F.expr(defaults.get(f.name, "null")).cast(f.dataType).alias(f.name)
             for f in target.fields if f.name.lower() not in have]
    return df.select("*", *added) if added else df


def union_aligned(old: DataFrame, new: DataFrame, target: T.StructType,
                  defaults: Mapping[str, str] | None = None) -> DataFrame:
    """Rows written before and after a migration, under one schema."""
    return align_schema(old, target, defaults).unionByName(
        align_schema(new, target, defaults), allowMissingColumns=True)
