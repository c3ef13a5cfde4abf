"""The history of stored invoice numbers, and the question which of some claims it holds.

A part of the history is a folder with two tables:
  keys     the numbers with their hash, sorted by it, in pages of ``PAGE`` rows
  filters  per bucket of the hash (its leading bits) a bitmap in which each number sets ``PROBES``
           of 32,768 bits: a Bloom filter of at most about 2,048 numbers, some 16 bits each

A claim that is not in the history passes a filter once in 2,000 times.  What passes is gathered to at
most ``CELLS`` ranges of the hash, which go to the scan of the keys as a filter: Parquet skips the
pages outside them by their least and largest values.  So a batch reads the filters, one row for a
thousand numbers and more, and of the keys the pages of its suspects.

Filters are made along the sorted keys, a batch of rows at a time: a task holds the bitmaps of the batch's
buckets, and what several tasks have of one bucket is put together by bit.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# functions of this module that run in tasks travel with the task, so executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bits of one filter (fixed by Spark's bitmap functions), set bits per number, numbers a filter is made for.
BITS, PROBES, LOAD = 32768, 11, 2048
#: Rows of a page of keys, and keys of one file.
PAGE, FILE = 256, 500_000
#: Ranges that a scan of the keys is narrowed to: leading bits of the hash.
CELL_BITS = 8
CELLS = 1 << CELL_BITS
KEYS = "invoice_number string, hash bigint"
FILTERS = "level int, bucket bigint, bits binary"


def number_hash(number: str = "invoice_number") -> Column:
    return F.xxhash64(number)


def _bucket(level: Column) -> Column:
    """The leading ``level`` bits of the hash; a shift by all 64 would be one by none."""
    return F.when(level == 0, F.lit(0)).otherwise(F.expr("shiftrightunsigned(hash, 64 - level)"))


def _low(value: Column) -> Column:
    return value.bitwiseAND(F.lit(BITS - 1))


def _first_and_step() -> tuple[Column, Column]:
    """Two further hashes of a number: the first bit it sets, and how far apart its bits are."""
    first, step = F.xxhash64(F.lit(1), "invoice_number"), F.xxhash64(F.lit(2), "invoice_number").bitwiseOR(F.lit(1))
    return _low(first), _low(step)


def _probes() -> Column:
    """The bits that a number sets."""
    first, step = _first_and_step()
    return F.array(*[_low(first + step * i) for i in range(PROBES)])


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bitmaps of each batch's buckets; bit ``i`` is bit ``i % 8`` of byte ``i // 8``, as Spark's bitmap functions have it."""
    for batch in batches:
        bucket, place = np.unique(batch.column("bucket").to_numpy(), return_inverse=True)
        first, step = batch.column("first").to_numpy(), batch.column("step").to_numpy()
        bits = np.zeros((len(bucket), BITS), bool)
        for i in range(PROBES):
            bits[place, (first + step * i) & (BITS - 1)] = True
        packed = np.packbits(bits, axis=1, bitorder="little")
        yield pa.record_batch([pa.array(bucket), pa.array([row.tobytes() for row in packed], pa.binary())], ["bucket", "bits"])


def level_of(rows: int) -> int:
    """Leading bits of the hash that tell the filters of a part of ``rows`` numbers apart."""
    return max(0, ceil(log2(max(rows, 1) / LOAD)))


def write_numbers(numbers: DataFrame, rows: int, folder: str) -> None:
    """The ``rows`` distinct ``invoice_number`` values as one part of the history."""
    spark = numbers.sparkSession
    level = level_of(rows)
    hashed = numbers.select("invoice_number", number_hash().alias("hash"))
    (hashed.repartitionByRange(ceil(max(rows, 1) / FILE), "hash").sortWithinPartitions("hash")
     .write.option("parquet.page.row.count.limit", PAGE).parquet(f"{folder}/keys"))
    kept = spark.read.schema(KEYS).parquet(f"{folder}/keys").withColumn("level", F.lit(level))
    first, step = _first_and_step()
    spots = kept.select(_bucket(F.col("level")).cast("bigint").alias("bucket"), first.alias("first"), step.alias("step"))
    bits = (spots.mapInArrow(_bitmaps, "bucket bigint, bits binary").groupBy(F.lit(level).alias("level"), "bucket")
            .agg(F.bitmap_or_agg("bits").alias("bits")))
    bits.repartitionByRange(ceil(max(rows, 1) / FILE), "bucket").sortWithinPartitions("bucket").write.parquet(f"{folder}/filters")


def read_numbers(spark: SparkSession, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], KEYS)
    return spark.read.schema(KEYS).parquet(*[f"{f}/keys" for f in folders])


def suspects(spark: SparkSession, parts: dict[str, int], claims: DataFrame) -> DataFrame:
    """Claims that the filters of these parts (folder and rows) let pass: all that are there, and one in 2,000 of the others a part."""
    filters = spark.read.schema(FILTERS).parquet(*[f"{f}/filters" for f in parts])
    levels = F.array(*[F.lit(n) for n in sorted({level_of(rows) for rows in parts.values()})])
    asked = (claims.select("invoice_number").distinct().select("invoice_number", number_hash().alias("hash"))
             .withColumn("probes", _probes()).withColumn("level", F.explode(levels)).withColumn("bucket", _bucket(F.col("level"))))
    # ends at the first bit that is not set, for most claims one of the first two
    there = F.expr("forall(probes, p -> shiftright(cast(conv(hex(substring(bits, cast(shiftright(p, 3) + 1 AS int), 1)), 16, 10) AS int), cast(p & 7 AS int)) & 1 = 1)")
    return (asked.join(filters, ["level", "bucket"]).filter(there)
            .select("invoice_number", "hash").distinct())


def ranges_of(found: DataFrame) -> list[tuple[int, int]]:
    """At most ``CELLS`` ranges of the hash that hold all of ``found``."""
    cell = F.shiftrightunsigned("hash", 64 - CELL_BITS)
    return [(r["low"], r["high"]) for r in found.groupBy(cell).agg(F.min("hash").alias("low"), F.max("hash").alias("high")).collect()]


def narrowed(spark: SparkSession, folders: list[str], found: DataFrame) -> DataFrame:
    """The keys of these parts around the suspects."""
    ranges = ranges_of(found)
    keys = read_numbers(spark, folders)
    # as text: one call, and a tree that the parser balances
    return keys.filter(" OR ".join(f"hash BETWEEN {low} AND {high}" for low, high in ranges)) if ranges else keys.limit(0)


def held(spark: SparkSession, parts: dict[str, int], claims: DataFrame, through) -> DataFrame:
    """The claimed numbers that these parts hold; ``through(name, df)`` writes a table and reads it again."""
    if not parts:
        return spark.createDataFrame([], "invoice_number string")
    found = through("suspects", suspects(spark, parts, claims))
    # a few rows: broadcast by Spark, which knows the written table's size
    return narrowed(spark, list(parts), found).join(found, ["hash", "invoice_number"], "left_semi").select("invoice_number")
