"""Ordered work within a key when one key may hold a large share of all rows: segmented prefix scans.

Rows are dealt to tasks by ranges of the full order (key, then the order columns), so a key with half of all
rows lies in half of the tasks, also when all its rows have one time and only their ids tell them apart.
Each task runs once along its rows and works out what its own rows tell: their place, or the value
before them, since their key began or since the task did.  One row a task then says how it ends; these
rows, as many as there are tasks, are added up along the order and given to the first key of each task.

The ranged rows are written below ``spark.checkpoint.dir`` and read again, so that the tasks' ends and the rows
come from one and the same exchange, also when an executor is lost in between.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkledger.session import stored

# functions of this module that run in tasks travel with the task, so executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def left_join_spread(left: DataFrame, right: DataFrame, key: str, by: str, spread: int = 1024) -> DataFrame:
    """Left join on ``key`` whose rows without a key do not meet in one task.

    A null key matches nothing but is hashed like any other; such rows get a second key
    made from ``by``, which the right side has as 0.
    """
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(by), F.lit(spread))).otherwise(0)
    salted = left.withColumn("_salt", salt.cast("int"))
    return salted.join(right.withColumn("_salt", F.lit(0)), [key, "_salt"], "left").drop("_salt")


def _begins(keys: pa.Array, before: pa.Scalar | None) -> np.ndarray:
    """Whether a key begins at each row; ``before`` is the last key of the rows before, None at the task's first."""
    n = len(keys)
    if before is None:
        shifted = keys.slice(0, n - 1)
        own = keys.slice(1)
    else:
        shifted = pa.concat_arrays([pa.array([before.as_py()], keys.type), keys.slice(0, n - 1)])
        own = keys
    equal = pc.or_(pc.fill_null(pc.equal(own, shifted), False), pc.and_(pc.is_null(own), pc.is_null(shifted)))
    begins = ~equal.to_numpy(zero_copy_only=False)
    return np.concatenate([[True], begins]) if before is None else begins


def _scanned(df: DataFrame, key: str, order: list[str], value: str, purpose: str) -> DataFrame:
    """``df`` ranged along (key, order) and written, with what each task can tell of its own rows:

    ``_part`` the task, ``_at`` the row's place in it, ``_since`` the number of rows since its key began there,
    ``_before`` the ``value`` of the row before within key and task, ``_first`` whether its key is the task's first.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_at", T.LongType()),
                           T.StructField("_since", T.LongType()), T.StructField("_before", df.schema[value].dataType),
                           T.StructField("_first", T.BooleanType())])
    names = schema.names

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, since, first, last_key, last_value = 0, 0, True, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.select(names[:-4])
            keys, values, n = batch.column(key), batch.column(value), batch.num_rows
            begins = _begins(keys, last_key)
            here = np.arange(n)
            start = np.maximum.accumulate(np.where(begins, here, -1))
            count = np.where(start >= 0, here - start + 1, since + here + 1)
            earlier = pa.array([None if last_value is None else last_value.as_py()], values.type)
            shifted = pa.concat_arrays([earlier, values.slice(0, n - 1)])
            before = pc.if_else(pa.array(begins), pa.scalar(None, values.type), shifted)
            # the task's very first key begins once; what begins after it is another
            later = np.cumsum(begins) > (1 if at == 0 else 0)
            firsts = np.full(n, first) & ~later
            yield pa.record_batch([*rows.columns, pa.array(np.arange(at, at + n)), pa.array(count), before, pa.array(firsts)], names=[*rows.schema.names, *names[-4:]])
            at, since, first, last_key, last_value = at + n, int(count[-1]), bool(firsts[-1]), keys[n - 1], values[n - 1]

    ranged = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order).withColumn("_part", F.spark_partition_id())
    return stored(ranged.mapInArrow(scan, schema), purpose)


def _carried(scanned: DataFrame, key: str, value: str, carry: Callable[[list], list], kind: T.DataType) -> DataFrame:
    """Per task what its first key brings along; ``carry`` works it out from the tasks' ends, in order."""
    told = F.struct(F.col(key).alias("key"), F.col("_since").alias("n"), F.col(value).alias("value"), F.col("_first").alias("whole"))
    ends = (scanned.groupBy("_part").agg(F.min_by(F.col(key), "_at").alias("first"), F.max_by(told, "_at").alias("end"))
            .orderBy("_part").collect())  # one row a task
    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_carry", kind)])
    return F.broadcast(scanned.sparkSession.createDataFrame(list(zip([r["_part"] for r in ends], carry(ends))), schema))


def number_within(df: DataFrame, key: str, order: list[str], out: str) -> DataFrame:
    """``row_number()`` per key along ``order``; rows equal in all of ``order`` are numbered in any order."""
    scanned = _scanned(df, key, order, key, "numbered")

    def carry(ends: list) -> list:
        counts, key_before, n = [], object(), 0
        for r in ends:
            counts.append(n if r["first"] == key_before else 0)
            # a task that is one key passes on what it got
            n = r["end"]["n"] + (counts[-1] if r["end"]["whole"] else 0)
            key_before = r["end"]["key"]
        return counts

    number = F.col("_since") + F.when(F.col("_first"), F.col("_carry")).otherwise(0)
    return (scanned.join(_carried(scanned, key, key, carry, T.LongType()), "_part")
            .withColumn(out, number).select(*df.columns, out))


def previous_within(df: DataFrame, key: str, order: list[str], value: str, out: str) -> DataFrame:
    """``lag(value)`` per key along ``order``, which no two rows of a key share; null on each key's first row."""
    scanned = _scanned(df, key, order, value, "stepped")

    def carry(ends: list) -> list:
        values, key_before, last = [], object(), None
        for r in ends:
            values.append(last if r["first"] == key_before else None)
            key_before, last = r["end"]["key"], r["end"]["value"]
        return values

    # only a task's first row lacks what the task before it has
    previous = F.when(F.col("_at") == 0, F.col("_carry")).otherwise(F.col("_before"))
    return (scanned.join(_carried(scanned, key, value, carry, df.schema[value].dataType), "_part")
            .withColumn(out, previous).select(*df.columns, out))


def scanned_sizes(df: DataFrame, key: str, order: list[str]) -> list[int]:
    """Rows of each task of a scan, for tests and tuning."""
    return [r["n"] for r in _scanned(df, key, order, key, "sizes").groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()]

