"""Staged tables, row numbers and connected components shared by the operators of this folder."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkledger.session import shared_dir

#: Rows for one task of a narrow ordered table.
ROWS_PER_TASK = 200_000


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again: lineage ends here, on shared storage."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(spark: SparkSession, rows: int, per_task: int = ROWS_PER_TASK) -> int:
    """Number of partitions for ``rows`` narrow rows: the session's own setting, or more where they need more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(rows / per_task))


def numbered(df: DataFrame, order: list[str], out: str, purpose: str) -> tuple[DataFrame, int]:
    """``df`` with ``out`` = 0, 1, 2, ... along ``order``, and the number of rows.

    One range exchange; rows are numbered where they lie and each partition's offset, one row
    a partition, is added.  The numbered partitions are staged first, so offsets and numbers
    come from the same exchange even when an executor is lost in between.
    """
    rows = df.count()
    n = tasks_for(df.sparkSession, rows)
    placed = staged(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()), purpose)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")).collect()
    offsets, before = [], 0
    for row in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((row["_part"], before - row["_first"]))
        before += row["_n"]
    # one row a partition: its size is the number of tasks, whatever the data
    shift = df.sparkSession.createDataFrame(offsets, "_part int, _shift bigint")
    return (placed.join(F.broadcast(shift), "_part")
            .withColumn(out, F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")), rows


def wide_id(value: Column) -> Column:
    """A 126-bit id of a text as ``decimal(38,0)``; unlike a binary key it is aggregated by hash."""
    first = F.xxhash64(value).cast("decimal(38,0)")
    second = F.xxhash64(F.lit("second"), value).bitwiseAND(F.lit((1 << 62) - 1)).cast("decimal(38,0)")
    return (first * F.lit(1 << 62).cast("decimal(19,0)") + second).cast("decimal(38,0)")


def _is_stars(edges: DataFrame) -> bool:
    """Whether every upper end has one edge and no lower end is itself an upper end."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("low")).unionAll(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("low")))
    # one aggregation: plans stay on the driver for a while
    counts = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("low").alias("low"))
    return counts.filter("up > 1 OR (up = 1 AND low = 1)").isEmpty()


def components(edges: DataFrame, src: str, dst: str, purpose: str) -> DataFrame:
    """``(node, component)`` of every node with an edge; a component is named by its smallest node.

    Alternating large-star and small-star steps: neighbours are hung below the smallest node
    in sight until only stars are left, about log(nodes) rounds.  Each step is a minimum by
    hash aggregation and a join, so a node with very many neighbours is aggregated map-side
    and its join partition can be split.  Every round is staged.  Null ends and loops are left out.
    """
    upper, lower = F.greatest(src, dst), F.least(src, dst)
    edges = staged(edges.filter(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst)))
                   .select(upper.alias("u"), lower.alias("v")).distinct(), f"{purpose}-edges")
    while not _is_stars(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u").filter("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = staged(large, f"{purpose}-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        edges = staged(small, f"{purpose}-small")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
