"""The constraint audit of tables that grow by batches, without reading them again.

Parts of the store ``out`` (see ``commits``):
  values    per rule and value how many rows a batch brought that have it, and how many targets of that value
  findings  per rule by how much a batch changed its violations

Counts add up, so the sum over batches is what the whole table would give.  A unique value is violated from its second
row on; a reference as often as it is used while no target has come, and not at all any more once one has.  A
batch works out the difference for the values it brings, from their counts so far; these lie in folders by a hash
of the value, and only the folders of the batch's values are read.  What one pass can tell (nulls, lengths, precision) is counted
in the batch alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from inkledger import model as M
from inkledger.operators.audit import audit_columns
from inkledger.session import stored
from inkledger.streaming.commits import Part, commit_batch, read_state
from inkledger.streaming.ingest import BATCHES, compact

BUCKETS = 64
#: Values of a batch up to which what was kept before is first cut down to them.
FEW = 100_000
RULE = ("rule", "table_name", "column_name")


def _used(df: DataFrame, rule: str, table: str, column: str, rows: Column, targets: Column) -> DataFrame:
    return (df.filter(F.col(column).isNotNull())
            .select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                    F.col(column).cast("string").alias("value"), rows.cast("bigint").alias("n"), targets.cast("bigint").alias("targets")))


def value_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per rule and value the rows and targets of some tables."""
    one, none = F.lit(1), F.lit(0)
    parts = [_used(df, "unique", table, column, one, none) for table, df in tables.items()
             for column in (M.PRIMARY_KEY[table], *M.UNIQUE.get(table, ())) if column in df.columns]
    for table, column, target in M.FOREIGN_KEYS:
        if table in tables and target in tables:
            parts += [_used(tables[table], "foreign_key", table, column, one, none), _used(tables[target], "foreign_key", table, column, none, one)]
    return reduce(DataFrame.unionByName, parts).groupBy(*RULE, "value").agg(F.sum("n").alias("n"), F.sum("targets").alias("targets"))


def _violations(n: Column, targets: Column) -> Column:
    return F.when(F.col("rule") == "unique", (n > 1).cast("bigint")).otherwise(F.when(targets == 0, n).otherwise(0))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("value"), F.lit(BUCKETS)).cast("int")


def _read(spark: SparkSession, out: str, folders: list[str], buckets: list[int] | None = None) -> DataFrame:
    rows = spark.read.option("basePath", f"{out}/values").parquet(*folders).drop("attempt")
    return rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))


def audit_batch(tables: Mapping[str, DataFrame], batch_id: int, out: str, source: str = BATCHES) -> None:
    """Add the new rows of some tables.

    References are audited between tables that are both given; a batch without rows of one passes it empty,
    and tables are audited like this from their first rows.
    """
    spark = next(iter(tables.values())).sparkSession
    delta = stored(value_counts(tables).withColumn("bucket", _bucket()), "delta")
    buckets = [r["bucket"] for r in delta.select("bucket").distinct().collect()]  # at most BUCKETS
    columns = stored(audit_columns(tables), "columns")
    while True:
        state = read_state(spark, out)
        if state.has(source, batch_id):
            return
        name = f"attempt={source}-{batch_id}-{uuid.uuid4().hex[:12]}"
        folders, written = state.folders("values"), _write_values(delta, f"{out}/values/{name}")
        none = F.lit(0).cast("bigint")
        sums = delta.select(*RULE, "value", none.alias("n0"), none.alias("t0"), "n", "targets")
        if folders:
            before = _read(spark, out, folders, buckets)
            if written.rows <= FEW:
                before = before.join(delta.select(*RULE, "value", "bucket"), [*RULE, "value", "bucket"], "left_semi")
            sums = sums.unionAll(before.select(*RULE, "value", "n", "targets", none, none))
        # a row of the batch has come with one use or target at least; what it does not bring stays as it was
        keys = sums.groupBy(*RULE, "value").agg(*[F.sum(c).alias(c) for c in ("n0", "t0", "n", "targets")])
        n0, t0 = F.col("n0"), F.col("t0")
        change = _violations(n0 + F.col("n"), t0 + F.col("targets")) - _violations(n0, t0)
        findings = (keys.filter(F.col("n") + F.col("targets") > 0).groupBy(*RULE).agg(F.sum(change).alias("violations"))
                    .unionByName(columns.select(*RULE, "violations")))
        parts = [written, _write_findings(findings, f"{out}/findings/{name}")]
        if commit_batch(spark, out, state.version, source, batch_id, parts):
            return


def _write_values(values: DataFrame, folder: str) -> Part:
    told = Observation()
    values.observe(told, F.count(F.lit(1)).alias("n")).hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(folder)
    return Part("values", folder, told.get["n"])


def _write_findings(findings: DataFrame, folder: str) -> Part:
    findings.coalesce(1).write.parquet(folder)  # a row a rule
    return Part("findings", folder, 1)


def read_findings(spark: SparkSession, out: str) -> DataFrame:
    """Violations per rule of all rows so far, as ``audit.constraint_audit`` of the whole tables gives them."""
    parts = spark.read.parquet(*read_state(spark, out).folders("findings"))
    return parts.groupBy(*RULE).agg(F.sum("violations").cast("bigint").alias("violations"))


def compact_audit(spark: SparkSession, out: str, fan: int = 8) -> int:
    """Add up small parts."""
    def merge(session: SparkSession, name: str, parts: list[Part], where: str) -> Part:
        folders, folder = [p.folder for p in parts], f"{where}/{name}/attempt=merge-{len(parts)}-{uuid.uuid4().hex[:12]}"
        if name == "findings":
            rows = session.read.parquet(*folders).groupBy(*RULE).agg(F.sum("violations").alias("violations"))
            return _write_findings(rows, folder)
        rows = _read(session, where, folders).groupBy(*RULE, "value", "bucket").agg(F.sum("n").alias("n"), F.sum("targets").alias("targets"))
        return _write_values(rows, folder)

    return compact(spark, out, fan, merge)
