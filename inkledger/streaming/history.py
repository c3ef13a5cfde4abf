"""The status history of invoices, kept along the stream of actions.

Parts of the store ``out`` (see ``commits``):
  steps  applied actions with the status before and after, and the ``revision`` they were worked out in
  last   per invoice its last action's time, id and status, as of the batch

Both lie in folders by a hash of the invoice, and a batch reads those its own invoices fall in.  Actions later
than all known of their invoice go on from its last status.  An action that comes late re-opens its invoice: the
invoice's steps are worked out anew, and those that changed are written as a later revision.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkledger.functions.parse import new_status
from inkledger.operators.approvals import classify_actions
from inkledger.operators.hot import previous_within
from inkledger.session import stored
from inkledger.streaming.commits import Part, commit_batch, read_state
from inkledger.streaming.ingest import compact, prepare, writer_of

BUCKETS = 64
STEP = ("action_id", "invoice_id", "invoice_number", "initial_status", "previous_status", "new_status", "action_time")


def _bucket(invoice: str = "invoice_id") -> Column:
    return F.pmod(F.xxhash64(invoice), F.lit(BUCKETS)).cast("int")


def _read(spark: SparkSession, out: str, name: str, folders: list[str], buckets: list[int] | None = None) -> DataFrame | None:
    if not folders:
        return None
    rows = spark.read.option("basePath", f"{out}/{name}").parquet(*folders).drop("attempt")
    return (rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))).drop("bucket")


def _newest(steps: DataFrame) -> DataFrame:
    """Each action's last revision."""
    return (steps.groupBy("action_id").agg(F.max_by(F.struct(*STEP[1:]), "revision").alias("_step"))
            .select("action_id", "_step.*"))


def _stepped(applied: DataFrame) -> DataFrame:
    """Rows with ``previous_status``; ``opening`` is the status before an invoice's first row."""
    stepped = previous_within(applied, "invoice_id", ["action_time", "action_id"], "new_status", "_previous")
    return stepped.withColumn("previous_status", F.coalesce("_previous", "opening"))


def store_actions(actions: DataFrame, batch_id: int, out: str, invoices: DataFrame, vendors: DataFrame, source: str) -> None:
    """Add one batch of actions to the history; a batch that is in the log already is left alone."""
    spark = actions.sparkSession
    applied = stored(classify_actions(actions, invoices, vendors).filter(F.col("status_code") == 200).select(
        "action_id", "action_time", F.col("_target").alias("invoice_id"), "invoice_number", "initial_status",
        new_status(F.col("action")).alias("new_status")), "applied")
    at = F.struct("action_time", "action_id", "new_status")
    own = stored(applied.groupBy("invoice_id").agg(F.min(at).alias("first"), F.max(at).alias("last")), "touched")
    buckets = [r[0] for r in own.select(_bucket()).distinct().collect()]  # at most BUCKETS
    while True:
        state = read_state(spark, out)
        if state.has(source, batch_id):
            return
        parts = _write_steps(spark, out, f"attempt={source}-{batch_id}-{uuid.uuid4().hex[:12]}", state, applied, own, buckets)
        if commit_batch(spark, out, state.version, source, batch_id, parts):
            return


def _write_steps(spark: SparkSession, out: str, name: str, state, applied: DataFrame, own: DataFrame, buckets: list[int]) -> list[Part]:
    known, steps = _read(spark, out, "last", state.folders("last"), buckets), _read(spark, out, "steps", state.folders("steps"), buckets)
    if known is None:
        rows = _stepped(applied.withColumn("opening", F.col("initial_status"))).select(*STEP)
    else:
        known = known.groupBy("invoice_id").agg(F.max("last").alias("known"))
        touched = stored(own.join(known, "invoice_id", "left").select(
            "invoice_id", "known.new_status", F.coalesce(F.col("first") < F.col("known"), F.lit(False)).alias("late")), "states")
        late = touched.filter("late").select("invoice_id")
        opening = touched.select("invoice_id", "late", F.col("new_status").alias("_known"))
        on = applied.join(opening.filter("NOT late"), "invoice_id").withColumn("opening", F.coalesce("_known", "initial_status"))
        rows = _stepped(on.drop("late", "_known")).select(*STEP)
        again = _newest(steps.join(late, "invoice_id", "left_semi")).withColumnRenamed("previous_status", "_was")
        reopened = again.unionByName(applied.join(late, "invoice_id", "left_semi"), allowMissingColumns=True)
        changed = _stepped(reopened.withColumn("opening", F.col("initial_status"))).filter(~F.col("_was").eqNullSafe(F.col("previous_status")))
        rows = rows.unionByName(changed.select(*STEP))
    parts = []
    for kind, df in (("steps", rows.withColumn("revision", F.lit(state.version + 1).cast("bigint"))), ("last", own.select("invoice_id", "last"))):
        parts.append(_write(df, kind, f"{out}/{kind}/{name}"))
    return parts


def _write(df: DataFrame, kind: str, folder: str) -> Part:
    told = Observation()
    (df.withColumn("bucket", _bucket()).observe(told, F.count(F.lit(1)).alias("n")).hint("rebalance", F.col("bucket"))
     .write.partitionBy("bucket").parquet(folder))
    return Part(kind, folder, told.get["n"])


def read_history(spark: SparkSession, out: str) -> DataFrame:
    """Previous and new status of every applied action so far; needs at least one stored batch."""
    return _newest(_read(spark, out, "steps", read_state(spark, out).folders("steps"))).drop("initial_status")


def compact_history(spark: SparkSession, out: str, fan: int = 8) -> int:
    """Merge small parts; of each action the last revision is left, of each invoice the last action."""
    def merge(session: SparkSession, name: str, parts: list[Part], where: str) -> Part:
        rows = _read(session, where, name, [p.folder for p in parts])
        if name == "last":
            kept = rows.groupBy("invoice_id").agg(F.max("last").alias("last"))
        else:
            kept = rows.groupBy("action_id").agg(F.max_by(F.struct(*STEP[1:], "revision"), "revision").alias("_step")).select("action_id", "_step.*")
        return _write(kept, name, f"{where}/{name}/attempt=merge-{len(parts)}-{uuid.uuid4().hex[:12]}")

    return compact(spark, out, fan, merge)


def start_history(actions: DataFrame, tables: Callable[[], tuple[DataFrame, DataFrame]], out: str, checkpoint: str,
                  available_now: bool = True, interval: str = "1 minute", fan: int = 8) -> StreamingQuery:
    """Keep the history of arriving actions, against invoices and vendors as ``tables()`` has them then."""
    source = writer_of(actions.sparkSession, checkpoint)
    prepare(actions.sparkSession, out)

    def store(batch: DataFrame, batch_id: int) -> None:
        store_actions(batch, batch_id, out, *tables(), source)
        if batch_id % fan == fan - 1:
            compact_history(batch.sparkSession, out, fan)

    writer = actions.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
